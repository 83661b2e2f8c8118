"""Cluster profiles, dominant values, tokens, ranks and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.functions.fixed import (
    EMPTY_CATEGORY,
    INACTIVE_DRUG,
    LEVEL_NAMES,
    OPEN_NAMES,
    SCORE_NAMES,
)
from cohortlens.operators import interpret as IN
from cohortlens.operators import profile as P
from cohortlens.plans.analysis import segment
from cohortlens.queries import registry
from cohortlens.queries import sql as S
from cohortlens.sources.encounters import (
    CATEGORICAL,
    DIAGNOSES,
    NUMERIC,
    encounters,
    grouped_encounters,
)

add = registry.add
MEASURES = {
    "time_in_hospital": "stay",
    "num_medications": "drugs",
    "num_lab_procedures": "labs",
    "number_diagnoses": "diagnoses",
    "number_inpatient": "inpatient",
    "number_emergency": "emergency",
}
OUT = list(MEASURES.values())
MEANS_SQL = ", ".join(f"avg({c}) AS {out}" for c, out in MEASURES.items())
INTERPRETED = ["race", "gender", "age", "insulin", "readmitted"]


def rounded(df, names, digits: int = 8):
    return df.withColumns({n: F.round(n, digits) for n in names})


def rounded_sql(names, digits: int = 8) -> str:
    return ", ".join(f"round({n}, {digits}) AS {n}" for n in names)


def by_patient(spark, folder):
    """Nine groups by patient number: enough for names to repeat."""
    return encounters(spark, folder).withColumn("prediction", (F.col("patient_nbr") % 9).cast("int"))


NINE = (
    ", nine AS (SELECT *, CAST(patient_nbr % 9 AS INTEGER) AS prediction FROM encounters), "
    f"profile AS (SELECT prediction, {MEANS_SQL} FROM nine GROUP BY prediction)"
)
FOUR = f", profile AS (SELECT prediction, {MEANS_SQL} FROM grouped GROUP BY prediction)"


# ---------------------------------------------------------------- sizes and means
@add("ag12_cluster_ids", S.on_groups("SELECT DISTINCT prediction FROM grouped"))
def cluster_ids(spark, folder):
    return IN.cluster_ids(grouped_encounters(spark, folder))


@add(
    "ag13_cluster_sizes",
    S.on_groups("SELECT prediction, count(*) AS n FROM grouped GROUP BY prediction"),
)
def cluster_sizes(spark, folder):
    return IN.cluster_sizes(grouped_encounters(spark, folder))


@add(
    "ag14_cluster_averages",
    S.on_groups(f"SELECT prediction, {rounded_sql(OUT)} FROM profile", FOUR),
)
def cluster_averages(spark, folder):
    return rounded(IN.averages(grouped_encounters(spark, folder), MEASURES), OUT)


BY_DICT = {"time_in_hospital": "mean", "num_medications": "mean", "num_lab_procedures": "max"}


@add(
    "ag15_averages_by_dict",
    S.on_groups(
        "SELECT prediction, round(avg(time_in_hospital), 8) AS mean_time_in_hospital, "
        "round(avg(num_medications), 8) AS mean_num_medications, "
        "max(num_lab_procedures) AS max_num_lab_procedures FROM grouped GROUP BY prediction"
    ),
)
def averages_by_dict(spark, folder):
    found = IN.averages_by_dict(grouped_encounters(spark, folder), BY_DICT)
    return rounded(found, ["mean_time_in_hospital", "mean_num_medications"])


RATE_MEASURES = MEASURES | {"num_procedures": "procedures"}
EVENTS = "count(CASE WHEN readmitted = '<30' THEN 1 END)"


def _rate_profile(spark, folder):
    early = F.col("readmitted") == "<30"
    return IN.profile_with_rate(by_patient(spark, folder), RATE_MEASURES, early)


@add(
    "ag16_profile_with_events",
    S.on_encounters(
        "SELECT prediction, count(*) AS n, "
        + ", ".join(f"round(avg({c}), 8) AS {out}" for c, out in RATE_MEASURES.items())
        + f", {EVENTS} AS events FROM nine GROUP BY prediction",
        NINE,
    ),
)
def profile_with_events(spark, folder):
    return rounded(_rate_profile(spark, folder), list(RATE_MEASURES.values()))


@add(
    "ag17_event_rate",
    S.on_encounters(
        f"SELECT prediction, count(*) AS n, {EVENTS} AS events, "
        f"round_even({EVENTS} * 100.0 / count(*), 2) AS rate FROM nine GROUP BY prediction",
        NINE,
    ),
)
def event_rate(spark, folder):
    return IN.with_rate(_rate_profile(spark, folder)).select("prediction", "n", "events", "rate")


@add(
    "ag18_normalised_profile",
    S.on_encounters(
        "SELECT prediction, "
        + ", ".join(
            f"round(({n} - min({n}) OVER ()) / (max({n}) OVER () - min({n}) OVER () + 1e-6), 8) AS {n}"
            for n in OUT
        )
        + " FROM profile",
        NINE,
    ),
)
def normalised_profile(spark, folder):
    profile = IN.averages(by_patient(spark, folder), MEASURES)
    return rounded(IN.normalised(profile, OUT), OUT)


# ---------------------------------------------------------------- values and tokens
LONG_GROUPS = (
    f", long AS ({S.unpivoted('grouped', INTERPRETED, ['prediction'])}), "
    "counted AS (SELECT prediction, variable, value, count(*) AS n FROM long GROUP BY ALL), "
    "shared AS (SELECT *, n * 100.0 / sum(n) OVER (PARTITION BY prediction, variable) AS percent "
    "FROM counted)"
)


@add(
    "ag19_share_in_cluster",
    S.on_groups(
        "SELECT prediction, variable, value, n, round(percent, 8) AS percent FROM shared", LONG_GROUPS
    ),
)
def share_in_cluster(spark, folder):
    found = P.category_shares(grouped_encounters(spark, folder), INTERPRETED, ["prediction"])
    return rounded(found, ["percent"])


@add(
    "w1_dominant_values",
    S.on_groups(
        "SELECT prediction, variable, value, n, round_even(percent, 2) AS percent, place FROM ("
        "SELECT *, CAST(row_number() OVER (PARTITION BY prediction, variable ORDER BY n DESC, value) "
        "AS INTEGER) AS place FROM shared) WHERE place <= 3",
        LONG_GROUPS,
    ),
)
def dominant_values(spark, folder):
    return IN.dominant_values(grouped_encounters(spark, folder), INTERPRETED)


CATEGORIES, DRUGS = ["race", "gender", "age"], ["metformin", "insulin"]


def _tokens_sql(key: str, source: str, categories: list[str], drugs: list[str]) -> str:
    def part(name: str, joint: str, none: list[str]) -> str:
        excluded = ", ".join(S.quoted(v) for v in none)
        return (
            f"SELECT {key}, '{name}{joint}' || {name} AS token FROM {source} "
            f"WHERE {name} NOT IN ({excluded})"
        )

    parts = [part(c, "=", EMPTY_CATEGORY) for c in categories]
    return " UNION ALL ".join(parts + [part(d, "_", INACTIVE_DRUG) for d in drugs])


@add(
    "ag20_cluster_tokens",
    S.on_groups(
        "SELECT prediction, token, count(*) AS n FROM ("
        + _tokens_sql("prediction", "grouped", CATEGORIES, DRUGS)
        + ") GROUP BY prediction, token"
    ),
)
def cluster_tokens(spark, folder):
    return IN.cluster_tokens(grouped_encounters(spark, folder), CATEGORIES, DRUGS)


@add(
    "in5_active_drugs",
    S.on_encounters(_tokens_sql("encounter_id", "encounters", [], DRUGS)),
)
def active_drugs(spark, folder):
    return IN.drug_tokens(encounters(spark, folder), "encounter_id", DRUGS)


# ---------------------------------------------------------------- ranks
@add(
    "w4_average_rank",
    S.on_encounters(
        "SELECT prediction, score, CAST(floor(rank() OVER (ORDER BY score DESC) + "
        "(count(*) OVER (PARTITION BY score) - 1) / 2.0) AS INTEGER) AS place FROM "
        "(SELECT prediction, round(labs, 0) AS score FROM profile)",
        NINE,
    ),
)
def average_rank(spark, folder):
    profile = IN.averages(by_patient(spark, folder), MEASURES)
    scored = profile.select("prediction", F.round("labs", 0).alias("score"))
    return IN.average_rank(scored, "score", "place")


LEADERS = (
    NINE + ", scored AS (SELECT *, inpatient + emergency AS rec, stay + drugs / 5 + labs / 10 AS inten "
    "FROM profile), first AS (SELECT *, row_number() OVER (ORDER BY rec DESC, prediction) AS a "
    "FROM scored), second AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN a = 1 THEN 1 ELSE 0 "
    "END, inten DESC, prediction) AS b FROM first), placed AS (SELECT *, CAST(row_number() OVER "
    "(ORDER BY CASE WHEN a = 1 THEN 1 WHEN b = 1 THEN 2 ELSE 3 END, prediction) AS INTEGER) AS place "
    "FROM second) "
)


def _scores():
    return IN.recurrence_score("inpatient", "emergency"), IN.intensity_score("stay", "drugs", "labs")


@add("w5_leaders", S.on_encounters("SELECT prediction, place FROM placed", LEADERS))
def leaders(spark, folder):
    profile = IN.averages(by_patient(spark, folder), MEASURES)
    return IN.leaders(profile, *_scores()).select("prediction", "place")


LEVEL_SQL = (
    NINE + ", levels AS (SELECT *, "
    + ", ".join(
        f"CASE WHEN max({n}) OVER () > min({n}) OVER () THEN ({n} - min({n}) OVER ()) / "
        f"(max({n}) OVER () - min({n}) OVER ()) ELSE 0.5 END AS {n}_n"
        for n in ("stay", "drugs", "labs", "inpatient", "emergency")
    )
    + " FROM profile), scored AS (SELECT *, (inpatient_n + emergency_n) / 2 AS rec, "
    "(drugs_n + stay_n) / 2 AS inten, labs_n AS lab FROM levels), "
    "labelled AS (SELECT *, CASE "
    f"WHEN rec > 0.6 THEN '{LEVEL_NAMES['recurrent']}' "
    f"WHEN lab > 0.6 AND rec < 0.5 THEN '{LEVEL_NAMES['evaluation']}' "
    f"WHEN inten > 0.6 THEN '{LEVEL_NAMES['drug']}' "
    f"WHEN lab > 0.4 AND rec < 0.4 THEN '{LEVEL_NAMES['followup']}' "
    f"WHEN inten > 0.4 THEN '{LEVEL_NAMES['adjusted']}' "
    f"ELSE '{LEVEL_NAMES['low']}' END AS label FROM scored), "
    "numbered AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY prediction) AS nth "
    "FROM labelled), named AS (SELECT *, CASE WHEN nth = 1 THEN label ELSE label || ' (subgrupo ' || "
    "CAST(nth AS VARCHAR) || ')' END AS name FROM numbered)"
)


@add("in1_names_by_level", S.on_encounters("SELECT prediction, name FROM named", LEVEL_SQL))
def names_by_level(spark, folder):
    profile = IN.averages(by_patient(spark, folder), MEASURES)
    return IN.named_by_level(profile).select("prediction", "name")


@add(
    "in4_named_report",
    S.on_encounters(f"SELECT prediction, name, {rounded_sql(OUT)} FROM named", LEVEL_SQL),
)
def named_report(spark, folder):
    profile = IN.averages(by_patient(spark, folder), MEASURES)
    return rounded(IN.named_by_level(profile), OUT).select("prediction", "name", *OUT)


@add(
    "w6_numbered_labels",
    S.on_encounters(
        "SELECT prediction, CASE WHEN nth = 1 THEN label ELSE label || ' (subgrupo ' || "
        "CAST(nth AS VARCHAR) || ')' END AS name FROM (SELECT *, row_number() OVER "
        "(PARTITION BY label ORDER BY prediction) AS nth FROM (SELECT prediction, "
        "CASE WHEN labs > 30 THEN 'high' ELSE 'low' END AS label FROM profile))",
        NINE,
    ),
)
def numbered_labels(spark, folder):
    profile = IN.averages(by_patient(spark, folder), MEASURES)
    label = F.when(F.col("labs") > 30, "high").otherwise("low")
    return IN.numbered_labels(profile.select("prediction", label.alias("name")))


# The three-name form works on means rounded to two places.
TWO_PLACES = LEADERS.replace(
    MEANS_SQL, ", ".join(f"round_even(avg({c}), 2) AS {out}" for c, out in MEASURES.items())
)


@add(
    "in2_names_by_score",
    S.on_encounters(
        f"SELECT prediction, CASE place WHEN 1 THEN '{SCORE_NAMES['recurrent']}' "
        f"WHEN 2 THEN '{SCORE_NAMES['complex']}' ELSE '{SCORE_NAMES['routine']}' END AS name "
        "FROM placed",
        TWO_PLACES,
    ),
)
def names_by_score(spark, folder):
    profile = IN.averages(by_patient(spark, folder), MEASURES)
    short = profile.withColumns({n: F.bround(n, 2) for n in OUT})
    return IN.named_by_score(short, *_scores()).select("prediction", "name")


@add(
    "in3_names_open_ended",
    S.on_encounters(
        f"SELECT prediction, CASE WHEN place = 1 THEN '{OPEN_NAMES['recurrent']}' "
        f"WHEN place = 2 THEN '{OPEN_NAMES['complex']}' "
        f"WHEN place = 3 THEN '{OPEN_NAMES['routine']}' "
        f"ELSE '{OPEN_NAMES['mixed']}' || CAST(place - 3 AS VARCHAR) END AS name FROM placed",
        LEADERS,
    ),
)
def names_open_ended(spark, folder):
    profile = IN.averages(by_patient(spark, folder), MEASURES)
    return IN.named_open_ended(profile, *_scores()).select("prediction", "name")


# ---------------------------------------------------------------- the whole analysis
@add("in4_named_report_fitted")
def named_report_fitted(spark, folder):
    found = segment(
        encounters(spark, folder), "encounter_id", CATEGORICAL,
        ["medical_specialty", *DIAGNOSES], NUMERIC, MEASURES,
    )
    return rounded(found.report, OUT, 4).select("prediction", "name", *OUT)
