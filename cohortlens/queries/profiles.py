"""Sources, sinks and column profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators import profile as P
from cohortlens.operators import rows as R
from cohortlens.queries import registry
from cohortlens.queries import sql as S
from cohortlens.sources import tables as IO
from cohortlens.sources.encounters import CATEGORICAL, encounters
from cohortlens.sources.scratch import cached, fresh_path, written

add = registry.add
PRICES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def rounded(df: DataFrame, names: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# ---------------------------------------------------------------- sources and sinks
@add("io1_csv_scan", "SELECT * FROM customer")
def csv_scan(spark, folder):
    path = fresh_path(spark, "customer-csv")
    customers = IO.read_table(spark, folder, "customer")
    IO.write_csv(customers, path)
    return IO.read_csv(spark, path, customers.schema)


@add(
    "io1_csv_scan_inferred",
    "SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment "
    "FROM customer",
)
def csv_scan_inferred(spark, folder):
    path = fresh_path(spark, "customer-csv")
    IO.write_csv(IO.read_table(spark, folder, "customer"), path)
    found = IO.read_csv(spark, path)
    return found.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@add("io1_parquet_scan", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def parquet_scan(spark, folder):
    return IO.read_table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )


CUSTOMER_COLUMNS = [
    ("c_custkey", "bigint", "numeric"),
    ("c_name", "string", "categorical"),
    ("c_nationkey", "int", "numeric"),
    ("c_acctbal", "double", "numeric"),
    ("c_mktsegment", "string", "categorical"),
]


@add(
    "io2_schema_report",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{n}' AS column_name, '{t}' AS data_type, '{k}' AS kind, "
        f"count({n}) AS known FROM customer"
        for i, (n, t, k) in enumerate(CUSTOMER_COLUMNS, start=1)
    ),
)
def schema_report(spark, folder):
    return P.schema_report(IO.read_table(spark, folder, "customer"))


@add(
    "io3_columns_by_type",
    "SELECT kind, count(*) AS n_columns, CAST(sum(known) AS BIGINT) AS known, "
    "min(column_name) AS first_name, max(column_name) AS last_name FROM ("
    + " UNION ALL ".join(
        f"SELECT '{k}' AS kind, '{n}' AS column_name, count({n}) AS known FROM customer"
        for n, _, k in CUSTOMER_COLUMNS
    )
    + ") GROUP BY kind",
)
def columns_by_type(spark, folder):
    customers = IO.read_table(spark, folder, "customer")
    names = P.columns_of_kind(customers, "numeric") + P.columns_of_kind(customers, "categorical")
    return (
        P.schema_report(customers.select(*names))
        .groupBy("kind")
        .agg(
            F.count(F.lit(1)).alias("n_columns"),
            F.sum("known").alias("known"),
            F.min("column_name").alias("first_name"),
            F.max("column_name").alias("last_name"),
        )
    )


@add("io4_shape", "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem")
def shape(spark, folder):
    return IO.shape(IO.read_table(spark, folder, "lineitem"))


@add(
    "io5_head_preview",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority "
    "FROM orders ORDER BY o_orderkey LIMIT 5",
)
def head_preview(spark, folder):
    return IO.head(IO.read_table(spark, folder, "orders").drop("o_orderdate"), "o_orderkey", 5)


@add("io6_small_result", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def small_result(spark, folder):
    counts = (
        IO.read_table(spark, folder, "lineitem")
        .groupBy("l_returnflag")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return IO.local_rows(spark, IO.to_driver(counts, 1_000), counts.schema)


@add(
    "io7_local_rows",
    "SELECT o.o_orderpriority, r.urgency, count(*) AS n FROM orders o JOIN (VALUES "
    "('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3)) r(priority, urgency) "
    "ON r.priority = o.o_orderpriority GROUP BY o.o_orderpriority, r.urgency",
)
def local_rows(spark, folder):
    rules = IO.local_rows(
        spark,
        [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3)],
        "o_orderpriority string, urgency int",
    )
    return (
        IO.read_table(spark, folder, "orders")
        .join(rules, "o_orderpriority")
        .groupBy("o_orderpriority", "urgency")
        .agg(F.count(F.lit(1)).alias("n"))
    )


SHARES_SQL = (
    "SELECT o_orderstatus, o_orderpriority, count(*) AS n, avg(o_totalprice) AS mean_price "
    "FROM orders GROUP BY o_orderstatus, o_orderpriority"
)


def _order_groups(spark, folder):
    return (
        IO.read_table(spark, folder, "orders")
        .groupBy("o_orderstatus", "o_orderpriority")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("mean_price"))
    )


@add(
    "io8_csv_sink",
    f"SELECT o_orderstatus, o_orderpriority, n, round(mean_price, 4) AS mean_price "
    f"FROM ({SHARES_SQL})",
)
def csv_sink(spark, folder):
    path = fresh_path(spark, "groups-csv")
    groups = _order_groups(spark, folder)
    IO.write_csv(groups, path)
    return rounded(IO.read_csv(spark, path, groups.schema), ["mean_price"], 4)


@add(
    "io9_json_sink",
    "SELECT o_orderstatus, o_orderpriority, n, round(mean_price, 4) AS mean_price FROM "
    f"({SHARES_SQL}) ORDER BY n DESC, o_orderstatus, o_orderpriority LIMIT 1",
)
def json_sink(spark, folder):
    path = fresh_path(spark, "best-json")
    groups = _order_groups(spark, folder)
    best = groups.orderBy(F.desc("n"), "o_orderstatus", "o_orderpriority").limit(1)
    IO.write_json(best, path)
    return rounded(spark.read.schema(best.schema).json(path), ["mean_price"], 4)


@add(
    "io10_cached_reuse",
    "SELECT l_returnflag, count(*) AS n, round(avg(l_quantity), 6) AS mean_quantity, "
    "(SELECT count(*) FROM lineitem WHERE l_discount > 0.05) AS n_all "
    "FROM lineitem WHERE l_discount > 0.05 GROUP BY l_returnflag",
)
def cached_reuse(spark, folder):
    items = IO.read_table(spark, folder, "lineitem").where("l_discount > 0.05")
    with cached(items.select("l_returnflag", "l_quantity")) as held:
        total = held.count()
        groups = held.groupBy("l_returnflag").agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.avg("l_quantity"), 6).alias("mean_quantity"),
        )
        rows = IO.to_driver(groups, 1_000)
    return IO.local_rows(spark, rows, groups.schema).withColumn(
        "n_all", F.lit(total).cast("bigint")
    )


# ---------------------------------------------------------------- frequencies
@add("ag1_category_frequency", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def category_frequency(spark, folder):
    return P.frequency(IO.read_table(spark, folder, "lineitem"), "l_returnflag")


SHARE_COLUMNS = [*CATEGORICAL, "readmitted", "diag_1"]


@add(
    "ag2_category_percent",
    S.on_encounters(
        "SELECT variable, value, count(*) AS n, "
        "round(count(*) * 100.0 / (SELECT count(*) FROM encounters), 6) AS percent "
        f"FROM ({S.unpivoted('encounters', SHARE_COLUMNS)}) GROUP BY variable, value"
    ),
)
def category_percent(spark, folder):
    return rounded(P.category_shares(encounters(spark, folder), SHARE_COLUMNS), ["percent"])


# ---------------------------------------------------------------- numeric columns
@add(
    "ag3_numeric_summary",
    "SELECT variable, count(value) AS n_known, round(avg(value), 7) AS mean, "
    "round(stddev_samp(value), 7) AS deviation, min(value) AS minimum, "
    "quantile_disc(value, 0.25) AS q25, quantile_disc(value, 0.5) AS q50, "
    "quantile_disc(value, 0.75) AS q75, max(value) AS maximum "
    f"FROM ({S.unpivoted('lineitem', PRICES, cast='DOUBLE')}) GROUP BY variable",
)
def numeric_summary(spark, folder):
    items = IO.read_table(spark, folder, "lineitem")
    return rounded(P.numeric_summary(items, PRICES), ["mean", "deviation"], 7)


def _histogram_sql(table: str, names: list[str], bins: str) -> str:
    return f"""
WITH long AS ({S.unpivoted(table, names, cast="DOUBLE")}),
span AS (SELECT variable, count(value) AS total, min(value) AS low, max(value) AS high,
                quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr
         FROM long GROUP BY variable),
sized AS (SELECT *, CAST({bins} AS INTEGER) AS bins FROM span),
ruled AS (SELECT *, (high - low) / bins AS width FROM sized),
grid AS (SELECT *, CAST(unnest(range(bins)) AS INTEGER) AS bin FROM ruled),
hits AS (SELECT l.variable, CAST(least(floor((value - low) / width), bins - 1) AS INTEGER) AS bin,
                count(*) AS n
         FROM long l JOIN ruled r ON r.variable = l.variable WHERE value IS NOT NULL
         GROUP BY ALL)
SELECT g.variable, g.bin, round(low + g.bin * width, 6) AS lower,
       round(low + (g.bin + 1) * width, 6) AS upper,
       coalesce(h.n, 0) AS n, round(coalesce(h.n, 0) * 100.0 / total, 6) AS percent
FROM grid g LEFT JOIN hits h ON h.variable = g.variable AND h.bin = g.bin"""


@add("ag4_histogram_percent", _histogram_sql("lineitem", PRICES, "20"))
def histogram_percent(spark, folder):
    items = IO.read_table(spark, folder, "lineitem")
    return rounded(P.histogram(items, PRICES, 20), ["lower", "upper", "percent"])


AUTOMATIC = (
    "ceil((high - low) / least(CASE WHEN iqr > 0 THEN 2.0 * iqr * pow(total, -1.0 / 3) "
    "ELSE high - low END, (high - low) / (log2(total) + 1)))"
)


@add("ag5_histogram_counts", _histogram_sql("orders", ["o_totalprice", "o_custkey"], AUTOMATIC))
def histogram_counts(spark, folder):
    orders = IO.read_table(spark, folder, "orders")
    found = P.histogram(orders, ["o_totalprice", "o_custkey"], "auto")
    return rounded(found, ["lower", "upper", "percent"])


@add(
    "ag6_density_curve",
    f"""
WITH long AS ({S.unpivoted("lineitem", ["l_quantity", "l_extendedprice"], cast="DOUBLE")}),
span AS (SELECT variable, count(value) AS total, min(value) AS low,
                (max(value) - min(value)) / 199 AS step,
                stddev_samp(value) * pow(count(value), -1.0 / 5) AS width
         FROM long GROUP BY variable),
merged AS (SELECT variable, value, count(*) AS n FROM long GROUP BY ALL),
grid AS (SELECT *, CAST(unnest(range(200)) AS INTEGER) AS point FROM span)
SELECT g.variable, g.point, round(low + point * step, 6) AS x,
       round(sum(n * exp(-0.5 * pow((low + point * step - value) / width, 2)))
             / (total * width * sqrt(2 * pi())), 10) AS density
FROM grid g JOIN merged m ON m.variable = g.variable
GROUP BY g.variable, g.point, low, step, total, width""",
)
def density_curve(spark, folder):
    items = IO.read_table(spark, folder, "lineitem")
    found = P.density(items, ["l_quantity", "l_extendedprice"])
    return rounded(rounded(found, ["x"]), ["density"], 10)


def _box_sql(source: str, keys: list[str]) -> str:
    keyed = "".join(f"{k}, " for k in keys)
    on = " AND ".join(f"b.{k} IS NOT DISTINCT FROM l.{k}" for k in [*keys, "variable"])
    lead = "".join(f"l.{k}, " for k in [*keys, "variable"])
    inside = "value BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)"
    return f"""
long AS ({source}),
box AS (SELECT {keyed}variable, quantile_cont(value, 0.25) AS q25,
               quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.75) AS q75
        FROM long GROUP BY ALL)
SELECT {lead}count(value) AS n_known, round(q25, 6) AS q25, round(q50, 6) AS q50,
       round(q75, 6) AS q75, min(CASE WHEN {inside} THEN value END) AS low_whisker,
       max(CASE WHEN {inside} THEN value END) AS high_whisker,
       CAST(sum(CASE WHEN value IS NULL OR {inside} THEN 0 ELSE 1 END) AS BIGINT) AS outliers
FROM long l JOIN box b ON {on} GROUP BY {lead}q25, q50, q75"""


@add(
    "ag7_box_stats",
    "WITH " + _box_sql(S.unpivoted("lineitem", PRICES, cast="DOUBLE"), []),
)
def box_stats(spark, folder):
    items = IO.read_table(spark, folder, "lineitem")
    return rounded(P.box_stats(items, PRICES), ["q25", "q50", "q75"])


BOXED = ["time_in_hospital", "num_medications"]


@add(
    "ag8_box_stats_by_group",
    S.on_encounters(
        _box_sql(S.unpivoted("chosen", BOXED, ["gender"], "DOUBLE"), ["gender"]),
        ", chosen AS (SELECT * FROM encounters WHERE gender IN ('F', 'O')), ",
    ),
)
def box_stats_by_group(spark, folder):
    chosen = R.keep_values(encounters(spark, folder), "gender", ["F", "O"])
    chosen = written(chosen.select("gender", *BOXED), "boxed")
    return rounded(P.box_stats(chosen, BOXED, ["gender"]), ["q25", "q50", "q75"])


# ---------------------------------------------------------------- sorting
@add(
    "t1_global_sort",
    "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey",
)
def global_sort(spark, folder):
    return P.frequency(IO.read_table(spark, folder, "lineitem"), "l_partkey")


@add(
    "t2_top_k",
    "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey "
    "ORDER BY n DESC, l_partkey LIMIT 30",
)
def top_k(spark, folder):
    return P.frequency(IO.read_table(spark, folder, "lineitem"), "l_partkey").limit(30)
