"""SQL fragments shared by the reference statements."""

from cohortlens.functions.fixed import NOISY_TEXT

ENCOUNTERS = """
SELECT o.o_orderkey AS encounter_id,
       o.o_custkey AS patient_nbr,
       c.c_mktsegment AS race,
       o.o_orderstatus AS gender,
       CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN '?' ELSE o.o_orderpriority END AS age,
       i.medical_specialty, i.diag_1, i.diag_2, i.diag_3,
       CASE WHEN i.returned = 'R' THEN '<30' ELSE 'NO' END AS readmitted,
       CASE WHEN c.c_acctbal < 3000 THEN 'No' ELSE 'Steady' END AS metformin,
       CASE WHEN o.o_totalprice < 100000 THEN 'No'
            WHEN o.o_totalprice < 250000 THEN 'Steady' ELSE 'Up' END AS insulin,
       i.time_in_hospital, i.num_medications, i.num_lab_procedures,
       i.num_procedures, i.number_diagnoses, i.number_inpatient, i.number_outpatient,
       i.number_emergency
FROM orders o
JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN (
  SELECT l.l_orderkey,
         min(p.p_type) AS medical_specialty,
         min(p.p_brand) AS diag_1, max(p.p_brand) AS diag_2, max(p.p_name) AS diag_3,
         max(l.l_returnflag) AS returned,
         CAST(count(*) AS BIGINT) AS time_in_hospital,
         CAST(sum(l.l_quantity) AS BIGINT) AS num_medications,
         CAST(max(p.p_size) AS BIGINT) AS num_lab_procedures,
         CAST(sum(CASE WHEN l.l_tax > 0.04 THEN 1 ELSE 0 END) AS BIGINT) AS num_procedures,
         CAST(count(DISTINCT p.p_brand) AS BIGINT) AS number_diagnoses,
         CAST(sum(CASE WHEN l.l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS number_outpatient,
         CAST(sum(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS number_inpatient,
         CAST(sum(CASE WHEN l.l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS number_emergency
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
  GROUP BY l.l_orderkey
) i ON i.l_orderkey = o.o_orderkey
"""

GROUPED = """
SELECT *, CAST(least(coalesce(number_inpatient, 0), 3) AS INTEGER) AS prediction FROM encounters
"""


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def on_encounters(statement: str, more: str = "") -> str:
    """A statement over ``encounters`` and, if named, further common tables."""
    return f"WITH encounters AS ({ENCOUNTERS}){more} {statement}"


def on_groups(statement: str, more: str = "") -> str:
    return on_encounters(statement, f", grouped AS ({GROUPED}){more}")


# Documents with the noisy text put in place of document 0.
NOISY_DOCUMENTS = (
    "noisy AS (SELECT doc_id, CASE WHEN doc_id = 0 THEN "
    + quoted(NOISY_TEXT)
    + " ELSE text END AS text FROM documents)"
)


def on_noisy(statement: str, more: str = "") -> str:
    return f"WITH {NOISY_DOCUMENTS}{more} {statement}"


def unpivoted(table: str, names: list[str], keys: list[str] = (), cast: str = "VARCHAR") -> str:
    """Columns in long form as a UNION ALL, NULLs included."""
    lead = "".join(f"{k}, " for k in keys)
    return " UNION ALL ".join(
        f"SELECT {lead}'{n}' AS variable, CAST({n} AS {cast}) AS value FROM {table}" for n in names
    )


def silhouette_tables(points: str) -> str:
    """Common tables for the silhouette of ``points(run, id, cl, vec)``, one per run.

    Ends in ``scores(run, silhouette)``.
    """
    return f"""
pts AS ({points}),
u AS (SELECT run, id, cl, unnest(range(1, len(vec) + 1)) AS axis, unnest(vec) AS v FROM pts),
axis_sums AS (SELECT run, cl, axis, sum(v) AS y FROM u GROUP BY ALL),
cluster_sums AS (SELECT run, cl, count(DISTINCT id) AS n, sum(v * v) AS psi FROM u GROUP BY ALL),
norms AS (SELECT run, id, cl, sum(v * v) AS q FROM u GROUP BY ALL),
dots AS (SELECT u.run, u.id, a.cl, sum(u.v * a.y) AS d
         FROM u JOIN axis_sums a ON a.run = u.run AND a.axis = u.axis GROUP BY ALL),
dist AS (SELECT p.run, p.id, p.cl = d.cl AS own, c.n,
                p.q + c.psi / c.n - 2 * d.d / c.n AS m
         FROM norms p JOIN dots d ON d.run = p.run AND d.id = p.id
         JOIN cluster_sums c ON c.run = d.run AND c.cl = d.cl),
ab AS (SELECT run, id, max(CASE WHEN own THEN n END) AS n,
              max(CASE WHEN own AND n > 1 THEN m * n / (n - 1) END) AS a,
              min(CASE WHEN NOT own THEN m END) AS b
       FROM dist GROUP BY ALL),
scores AS (SELECT run, avg(CASE WHEN n = 1 THEN 0 WHEN greatest(a, b) = 0 THEN 0
                                ELSE (b - a) / greatest(a, b) END) AS silhouette
           FROM ab GROUP BY run)"""
