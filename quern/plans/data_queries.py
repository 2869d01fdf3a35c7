"""Queries p3, p4 and p5 over the domain tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.lookalike import key_sql
from quern.operators.impute import Target, fill_missing
from quern.operators.packed import unpack
from quern.operators.snapshots import snapshot_changes
from quern.session import table

RECORD = ["school_code", "major_code"]


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records added, removed or changed between consecutive deliveries."""
    history = snapshot_changes(table(spark, sf_dir, "history_snapshots"), RECORD, ["school", "school_cat", "major", "subject"], ["j", "t"])
    deleted = snapshot_changes(table(spark, sf_dir, "deleted_snapshots"), RECORD, ["school", "school_cat", "major"], ["j", "t"])
    both = history.withColumn("tbl", F.lit("history_snapshots")).unionByName(deleted.withColumn("tbl", F.lit("deleted_snapshots")))
    return both.select("tbl", F.col("snapshot_no").cast("int").alias("snapshot_no"), *RECORD, "change_kind")


def p3_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records changed in each way, by table and delivery."""
    return p3_found(spark, sf_dir).groupBy("tbl", "snapshot_no", "change_kind").agg(F.count(F.lit(1)).alias("n"))


# No history (level 2) leaves nothing due; one past row has no deviation.
_SOME = "NOT coalesce(est_level = 2, false)"
ESTIMATES = (
    Target("est_value", "coalesce(est_value BETWEEN -200 AND 400 AND NOT isnan(est_value), false)", _SOME),
    Target("est_t", "coalesce(est_t >= 0 AND NOT isnan(est_t), false)", f"{_SOME} AND NOT coalesce(est_n = 1, false)"),
    Target("est_level", "coalesce(est_level IN (0, 1, 2), false)", _SOME, "mode"),
    Target("est_n", "coalesce(est_n >= 0, false)", _SOME, "whole"),
)
# What may determine an estimate: every attribute of a row and every two of them.
ATTRIBUTES = ("src_row_idx", "run_year", "school", "school_cat", "major", "stripped", "core", "subject", "batch", "log")
GROUPS = (("school", "run_year"), ("school",))


def p4_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """edge_rows with every estimate filled where it can be, and by what."""
    return fill_missing(table(spark, sf_dir, "edge_rows"), ESTIMATES, ATTRIBUTES, GROUPS, row_id="edge_id")


def p4_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filled values and their sources."""
    return p4_rows(spark, sf_dir).select("edge_id", *[f"{t.name}_{x}" for t in ESTIMATES for x in ("filled", "source")])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per cell that was missing, due and filled, if its school holds a
    usable value too (a dependency may know more than the school)."""
    marks = [
        F.when(~F.col(f"{t.name}_source").isin("own", "not_due", "none") & F.col(f"{t.name}_filled").isNotNull() & (F.col(f"{t.name}_peers") > 0), F.lit(t.name))
        for t in ESTIMATES
    ]
    return p4_rows(spark, sf_dir).select("edge_id", F.explode(F.array_compact(F.array(*marks))).alias("field_name"))


def p4_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many cells of each field were filled by which source."""
    pairs = F.array(*[F.struct(F.lit(t.name).alias("field_name"), F.col(f"{t.name}_source").alias("source")) for t in ESTIMATES])
    return p4_rows(spark, sf_dir).select(F.explode(pairs).alias("p")).groupBy("p.field_name", "p.source").agg(F.count(F.lit(1)).alias("n"))


def subject_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary of subject names."""
    return table(spark, sf_dir, "subject_names").select("subject_name").where(F.col("subject_name").isNotNull())


def _subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = table(spark, sf_dir, "plan_rows").select(F.lit("plan_rows").alias("tbl"), F.col("src_row_idx").cast("long").alias("row_key"), "subject")
    past = table(spark, sf_dir, "history_rows").select(F.lit("history_rows").alias("tbl"), F.col("hist_pos").cast("long").alias("row_key"), "subject")
    return plan.unionByName(past)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per value of each subject field that holds two or more."""
    out = unpack(_subjects(spark, sf_dir), "subject", subject_names(spark, sf_dir), least=2)
    return out.select("tbl", "row_key", "val_no", "subject_name")


def p5_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per value of every subject field, single values included."""
    out = unpack(_subjects(spark, sf_dir), "subject", subject_names(spark, sf_dir))
    return out.select("tbl", "row_key", "val_no", "subject_name")


QUERIES = {f.__name__: f for f in (p3_found, p3_counts, p4_found, p4_filled, p4_provenance, p5_found, p5_all)}


def _change_sql(tbl: str, texts: list[str]) -> str:
    cols = ", ".join([f"coalesce({key_sql(c)}, '') AS {c}" for c in texts] + [f"round(CASE WHEN isnan({c}) THEN NULL ELSE {c} END, 2) AS {c}" for c in ("j", "t")])
    same = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in [*texts, "j", "t"])
    return f"""
    SELECT '{tbl}' AS tbl, CAST(n.snapshot_no AS INTEGER) AS snapshot_no, school_code, major_code, change_kind FROM (
      WITH one AS (
        SELECT snapshot_no, school_code, major_code, {cols} FROM {tbl}
        QUALIFY row_number() OVER (PARTITION BY snapshot_no, school_code, major_code ORDER BY loaded_at DESC) = 1),
      ix AS (SELECT snapshot_no, row_number() OVER (ORDER BY snapshot_no) AS i FROM (SELECT DISTINCT snapshot_no FROM {tbl})),
      z AS (SELECT one.*, i FROM one JOIN ix USING (snapshot_no))
      SELECT b.i AS i, b.school_code, b.major_code, CASE WHEN a.i IS NULL THEN 'added' ELSE 'changed' END AS change_kind
      FROM z b LEFT JOIN z a ON a.i = b.i - 1 AND a.school_code = b.school_code AND a.major_code = b.major_code
      WHERE b.i > 1 AND (a.i IS NULL OR NOT ({same}))
      UNION ALL
      SELECT a.i + 1, a.school_code, a.major_code, 'removed' FROM z a
      WHERE a.i < (SELECT max(i) FROM ix) AND NOT EXISTS (SELECT 1 FROM z b WHERE b.i = a.i + 1 AND a.school_code = b.school_code AND a.major_code = b.major_code)
    ) c JOIN (SELECT snapshot_no, row_number() OVER (ORDER BY snapshot_no) AS i FROM (SELECT DISTINCT snapshot_no FROM {tbl})) n USING (i)"""


def _names_sql(least: int) -> str:
    names = "(SELECT string_agg(regexp_escape(subject_name), '|' ORDER BY length(subject_name) DESC) FROM subject_names)"
    return f"""
    WITH f AS (
      SELECT 'plan_rows' AS tbl, CAST(src_row_idx AS BIGINT) AS row_key, subject FROM plan_rows
      UNION ALL SELECT 'history_rows', hist_pos, subject FROM history_rows),
    v AS (SELECT tbl, row_key, regexp_extract_all(replace(subject, '""', '"'), {names}) AS vals FROM f WHERE subject IS NOT NULL)
    SELECT tbl, row_key, CAST(unnest(generate_series(1, len(vals))) AS INTEGER) AS val_no, unnest(vals) AS subject_name
    FROM v WHERE len(vals) >= {least}"""


def _holes_sql() -> str:
    parts = []
    for t in ESTIMATES:
        parts.append(f"""
        SELECT edge_id, '{t.name}' AS field_name FROM edge_rows e WHERE NOT ({t.usable}) AND ({t.due})
        AND school IN (SELECT school FROM edge_rows WHERE {t.usable})""")
    return " UNION ALL ".join(parts)


def _filled_sql(width: int = 2, tolerance: float = 0.05, least_groups: int = 3) -> str:
    """All sets of attributes are tested, minimal ones kept; a cell takes the
    value of the first that tells, then that of its groups."""
    sets = [det for size in range(1, width + 1) for det in combinations(ATTRIBUTES, size)]
    known = lambda cols: " AND ".join(f"coalesce(trim(CAST({c} AS VARCHAR)), '') <> ''" for c in cols)
    key = lambda cols: " || chr(1) || ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    rows = " UNION ALL ".join(f"SELECT {i} AS det, {key(det)} AS k, * FROM E WHERE {known(det)}" for i, det in enumerate(sets))
    stats = ", ".join(f"min(u_{t.name}) AS lo_{t.name}, max(u_{t.name}) AS hi_{t.name}, count(u_{t.name}) AS n_{t.name}" for t in ESTIMATES)
    within = ", ".join(f"({i}, {j})" for i, a in enumerate(sets) for j, b in enumerate(sets) if set(b) < set(a))
    names = ", ".join(f"({i}, 'fd:{'+'.join(det)}')" for i, det in enumerate(sets))
    holds = " UNION ALL ".join(
        f"SELECT det, '{t.name}' AS f FROM S GROUP BY det HAVING count(*) FILTER (n_{t.name} >= 2) >= {least_groups} AND count(*) FILTER (n_{t.name} >= 2 AND lo_{t.name} <> hi_{t.name}) <= {tolerance} * count(*) FILTER (n_{t.name} >= 2)"
        for t in ESTIMATES
    )
    ctes, cells = [], []
    for t in ESTIMATES:
        c = t.name
        told = f"SELECT row_no, arg_min(lo_{c}, det) AS v, min(det) AS det FROM R JOIN S USING (det, k) WHERE lo_{c} = hi_{c} AND det IN (SELECT det FROM M WHERE f = '{c}') GROUP BY row_no"
        ctes.append(f"D_{c} AS MATERIALIZED ({told})")
        for g, by in enumerate(GROUPS):
            cols = ", ".join(by)
            mean = f"CAST(sum(CAST(u_{c} AS DECIMAL(28, 4))) AS DOUBLE) / count(u_{c})"
            how = {"mean": f"floor({mean} * 100 + 0.5) / 100", "whole": f"floor({mean} + 0.5)"}.get(t.how)
            if how:
                ctes.append(f"G{g}_{c} AS (SELECT {cols}, {how} AS v FROM E WHERE {known(by)} AND u_{c} IS NOT NULL GROUP BY {cols})")
            else:
                ctes.append(f"G{g}_{c} AS (SELECT {cols}, u_{c} AS v FROM (SELECT {cols}, u_{c}, count(*) AS n FROM E WHERE {known(by)} AND u_{c} IS NOT NULL GROUP BY {cols}, u_{c}) QUALIFY row_number() OVER (PARTITION BY {cols} ORDER BY n DESC, u_{c}) = 1)")
        joins = " ".join(f"LEFT JOIN G{g}_{c} ON " + " AND ".join(f"G{g}_{c}.{x} = E.{x}" for x in by) for g, by in enumerate(GROUPS))
        kind = "INTEGER" if c in ("est_level", "est_n") else "DOUBLE"
        values = ", ".join([f"D_{c}.v", *[f"G{g}_{c}.v" for g in range(len(GROUPS))]])
        sources = f"WHEN D_{c}.v IS NOT NULL THEN N.name " + " ".join(f"WHEN G{g}_{c}.v IS NOT NULL THEN 'group:{'+'.join(by)}'" for g, by in enumerate(GROUPS))
        cells.append(f"""C_{c} AS (SELECT E.row_no, CAST(CASE WHEN u_{c} IS NOT NULL THEN u_{c} WHEN {t.due} THEN coalesce({values}) END AS {kind}) AS {c}_filled,
          CASE WHEN u_{c} IS NOT NULL THEN 'own' WHEN NOT ({t.due}) THEN 'not_due' {sources} ELSE 'none' END AS {c}_source
          FROM E LEFT JOIN D_{c} ON D_{c}.row_no = E.row_no LEFT JOIN N ON N.det = D_{c}.det {joins})""")
    usable = ", ".join(f"CASE WHEN {t.usable} THEN {t.name} END AS u_{t.name}" for t in ESTIMATES)
    out = ", ".join(f"{t.name}_filled, {t.name}_source" for t in ESTIMATES)
    return f"""WITH E AS MATERIALIZED (SELECT *, row_number() OVER () AS row_no, {usable} FROM edge_rows),
    R AS MATERIALIZED ({rows}), S AS MATERIALIZED (SELECT det, k, {stats} FROM R GROUP BY det, k),
    N(det, name) AS (VALUES {names}), W(det, part) AS (VALUES {within}), H AS MATERIALIZED ({holds}),
    M AS MATERIALIZED (SELECT * FROM H WHERE NOT EXISTS (SELECT 1 FROM W JOIN H b ON b.det = W.part WHERE W.det = H.det AND b.f = H.f)),
    {", ".join(ctes + cells)}
    SELECT edge_id, {out} FROM E """ + " ".join(f"JOIN C_{t.name} USING (row_no)" for t in ESTIMATES)


def _provenance_sql() -> str:
    each = " UNION ALL ".join(f"SELECT '{t.name}' AS field_name, {t.name}_source AS source FROM F" for t in ESTIMATES)
    return f"SELECT field_name, source, count(*) AS n FROM (WITH F AS MATERIALIZED ({_filled_sql()}) {each}) GROUP BY ALL"


def oracle() -> dict[str, str]:
    p3 = _change_sql("history_snapshots", ["school", "school_cat", "major", "subject"]) + " UNION ALL " + _change_sql("deleted_snapshots", ["school", "school_cat", "major"])
    return {
        "p3_found": p3,
        "p3_counts": f"SELECT tbl, snapshot_no, change_kind, count(*) AS n FROM ({p3}) GROUP BY ALL",
        "p4_found": _holes_sql(),
        "p4_filled": _filled_sql(),
        "p4_provenance": _provenance_sql(),
        "p5_found": _names_sql(2),
        "p5_all": _names_sql(1),
    }
