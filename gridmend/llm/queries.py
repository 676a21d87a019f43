"""Queries of the training-text problems over the whole tables, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmend.llm import leakage, packing, pii, quantiles
from gridmend.llm.tokens import with_tokens
from gridmend.sources.tables import checkpoint_dir, table

ERROR, AT = 0.01, [0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
CLEAN = "conso_historiques_clean"


def p2_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles of Ptot_HA by station and day, by name, by station and by day, all merged from one sketch by name, station and day.

    A null name, station or day is a group; in the key of station and day, ``station day``, it is empty.
    """
    t = table(spark, d, CLEAN)
    s = quantiles.sketch(t, {"name": F.col("name"), "poste_id": F.col("poste_id"), "day": F.date_format(F.to_date("Date"), "yyyy-MM-dd")}, F.col("Ptot_HA"), ERROR)
    both = F.concat(F.coalesce(F.col("poste_id").cast("string"), F.lit("")), F.lit(" "), F.coalesce("day", F.lit("")))
    kinds = F.array(*[F.struct(F.lit(k).alias("grain"), c.cast("string").alias("key")) for k, c in (("name", F.col("name")), ("station", F.col("poste_id")), ("day", F.col("day")), ("station_day", both))])
    s = quantiles.merge(s.select("bucket", "n", F.explode(kinds).alias("x")).select("x.*", "bucket", "n"), ["grain", "key"])
    r = quantiles.percentiles(s, ["grain", "key"], AT, ERROR)
    return r.select("grain", "key", "p", "n", F.round("value", 3).alias("value"))


P2_BUCKET = """CASE WHEN isinf(v) THEN 1099511627776 WHEN abs(v) < 1e-9 THEN 0
 ELSE greatest(CAST(ceil((ln(abs(v)) - ln(1e-9)) / ln(1.01 / 0.99)) AS BIGINT), 1) END * CAST(sign(v) AS BIGINT)"""
SQL = {"p2_percentiles": f"""
WITH t AS (SELECT name, CAST(poste_id AS VARCHAR) AS station, strftime(Date, '%Y-%m-%d') AS day, Ptot_HA AS v FROM conso_historiques_clean WHERE Ptot_HA IS NOT NULL AND NOT isnan(Ptot_HA)),
     g AS (SELECT 'name' AS grain, name AS key, v FROM t UNION ALL SELECT 'station', station, v FROM t UNION ALL SELECT 'day', day, v FROM t
           UNION ALL SELECT 'station_day', coalesce(station, '') || ' ' || coalesce(day, ''), v FROM t),
     b AS (SELECT grain, key, {P2_BUCKET} AS bucket, count(*) AS n FROM g GROUP BY ALL),
     c AS (SELECT *, sum(n) OVER (PARTITION BY grain, key ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY grain, key) AS total FROM b),
     q AS (SELECT *, unnest([0.05, 0.25, 0.5, 0.75, 0.95, 0.99]) AS p FROM c)
SELECT grain, key, CAST(p AS DOUBLE) AS p, CAST(total AS BIGINT) AS n,
       round(CASE WHEN bucket = 0 THEN 0.0 ELSE sign(bucket) * exp((abs(bucket) - 1) * ln(1.01 / 0.99) + ln(1e-9)) * (2 * (1.01 / 0.99) / (1 + 1.01 / 0.99)) END, 3) AS value
FROM q WHERE greatest(ceil(p * total - 1e-9), 1) BETWEEN upto - n + 1 AND upto"""}
CAPACITY = 2048


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """Every text (or piece of one longer than a container) with its container. The counts are checkpointed: they are read twice."""
    checkpoint_dir(spark)
    sizes = with_tokens(table(spark, d, "documents"), "doc_id", "text").checkpoint()
    return packing.pack(spark, sizes, "doc_id", "n_tokens", CAPACITY)


def near_revisions() -> list:
    """Revisions of a page lie together, those of a busy page in groups of 64, so that no page fills a task."""
    return [F.col("page_id"), F.floor(F.col("rev_no") / 64)]


def p8_places(spark: SparkSession, d: str) -> DataFrame:
    return leakage.find_leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "passage", near_revisions())


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_places(spark, d).select("doc_id", "item_id").distinct()


def p8_removal_spans(spark: SparkSession, d: str) -> DataFrame:
    return leakage.removal_spans(p8_places(spark, d), "doc_id", "item_id")


def p9_documents(spark: SparkSession, d: str, masked: bool) -> DataFrame:
    t = table(spark, d, "documents")
    return pii.find_personal(t, "doc_id", "text", pii.fit(t, "text", "doc_id"), near_revisions(), masked)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_documents(spark, d, False).select("doc_id", F.explode("found").alias("x")).select("doc_id", "x.kind", "x.start_pos")


def p9_masked(spark: SparkSession, d: str) -> DataFrame:
    return p9_documents(spark, d, True).select("doc_id", F.size("found").cast("bigint").alias("n_found"), "clean")


QUERIES = {
    "p2_percentiles": p2_percentiles,
    "p7_containers": p7_containers,
    "p8_found": p8_found,
    "p8_places": p8_places,
    "p8_removal_spans": p8_removal_spans,
    "p9_found": p9_found,
    "p9_masked": p9_masked,
}
