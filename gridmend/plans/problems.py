"""The queries of the general problems over the whole tables, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmend.functions.cols import epoch_us, fixed, floordiv, number
from gridmend.operators import impute, regular_grid, rolling, spikes, timestamps
from gridmend.operators.series import SITES
from gridmend.sources.tables import checkpoint_dir, table

CLEAN, LATEST = "conso_historiques_clean", ["ingested_at", "reading_id"]


def p1_states(spark: SparkSession, d: str) -> DataFrame:
    return spikes.flag_spikes(table(spark, d, CLEAN), "reading_id", "poste_id", "Date", ["Ptot_HA", "Ptot_RIZOMM"])


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_states(spark, d).where("state <> 'normal'").select("reading_id", "channel")


def _grid(spark: SparkSession, d: str) -> DataFrame:
    return regular_grid.to_grid(table(spark, d, CLEAN), "poste_id", "Date", "Ptot_HA", LATEST)


def _shown(g: DataFrame) -> DataFrame:
    """The grid's numbers rounded, for the comparison with SQL."""
    return g.withColumns({"reading": fixed("reading", 3), "increment": fixed("increment", 1), "covered_share": fixed("covered_share", 6), "value": fixed("value", 2)})


def p3_grid(spark: SparkSession, d: str) -> DataFrame:
    return _shown(_grid(spark, d))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _grid(spark, d).where("n_readings = 0").select("poste_id", "slot_s")


def p3_energy(spark: SparkSession, d: str) -> DataFrame:
    """A cumulative counter on the grid: each station's running total of Ptot_HA in a register of eight digits, with the resets where it is full."""
    r = regular_grid.meter_register(table(spark, d, CLEAN), "poste_id", "Date", "Ptot_HA", LATEST)
    return _shown(regular_grid.to_grid(r, "poste_id", "Date", "register", [], kind="counter"))


P3_SLOTS = """
WITH r AS (SELECT DISTINCT poste_id, CAST(floor((epoch_us(Date) + 300000000) / 600000000.0) AS BIGINT) * 600 AS slot_s
           FROM conso_historiques_clean WHERE Ptot_HA IS NOT NULL AND NOT isnan(Ptot_HA)),
     b AS (SELECT poste_id, min(slot_s) AS lo, max(slot_s) AS hi FROM r GROUP BY poste_id),
     s AS (SELECT poste_id, unnest(generate_series(lo, hi, 600)) AS slot_s FROM b)"""
SQL = {"p3_found": P3_SLOTS + " SELECT s.poste_id, s.slot_s FROM s ANTI JOIN r USING (poste_id, slot_s)"}


def p3_sql(counter: bool) -> str:
    inc = "CASE WHEN nv >= v THEN nv - v ELSE nv END" if counter else "(v + nv) / 2 * ((nt - t) / 1e6)"
    value = "increment" if counter else "coalesce(increment / (lap / 1e6), reading)"
    register = "CAST(sum(CAST(round(greatest(least(v, 1e9), 0.0)) AS BIGINT)) OVER (PARTITION BY poste_id ORDER BY t) % 100000000 AS DOUBLE)"
    return f"""
WITH r AS (SELECT poste_id, epoch_us(Date) AS t, arg_max(Ptot_HA, row(coalesce(ingested_at, TIMESTAMP '0001-01-01'), reading_id)) AS v
           FROM conso_historiques_clean WHERE Ptot_HA IS NOT NULL AND NOT isnan(Ptot_HA) AND poste_id IS NOT NULL AND Date IS NOT NULL GROUP BY ALL),
     c AS (SELECT poste_id, t, {register if counter else "v"} AS v FROM r),
     n AS (SELECT *, CAST(floor((t + 300000000) / 600000000.0) AS BIGINT) AS own, lead(t) OVER w AS nt, lead(v) OVER w AS nv FROM c WINDOW w AS (PARTITION BY poste_id ORDER BY t)),
     s AS (SELECT *, unnest(generate_series(own, coalesce(CAST(floor((nt + 300000000) / 600000000.0) AS BIGINT), own))) AS cell FROM n),
     l AS (SELECT *, CASE WHEN nt - t <= 10800000000 THEN greatest(least(nt, cell * 600000000 + 300000000) - greatest(t, cell * 600000000 - 300000000), 0) ELSE 0 END AS lap FROM s),
     g AS (SELECT poste_id, cell, count(*) FILTER (WHERE cell = own) AS n_readings, avg(v) FILTER (WHERE cell = own) AS reading, sum(({inc}) * lap / (nt - t)) FILTER (WHERE lap > 0) AS increment,
                  sum(lap) AS lap, coalesce(bool_or(nv < v) FILTER (WHERE lap > 0), false) AS fell FROM l GROUP BY ALL)
SELECT poste_id, cell * 600 AS slot_s, n_readings, round(reading + 1e-7, 3) AS reading, round(increment + 1e-5, 1) AS increment, round(lap / 600000000.0 + 1e-10, 6) AS covered_share,
       round({value} + 1e-6, 2) AS value, {"fell" if counter else "false"} AS is_reset, CASE WHEN n_readings > 0 THEN 'read' WHEN lap > 0 THEN 'filled' ELSE 'uncovered' END AS status FROM g"""


SQL |= {"p3_grid": p3_sql(False), "p3_energy": p3_sql(True)}


def p5_rolling(spark: SparkSession, d: str) -> DataFrame:
    r = rolling.rolling_totals(table(spark, d, CLEAN), "poste_id", "Date", "Ptot_HEI_5RNS", LATEST)
    return r.select("poste_id", "day_utc", "n_day", *[F.round(c, 3).alias(c) if c[0] in "tm" else c for c in r.columns[3:]])


def p5_corrected(spark: SparkSession, d: str) -> DataFrame:
    """p5_rolling from trees of the rows that came within a day, corrected by what came later."""
    t, key = table(spark, d, CLEAN), ("poste_id", "Date", "Ptot_HEI_5RNS", LATEST)
    late = F.coalesce(epoch_us(F.col("ingested_at")) - epoch_us(F.col("Date")) > 86_400_000_000, F.lit(False))
    early, every = rolling.daily(t.where(~late), *key), rolling.daily(t, *key)
    r = rolling.answers(rolling.correct_tree(rolling.build_tree(early), rolling.changes(early, every)), every, "poste_id", (7, 30))
    return r.select("poste_id", "day_utc", "n_day", *[F.round(c, 3).alias(c) if c[0] in "tm" else c for c in r.columns[3:]])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    r = rolling.rolling_totals(table(spark, d, CLEAN), "poste_id", "Date", "Ptot_HEI_5RNS", LATEST)
    return r.where("n_day = 0").select("poste_id", "day_utc")


P5_DAYS = """
WITH r AS (SELECT poste_id, Date, arg_max(Ptot_HEI_5RNS, row(coalesce(ingested_at, TIMESTAMP '0001-01-01'), reading_id)) AS v
           FROM conso_historiques_clean WHERE Ptot_HEI_5RNS IS NOT NULL AND NOT isnan(Ptot_HEI_5RNS) GROUP BY ALL),
     d AS (SELECT poste_id, CAST(Date AS DATE) AS day, sum(v) AS total, count(*) AS n FROM r GROUP BY ALL),
     b AS (SELECT poste_id, min(day) AS lo, max(day) AS hi FROM d GROUP BY poste_id),
     c AS (SELECT poste_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM b)"""
SQL["p5_found"] = P5_DAYS + " SELECT c.poste_id, strftime(c.day, '%Y-%m-%d') AS day_utc FROM c ANTI JOIN d USING (poste_id, day)"
SQL["p5_rolling"] = P5_DAYS + """,
     x AS (SELECT c.poste_id, c.day, coalesce(d.total, 0) AS total, coalesce(d.n, 0) AS n FROM c LEFT JOIN d USING (poste_id, day)),
     y AS (SELECT poste_id, day, n,
                  sum(total) OVER w7 AS t7, sum(n) OVER w7 AS n7, sum(total) OVER w30 AS t30, sum(n) OVER w30 AS n30 FROM x
           WINDOW w7 AS (PARTITION BY poste_id ORDER BY day ROWS 6 PRECEDING), w30 AS (PARTITION BY poste_id ORDER BY day ROWS 29 PRECEDING))
SELECT poste_id, strftime(day, '%Y-%m-%d') AS day_utc, CAST(n AS BIGINT) AS n_day,
       round(t7, 3) AS total_7, CAST(n7 AS BIGINT) AS n_7, round(CASE WHEN n7 > 0 THEN t7 / n7 END, 3) AS mean_7,
       round(t30, 3) AS total_30, CAST(n30 AS BIGINT) AS n_30, round(CASE WHEN n30 > 0 THEN t30 / n30 END, 3) AS mean_30 FROM y"""

SQL["p5_corrected"] = SQL["p5_rolling"]


def p4_lines(spark: SparkSession, d: str) -> DataFrame:
    """Every line of both feeds with its instant, or null where the stamp can't be read."""
    feeds = [timestamps.normalise(table(spark, d, f"{f}_csv_rows"), table(spark, d, "loggers")).select(F.lit(f).alias("feed"), "line_id", "utc_us", "format", "n_readings") for f in ("conso", "meteo")]
    return feeds[0].unionByName(feeds[1])


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_lines(spark, d).where("utc_us is not null").select("feed", "line_id", "utc_us")


def _slot(c="Date"):
    return floordiv(epoch_us(F.col(c)) + 300_000_000, 600_000_000)


def p6_cells(spark: SparkSession, d: str) -> dict[tuple[str, str], DataFrame]:
    """The missing cells of both tables by (tbl, field): (row id, value, how).

    Attributes are all columns of a table but measured numbers and its row id, the slot, hour, day and time of day of Date, and whether a window's slot was measured at all.
    """
    clean, recon = table(spark, d, CLEAN), table(spark, d, "conso_historiques_reconstructed")
    slot = _slot()
    times = {"Date": F.col("Date"), "slot": slot, "hour": floordiv(slot, 6), "day": floordiv(slot, 144), "time_of_day": F.pmod(slot, F.lit(144))}
    groups = (("poste_id", "hour"), ("poste_id", "time_of_day"), ("poste_id",))
    keys = {c: F.col(c) for c in ("name", "poste_id", "Quality", "ingested_at")} | times
    out = {}
    for name in ("Ptot_HA", "Ptot_HEI_13RT"):
        others = {c: F.col(c) for c in SITES if c != name}
        entries = recon.select("poste_id", slot.alias("slot"), number(F.col(name)).alias("entry")).where("entry is not null and poste_id is not null and slot is not null").groupBy("poste_id", "slot").agg(F.min("entry").alias("entry"))
        out["clean", name] = impute.fill_cells(clean, "reading_id", keys, impute.Target(name, None, groups), numerics=others, reference=entries, reference_keys=("poste_id", "slot"), reference_name="reconstructed")
    flags = {f"quality_{x}": F.when(F.col(f"quality_{x}").isin(0, 1, 2, 3), F.col(f"quality_{x}")) for x in ("hei_13rt", "hei_5rns", "rizomm", "campus")}
    stored = clean.where(number(F.col("Ptot_HA")).isNotNull()).select(F.col("poste_id").alias("s_poste"), slot.alias("s_slot")).distinct()
    keys = {"name": F.col("name"), "poste_id": F.col("poste_id")} | times | flags
    recon = recon.select("recon_id", "quality_ha", *[c.alias(k) for k, c in keys.items()])
    recon = recon.join(stored, (F.col("poste_id") == F.col("s_poste")) & (F.col("slot") == F.col("s_slot")), "left").withColumn("measured", F.col("s_slot").isNotNull()).drop("s_poste", "s_slot")
    checkpoint_dir(spark)
    recon, keys = recon.checkpoint(), {k: F.col(k) for k in (*keys, "measured")}  # read by every dictionary
    out["reconstructed", "quality_ha"] = impute.fill_cells(recon, "recon_id", keys, impute.Target("quality_ha", None, (("poste_id", "measured", "hour"), ("poste_id", "measured"), ("measured",)), (0, 1, 2, 3)))
    return out


def p6_filled(spark: SparkSession, d: str) -> DataFrame:
    parts = [c.select(F.lit(t).alias("tbl"), F.col(c.columns[0]).alias("row_id"), F.lit(f).alias("field"), F.col("value").cast("double").alias("value"), "how") for (t, f), c in p6_cells(spark, d).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """The cells that the fill has given a number, or for which the table holds none to learn from."""
    return p6_filled(spark, d).where(~F.isnan("value") | (F.col("how") == "none")).select("tbl", "row_id", "field")


SQL["p6_found"] = """
SELECT 'clean' AS tbl, reading_id AS row_id, 'Ptot_HA' AS field FROM conso_historiques_clean WHERE Ptot_HA IS NULL OR isnan(Ptot_HA)
UNION ALL SELECT 'clean', reading_id, 'Ptot_HEI_13RT' FROM conso_historiques_clean WHERE Ptot_HEI_13RT IS NULL OR isnan(Ptot_HEI_13RT)
UNION ALL SELECT 'reconstructed', recon_id, 'quality_ha' FROM conso_historiques_reconstructed WHERE quality_ha IS NULL OR quality_ha NOT BETWEEN 0 AND 3"""


QUERIES = {"p1_found": p1_found, "p1_states": p1_states, "p3_found": p3_found, "p3_grid": p3_grid, "p3_energy": p3_energy, "p4_found": p4_found, "p4_lines": p4_lines, "p5_found": p5_found, "p5_rolling": p5_rolling, "p5_corrected": p5_corrected, "p6_found": p6_found, "p6_filled": p6_filled}
