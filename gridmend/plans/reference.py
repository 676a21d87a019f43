"""The queries of the reconstruction's operators over the whole tables, and their SQL.

Series are the five channels of every station. Where numbers come from sums or exponentials both sides are rounded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmend.functions.cols import fixed, number
from gridmend.operators import anomaly, audit, evaluate, features, fills, lookups, router, series, timezones, window
from gridmend.operators.series import CAMPUS, KEY, SITES
from gridmend.plans import daily, engine
from gridmend.sources.tables import checkpoint_dir, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str = ""):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---- shared parts of the SQL -------------------------------------------------------------------------------------------

_PICK = ", ".join(f"arg_max({c}, reading_id) FILTER (WHERE {c} IS NOT NULL AND NOT isnan({c})) AS {c}" for c in SITES)
W = f"""WITH w AS (SELECT poste_id, CAST(floor((epoch_us(Date) + 300000000) / 600000000.0) AS BIGINT) AS slot, {_PICK} FROM conso_historiques_clean GROUP BY ALL)"""
R = W + f""", r AS (SELECT poste_id, site, slot, value FROM (UNPIVOT w ON {", ".join(SITES)} INTO NAME site VALUE value))"""
_LOCAL = "(to_timestamp({s} * 600) AT TIME ZONE 'Europe/Paris')"


def feat(name: str, source: str, slot: str = "slot") -> str:
    loc = _LOCAL.format(s=slot)
    return f""", {name} AS (SELECT x.*, CAST(hour({loc}) AS INTEGER) AS hour, dayname({loc}) AS day_of_week, CAST({loc} AS DATE) AS local_date FROM {source} x)"""


FEAT = R + feat("f", "r")
CAL = """, cal AS (SELECT DISTINCT cal_date, lower(trim(kind)) AS kind FROM calendar_days WHERE cal_date IS NOT NULL AND kind IS NOT NULL),
 hol AS (SELECT DISTINCT cal_date FROM cal WHERE kind = 'holiday')"""


def occ(name: str, source: str) -> str:
    """source has hour, day_of_week and local_date."""
    return f""", {name} AS (SELECT *, CASE WHEN is_holiday THEN 'holiday' WHEN day_of_week IN ('Saturday', 'Sunday') THEN 'weekend' WHEN hour >= 18 OR hour < 6 THEN 'evening' ELSE 'work_hours' END AS occupancy_type
 FROM (SELECT *, local_date IN (SELECT cal_date FROM hol) AS is_holiday FROM {source}))"""


GAPS = R + """, g AS (SELECT poste_id, site, slot + 1 AS gap_start, nxt AS gap_end, nxt - slot - 1 AS gap_size, value AS y_l, nv AS y_r
 FROM (SELECT *, lead(slot) OVER n AS nxt, lead(value) OVER n AS nv FROM r WINDOW n AS (PARTITION BY poste_id, site ORDER BY slot)) WHERE nxt > slot + 1)"""
POINTS = GAPS + """, p AS (SELECT g.*, unnest(generate_series(gap_start, gap_end - 1)) AS slot FROM g), pk AS (SELECT *, slot - gap_start + 1 AS k FROM p)"""
LINEAR = "(y_l + (y_r - y_l) * k / (gap_size + 1))"
MED = ", med AS (SELECT poste_id, site, round(median(value), 6) AS med, max(value) AS top FROM r GROUP BY ALL)"
STATS = ", st AS (SELECT poste_id, site, count(*) AS n, round(median(value), 6) AS median, round(stddev_samp(value), 6) AS std FROM r GROUP BY ALL), ok AS (SELECT * FROM r JOIN st USING (poste_id, site) WHERE n >= 30 AND median <> 0)"
HOURS = ", ht AS (SELECT poste_id, site, hour, round(median(value), 6) AS tpl FROM f GROUP BY ALL)"
WEEKLY = """, last AS (SELECT poste_id, site, max(slot) AS last_slot FROM r GROUP BY ALL),
 wk0 AS (SELECT poste_id, site, day_of_week, hour, round(median(value) FILTER (WHERE slot >= last_slot - 19 * 144), 6) AS mr, round(median(value) FILTER (WHERE slot < last_slot - 19 * 144), 6) AS mh,
   avg(value) AS mean, stddev_pop(value) AS std, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.75) AS q75,
   count(*) FILTER (WHERE slot >= last_slot - 19 * 144) AS recent_count, count(*) FILTER (WHERE slot < last_slot - 19 * 144) AS historical_count
  FROM f JOIN last USING (poste_id, site) WHERE slot >= last_slot - 28 * 144 GROUP BY ALL),
 wk AS (SELECT *, coalesce(round(0.7 * mr + (1 - 0.7) * mh, 6), mr, mh) AS tpl FROM wk0)"""
CLASS = feat("pf", "p") + """, gc AS (SELECT poste_id, site, gap_start, bool_or(day_of_week IN ('Saturday', 'Sunday')) AS any_weekend, bool_and(day_of_week IN ('Saturday', 'Sunday')) AS pure_weekend,
   CASE WHEN bool_and(day_of_week = 'Saturday') THEN 'saturday' WHEN bool_and(day_of_week = 'Sunday') THEN 'sunday' WHEN bool_and(day_of_week IN ('Saturday', 'Sunday')) THEN 'mixed' END AS day_type FROM pf GROUP BY ALL)"""
METERS = """, m AS (SELECT site, min(tier) AS tier, min(parent) AS parent FROM compteurs GROUP BY site),
 gh0 AS (SELECT g.*, coalesce(m.tier, 'unknown') AS tier, m.parent FROM g LEFT JOIN m USING (site)),
 pp AS (SELECT DISTINCT x.poste_id, x.site, x.gap_start FROM (SELECT *, unnest(generate_series(gap_start, gap_end - 1)) AS slot FROM gh0 WHERE tier = 'sub' AND parent IS NOT NULL) x
   JOIN r ON r.poste_id = x.poste_id AND r.site = x.parent AND r.slot = x.slot),
 gh AS (SELECT gh0.*, pp.gap_start IS NOT NULL AS parent_present FROM gh0 LEFT JOIN pp USING (poste_id, site, gap_start))"""


def routed(chunked: bool = True, ml: bool = True) -> str:
    rules = "WHEN gap_size > 96 THEN 'MULTI_WEEK_TEMPLATE' " * chunked + "WHEN gap_size > 50 AND tier <> 'entry' THEN 'MICE' " * ml
    return POINTS + CLASS + METERS + f""", rt AS (SELECT gh.*, any_weekend, pure_weekend, day_type, CASE {rules} WHEN tier = 'sub' AND parent_present THEN 'PEER_CORRELATION' WHEN gap_size <= 3 THEN 'LINEAR_MICRO' WHEN gap_size <= 18 THEN 'LINEAR_SHORT'
  WHEN pure_weekend THEN 'WEEKEND_TEMPLATE_' || upper(day_type) WHEN tier <> 'entry' AND gap_size <= 144 THEN 'THERMAL_TEMPLATE' WHEN tier <> 'entry' THEN 'ENHANCED_TEMPLATE' ELSE 'SAFE_LINEAR_MEDIAN' END AS strategy
  FROM gh JOIN gc USING (poste_id, site, gap_start))"""


#: Written out anew, not from the router's table, so that either can show a slip in the other.
SURE = """CASE WHEN strategy = 'MULTI_WEEK_TEMPLATE' THEN 0.9 WHEN strategy = 'MICE' THEN 0.85 WHEN strategy = 'KNN_CONTEXT' THEN 0.8 WHEN strategy IN ('KALMAN_FILTER', 'PEER_CORRELATION') THEN 0.75
  WHEN strategy = 'THERMAL_TEMPLATE' THEN 0.7 WHEN strategy = 'ENHANCED_TEMPLATE' THEN 0.65 WHEN strategy = 'SAFE_LINEAR_MEDIAN' THEN 0.45 WHEN strategy = 'LINEAR_MICRO' THEN 0.4 WHEN strategy = 'SAFE_MEDIAN' THEN 0.3 ELSE 0.5 END"""
FLAG = """CASE WHEN strategy LIKE 'LINEAR%' THEN 1 WHEN strategy IN ('MULTI_WEEK_TEMPLATE', 'MICE', 'KNN_CONTEXT', 'KALMAN_FILTER', 'SAFE_MEDIAN') THEN 3 ELSE 2 END"""


CONF = routed() + CAL + feat("rf", "rt", "gap_start") + occ("ro", "rf") + f""", cf AS (SELECT *, round(least(greatest({SURE}
  * CASE WHEN gap_size < 10 THEN 1.0 WHEN gap_size < 50 THEN 0.9 WHEN gap_size < 144 THEN 0.7 WHEN gap_size < 1008 THEN 0.5 ELSE 0.3 END
  * CASE occupancy_type WHEN 'work_hours' THEN 1.0 WHEN 'evening' THEN 0.8 WHEN 'weekend' THEN 0.7 WHEN 'holiday' THEN 0.5 ELSE 0.6 END
  * CASE WHEN is_holiday THEN 0.7 ELSE 1.0 END, 0.0), 1.0)::DOUBLE + 1e-8, 4)::DOUBLE AS confidence FROM ro)"""


def anchored(fill: str, tpl: str, keys: str) -> str:
    """CTEs an (value) from fill(poste_id, site, gap_start, slot, f) and tpl(poste_id, site, keys, tpl); needs pk and r."""
    return f""", o0 AS (SELECT poste_id, site, gap_start, gap_end, side, CASE WHEN side = 'l' THEN gap_start - i ELSE gap_end + i - 1 END AS slot FROM g, unnest(['l', 'r']) s(side), range(1, 7) t(i))
 {feat("o1", "(SELECT o0.*, r.value FROM o0 JOIN r USING (poste_id, site, slot))")}
 , o AS (SELECT poste_id, site, gap_start, round(median(value - tpl) FILTER (WHERE side = 'l'), 6) AS out_l, round(median(value - tpl) FILTER (WHERE side = 'r'), 6) AS out_r FROM o1 JOIN {tpl} USING (poste_id, site, {keys}) GROUP BY ALL),
 pf1 AS (SELECT pk.*, f FROM pk JOIN {fill} USING (poste_id, site, gap_start, slot)),
 ins AS (SELECT poste_id, site, gap_start, round(median(f) FILTER (WHERE k <= 6), 6) AS m_l, round(median(f) FILTER (WHERE k > gap_size - 6), 6) AS m_r FROM pf1 GROUP BY ALL),
 sh0 AS (SELECT g.poste_id, g.site, g.gap_start, out_l AS ol, y_l - m_l AS il, out_r AS orr, y_r - m_r AS ir FROM g LEFT JOIN o USING (poste_id, site, gap_start) LEFT JOIN ins USING (poste_id, site, gap_start)),
 sh1 AS (SELECT *, CASE WHEN ol IS NULL OR il IS NULL THEN coalesce(ol, il) WHEN abs(ol) < abs(il) THEN ol ELSE il END AS s_l, CASE WHEN orr IS NULL OR ir IS NULL THEN coalesce(orr, ir) WHEN abs(orr) < abs(ir) THEN orr ELSE ir END AS s_r FROM sh0),
 an0 AS (SELECT pf1.*, coalesce(s_l, s_r) AS sl, coalesce(s_r, s_l) AS sr, exp(-(k - 1) / greatest(6.0::DOUBLE, least(36.0::DOUBLE, gap_size / 12.0))) AS wl, exp(-(gap_size - k) / greatest(6.0::DOUBLE, least(36.0::DOUBLE, gap_size / 12.0))) AS wr FROM pf1 JOIN sh1 USING (poste_id, site, gap_start)),
 an AS (SELECT *, CASE WHEN sl IS NULL THEN f ELSE greatest(wl, wr) * {LINEAR} + (1 - greatest(wl, wr)) * (f + wl * sl + wr * sr) END AS value FROM an0)"""


CLIP = "(CASE WHEN top IS NULL THEN coalesce({v}, 0.0) ELSE greatest(0.0, least(coalesce({v}, med), 1.5 * top)) END)"
GAPKEY = "poste_id, site, gap_start"


# ---- the parts that queries share --------------------------------------------------------------------------------------


def _clean(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "conso_historiques_clean")


def _r(s: SparkSession, d: str) -> DataFrame:
    return series.readings(_clean(s, d))


def _rc(s: SparkSession, d: str) -> DataFrame:
    """The readings for plans that read them many times: their lineage is cut in the shared checkpoint folder."""
    checkpoint_dir(s)
    return _r(s, d).checkpoint()


def _cal(s: SparkSession, d: str) -> DataFrame:
    return features.calendar(table(s, d, "calendar_days"))


def _meters(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "compteurs")


def _f(s: SparkSession, d: str) -> DataFrame:
    return features.datetime_features(_r(s, d))


def _routed(s: SparkSession, d: str, how: router.Routing = router.Routing(), r: DataFrame | None = None) -> DataFrame:
    r = r if r is not None else _rc(s, d)
    return router.route(router.with_hierarchy(router.classify(series.gaps(r)), r, _meters(s, d)), how)


def _confident(s: SparkSession, d: str) -> DataFrame:
    return router.with_confidence(_routed(s, d), _cal(s, d))


# ---- grid and alignment ------------------------------------------------------------------------------------------------


@query(R + " SELECT * FROM r")
def readings_bucket(s, d):
    return _r(s, d)


@query(POINTS + " SELECT poste_id, site, slot, value FROM r UNION ALL SELECT poste_id, site, slot, CAST(NULL AS DOUBLE) FROM p")
def regular_grid(s, d):
    return series.grid(_r(s, d))


@query(R + " SELECT *, n_cells - n_readings AS n_null FROM (SELECT poste_id, site, min(slot) AS first_slot, max(slot) AS last_slot, count(*) AS n_readings, max(slot) - min(slot) + 1 AS n_cells FROM r GROUP BY ALL)")
def null_counts(s, d):
    return lookups.null_counts(_r(s, d))


@query(R + " SELECT poste_id, slot, " + ", ".join(f"max(value) FILTER (WHERE site = '{c}') AS {c}" for c in SITES) + " FROM r GROUP BY ALL")
def wide_pivot(s, d):
    return series.pivot(_r(s, d))


@query(W + " SELECT poste_id, slot, round(" + " + ".join(CAMPUS) + ", 3) AS Ptot_Campus FROM w")
def virtual_sum_meter(s, d):
    w = series.wide(_clean(s, d))
    return w.select("poste_id", "slot", F.round(sum((F.col(c) for c in CAMPUS[1:]), F.col(CAMPUS[0])), 3).alias("Ptot_Campus"))


TARGET = """, tg AS (SELECT poste_id, CAST(epoch(date_trunc('day', to_timestamp(max(slot) * 600) AT TIME ZONE 'Europe/Paris') AT TIME ZONE 'Europe/Paris') / 600 AS BIGINT) AS target FROM r GROUP BY poste_id),
 win AS (SELECT e.poste_id, e.site, target - 1008 + idx AS slot, CAST(idx AS INTEGER) AS idx FROM (SELECT DISTINCT poste_id, site FROM r) e JOIN tg USING (poste_id), range(0, 1008) t(idx))"""


@query(R + TARGET + " SELECT win.*, r.value FROM win LEFT JOIN r USING (poste_id, site, slot)")
def window_extract_7d(s, d):
    r = _rc(s, d)
    return window.extract(r, window.targets(r))


@query(R + TARGET + """, hw AS (SELECT poste_id, site, slot, value, 0 AS prio FROM r JOIN tg USING (poste_id) WHERE slot < target - 1008 AND slot >= target - 1008 - 56 * 144
 UNION ALL SELECT win.poste_id, win.site, win.slot, r.value, 1 FROM win LEFT JOIN r USING (poste_id, site, slot)) SELECT poste_id, site, slot, value, prio = 1 AS in_window FROM hw""")
def history_prepend_dedup(s, d):
    r = _rc(s, d)
    t = window.targets(r)
    return window.prepend_history(window.extract(r, t), r, t)


@query("""WITH x AS (SELECT reading_id, Date, Date - INTERVAL 2 HOUR AS c1, Date - INTERVAL 1 HOUR AS c2 FROM conso_historiques_clean),
 y AS (SELECT *, (c1 AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' = Date AS v1, (c2 AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' = Date AS v2 FROM x)
SELECT reading_id, epoch_us(CASE WHEN v2 THEN c2 WHEN v1 THEN c1 ELSE date_trunc('hour', c2) END) AS utc_us FROM y""")
def localise_wall_clock(s, d):
    return _clean(s, d).select("reading_id", F.unix_micros(timezones.localise(F.col("Date").cast("timestamp"))).alias("utc_us"))


@query(R + f""", l AS (SELECT poste_id, site, slot, CAST((epoch({_LOCAL.format(s="slot")}) - epoch({_LOCAL.format(s="prev")})) / 60 AS BIGINT) AS minutes FROM (SELECT *, lag(slot) OVER (PARTITION BY poste_id, site ORDER BY slot) AS prev FROM r) WHERE prev IS NOT NULL)
SELECT *, CASE WHEN minutes > 60 AND minutes < 90 THEN 'spring_forward' ELSE 'fall_back' END AS kind FROM l WHERE (minutes > 60 AND minutes < 90) OR minutes < 0 OR (minutes > -60 AND minutes < 5 AND minutes <> 10)""")
def dst_events(s, d):
    return timezones.dst_events(_r(s, d))


# ---- features ----------------------------------------------------------------------------------------------------------


@query(FEAT + " SELECT poste_id, site, slot, hour, day_of_week, CAST(local_date AS VARCHAR) AS local_date FROM f")
def datetime_features(s, d):
    return _f(s, d).drop("value").withColumn("local_date", F.col("local_date").cast("string"))


@query(FEAT + CAL + occ("q", "f") + " SELECT poste_id, site, slot, occupancy_type, occupancy_type = 'work_hours' AS is_occupied FROM q")
def occupancy(s, d):
    return features.full_features(_r(s, d), _cal(s, d)).select(*KEY, "slot", "occupancy_type", "is_occupied")


@query(FEAT + " SELECT poste_id, site, CAST(local_date AS VARCHAR) AS local_date, CASE WHEN month(local_date) IN (12, 1, 2) THEN 'winter' WHEN month(local_date) IN (3, 4, 5) THEN 'spring' WHEN month(local_date) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season, count(*) AS n FROM f GROUP BY ALL")
def season(s, d):
    return _f(s, d).groupBy(*KEY, F.col("local_date").cast("string").alias("local_date"), features.season(F.month("local_date")).alias("season")).agg(F.count("*").alias("n"))


@query(FEAT + CAL + """ SELECT DISTINCT CAST(local_date AS VARCHAR) AS local_date, local_date IN (SELECT cal_date FROM hol) AS is_holiday, local_date IN (SELECT cal_date FROM cal WHERE kind IN ('close', 'special')) AS is_special_day,
 local_date IN (SELECT CAST(cal_date + INTERVAL (i) DAY AS DATE) FROM hol, range(-1, 2) t(i)) AS is_holiday_close FROM f""")
def holiday_proximity(s, d):
    return features.day_flags(_f(s, d).select("local_date").distinct(), _cal(s, d)).select(F.col("local_date").cast("string").alias("local_date"), "is_holiday", "is_special_day", "is_holiday_close")


@query(FEAT + """, dd AS (SELECT poste_id, site, local_date, round(stddev_samp(value) + 1e-7, 3) AS daily_std FROM f GROUP BY ALL HAVING count(*) > 1), tt AS (SELECT poste_id, site, round(quantile_cont(daily_std, 0.75) + 1e-7, 3) AS threshold FROM dd GROUP BY ALL)
SELECT * REPLACE (CAST(local_date AS VARCHAR) AS local_date) FROM dd JOIN tt USING (poste_id, site) WHERE daily_std > threshold""")
def event_days(s, d):
    return features.event_days(_r(s, d)).withColumn("local_date", F.col("local_date").cast("string"))


WX = """WITH wx AS (SELECT station_id, CAST(floor((epoch_us(Date) + 300000000) / 600000000.0) AS BIGINT) AS slot, arg_max(AirTemp, meteo_id) FILTER (WHERE AirTemp IS NOT NULL AND NOT isnan(AirTemp)) AS air_temp FROM pv_prev_meteo_clean GROUP BY ALL)"""
FILLED = """, wf AS (SELECT station_id, slot, coalesce(last_value(air_temp IGNORE NULLS) OVER (PARTITION BY station_id ORDER BY slot ROWS UNBOUNDED PRECEDING),
 first_value(air_temp IGNORE NULLS) OVER (PARTITION BY station_id ORDER BY slot ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS air_temp FROM wx)"""


def _wx(s, d):
    return features.weather(table(s, d, "pv_prev_meteo_clean"))


def _wf(s, d):
    return features.fill_forward_backward(_wx(s, d), "station_id", "slot", "air_temp")


@query(WX + FILLED + " SELECT * FROM wf")
def airtemp_ffill_bfill(s, d):
    return _wf(s, d).select("station_id", "slot", "air_temp")


@query(WX + FILLED + """, mean AS (SELECT slot, round(avg(air_temp), 3) AS air_temp FROM wf GROUP BY slot), """ + W.removeprefix("WITH ") + " SELECT poste_id, slot, Ptot_HA, air_temp FROM w LEFT JOIN mean USING (slot)")
def weather_join(s, d):
    """Readings with the mean temperature of all weather stations in their slot, one row each."""
    mean = _wf(s, d).groupBy("slot").agg(F.round(F.avg("air_temp"), 3).alias("air_temp"))
    return series.wide(_clean(s, d)).join(mean, "slot", "left").select("poste_id", "slot", "Ptot_HA", "air_temp")


@query(WX + feat("xf", "wx") + """, dd AS (SELECT station_id, local_date, round(max(air_temp) - min(air_temp), 6) AS temp_range FROM xf GROUP BY ALL HAVING count(air_temp) > 0), tt AS (SELECT station_id, round(quantile_cont(temp_range, 0.8), 6) AS threshold FROM dd GROUP BY ALL)
SELECT * REPLACE (CAST(local_date AS VARCHAR) AS local_date) FROM dd JOIN tt USING (station_id) WHERE temp_range > threshold""")
def weather_spike(s, d):
    return features.weather_spikes(_wx(s, d)).withColumn("local_date", F.col("local_date").cast("string"))


@query(WX + " SELECT station_id, slot, CASE WHEN air_temp <= 10 THEN 'Cold' WHEN air_temp <= 20 THEN 'Mild' WHEN air_temp > 20 THEN 'Hot' END AS regime FROM wx")
def thermal_regime(s, d):
    return _wx(s, d).select("station_id", "slot", features.thermal_regime(F.col("air_temp")).alias("regime"))


# ---- anomalies ---------------------------------------------------------------------------------------------------------

STUCK = R + STATS + """, c AS (SELECT *, CASE WHEN prev IS NULL OR abs(value - prev) > abs(median) * 1e-4 THEN slot END AS start FROM (SELECT *, lag(value) OVER (PARTITION BY poste_id, site ORDER BY slot) AS prev FROM ok)),
 rs AS (SELECT *, max(start) OVER (PARTITION BY poste_id, site ORDER BY slot) AS run_start FROM c), rl AS (SELECT poste_id, site, run_start, count(*) AS run_length FROM rs GROUP BY ALL HAVING count(*) >= 18),
 stuck AS (SELECT poste_id, site, slot, value, run_start, run_length FROM rs JOIN rl USING (poste_id, site, run_start) WHERE slot > run_start)"""
Z = ", z AS (SELECT poste_id, site, slot, value, round((value - median) / (std + 1e-9), 6) AS z FROM ok WHERE abs(round((value - median) / (std + 1e-9), 6)) > 3)"


@query(STUCK + " SELECT * FROM stuck")
def stuck_sensor(s, d):
    return anomaly.stuck(_rc(s, d))


@query(R + STATS + feat("f", "ok") + CAL + occ("q", "f") + " SELECT poste_id, site, slot, value FROM q WHERE occupancy_type IN ('work_hours', 'evening') AND value <= median * 0.01")
def near_zero(s, d):
    return anomaly.near_zero(features.full_features(_r(s, d), _cal(s, d))).select(*KEY, "slot", "value")


@query(R + STATS + Z + " SELECT * FROM z")
def zscore_outliers(s, d):
    return anomaly.zscores(_r(s, d))


@query(STUCK + Z + """, fl AS (SELECT poste_id, site, slot, 'stuck' AS reason FROM stuck UNION SELECT poste_id, site, slot, 'zscore' FROM z), fs AS (SELECT DISTINCT poste_id, site, slot FROM fl),
 fr AS (SELECT *, slot - row_number() OVER (PARTITION BY poste_id, site ORDER BY slot) AS grp FROM fs)
SELECT poste_id, site, min(slot) AS run_start, max(slot) AS run_end, count(DISTINCT slot) AS n_slots, array_to_string(list_sort(list_distinct(list(reason))), ', ') AS reasons FROM fr JOIN fl USING (poste_id, site, slot) GROUP BY poste_id, site, grp""")
def anomaly_runs(s, d):
    r = _rc(s, d)
    flags = anomaly.stuck(r).select(*KEY, "slot", "value", F.lit("stuck").alias("reason")).unionByName(anomaly.zscores(r).select(*KEY, "slot", "value", F.lit("zscore").alias("reason")))
    return anomaly.flagged_runs(flags)


@query()
def isolation_forest(s, d):
    return anomaly.isolation_forest(features.datetime_features(_rc(s, d)))


# ---- look-ups ----------------------------------------------------------------------------------------------------------


PEER = R + """, sub AS (SELECT DISTINCT site, parent FROM compteurs WHERE tier = 'sub'), pr AS (SELECT c.poste_id, c.site, c.slot, c.value AS child, q.value AS pv, row_number() OVER (PARTITION BY c.poste_id, c.site ORDER BY c.slot DESC) AS rn
 FROM r c JOIN sub ON sub.site = c.site JOIN r q ON q.poste_id = c.poste_id AND q.site = sub.parent AND q.slot = c.slot),
 ra AS (SELECT poste_id, site, count(*) AS n_pairs, round(median(round(child / pv, 9)), 6) AS ratio FROM pr WHERE rn <= 144 AND pv > 1 GROUP BY ALL),
 ratio AS (SELECT e.poste_id, e.site, coalesce(n_pairs, 0) AS n_pairs, coalesce(ratio, 0.5) AS ratio FROM (SELECT DISTINCT poste_id, site FROM r WHERE site IN (SELECT site FROM sub)) e LEFT JOIN ra USING (poste_id, site))"""


@query(PEER + " SELECT * FROM ratio")
def peer_ratio(s, d):
    return lookups.peer_ratio(_r(s, d), _meters(s, d))


DAYTPL = """, dt0 AS (SELECT *, 'saturday' AS day_type FROM f WHERE day_of_week = 'Saturday' UNION ALL SELECT *, 'sunday' FROM f WHERE day_of_week = 'Sunday' UNION ALL SELECT *, 'holiday' FROM f WHERE local_date IN (SELECT cal_date FROM hol)),
 dt AS (SELECT poste_id, site, day_type, hour, round(median(value), 6) AS tpl FROM dt0 GROUP BY ALL)"""


@query(FEAT + CAL + DAYTPL + " SELECT * FROM dt")
def day_templates(s, d):
    return lookups.day_templates(features.day_flags(_f(s, d), _cal(s, d)))


@query(FEAT + " SELECT poste_id, site, CASE WHEN month(local_date) IN (12, 1, 2) THEN 'winter' WHEN month(local_date) IN (3, 4, 5) THEN 'spring' WHEN month(local_date) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season, hour, round(median(value), 6) AS tpl FROM f GROUP BY ALL")
def seasonal_templates(s, d):
    return lookups.seasonal_templates(_f(s, d).withColumn("season", features.season(F.month("local_date"))))


@query(FEAT + WEEKLY + " SELECT poste_id, site, day_of_week, hour, round(tpl + 1e-8, 4) AS tpl, round(mean + 1e-7, 3) AS mean, round(std + 1e-7, 3) AS std, round(q25 + 1e-8, 4) AS q25, round(q75 + 1e-8, 4) AS q75, recent_count, historical_count FROM wk")
def weekly_templates(s, d):
    t = lookups.weekly_templates(_f(s, d))
    return t.select(*KEY, "day_of_week", "hour", *[fixed(c, n).alias(c) for c, n in (("tpl", 4), ("mean", 3), ("std", 3), ("q25", 4), ("q75", 4))], "recent_count", "historical_count")


@query(FEAT + WEEKLY + " SELECT poste_id, site, day_of_week, round(stddev_pop(tpl) + 1e-7, 3) AS day_std FROM wk GROUP BY ALL")
def day_variance(s, d):
    return lookups.day_variance(lookups.weekly_templates(_f(s, d))).withColumn("day_std", fixed("day_std", 3))


@query(R + """ SELECT poste_id, site, round(CASE WHEN count(*) < 10 THEN 0.0 ELSE greatest(0.0, avg(value) - 2 * stddev_samp(value)) END + 1e-6, 2) AS lower, round(CASE WHEN count(*) < 10 THEN 1.5 * max(value) ELSE avg(value) + 2 * stddev_samp(value) END + 1e-6, 2) AS upper FROM r GROUP BY ALL""")
def uncertainty_bounds(s, d):
    return lookups.uncertainty_bounds(_r(s, d)).select(*KEY, fixed("lower", 2).alias("lower"), fixed("upper", 2).alias("upper"))


@query(R + """ SELECT a.poste_id, a.site AS s1, b.site AS s2, count(*) AS n, round(coalesce(CASE WHEN isnan(corr(a.value, b.value)) THEN 0.0 ELSE corr(a.value, b.value) END, 0.0), 4) AS r FROM r a JOIN r b ON a.poste_id = b.poste_id AND a.slot = b.slot AND a.site <> b.site GROUP BY ALL HAVING count(*) > 10""")
def site_correlations(s, d):
    return lookups.correlations(series.wide(_clean(s, d)))


# ---- gaps and routing --------------------------------------------------------------------------------------------------


@query(GAPS + " SELECT * FROM g")
def gap_groups(s, d):
    return series.gaps(_r(s, d))


@query(POINTS + CLASS + f" SELECT {GAPKEY}, gap_end, gap_size, any_weekend, pure_weekend, day_type FROM g JOIN gc USING ({GAPKEY})")
def gap_class(s, d):
    return router.classify(series.gaps(_rc(s, d))).select(*router.GAP, "gap_end", "gap_size", "any_weekend", "pure_weekend", "day_type")


@query(routed() + f" SELECT {GAPKEY}, gap_size, tier, parent_present, strategy FROM rt")
def route_gaps(s, d):
    return _routed(s, d).select(*router.GAP, "gap_size", "tier", "parent_present", "strategy")


@query(routed(False, False) + f" SELECT {GAPKEY}, gap_size, tier, parent_present, strategy FROM rt")
def route_gaps_plain(s, d):
    """Without chunking and without the learned strategies, so that every other branch is met."""
    return _routed(s, d, router.Routing(False, mice=False, kalman=False, knn=False)).select(*router.GAP, "gap_size", "tier", "parent_present", "strategy")


@query(CONF + f" SELECT {GAPKEY}, strategy, occupancy_type, is_holiday, confidence FROM cf")
def confidence(s, d):
    return _confident(s, d).select(*router.GAP, "strategy", "occupancy_type", "is_holiday", "confidence")


@query(CONF + f" SELECT {GAPKEY}, gap_end, gap_size, strategy, confidence FROM cf WHERE confidence < 0.5")
def low_confidence(s, d):
    return audit.low_confidence(_confident(s, d))


@query(GAPS + f", ch AS (SELECT *, unnest(range(0, CAST(ceil(gap_size / 96.0) AS BIGINT))) AS i FROM g WHERE gap_size > 96) SELECT {GAPKEY}, CAST(i AS INTEGER) AS chunk_index, gap_start + i * 96 AS chunk_start, least(gap_start + i * 96 + 96, gap_end) AS chunk_end FROM ch")
def fixed_chunks(s, d):
    return router.fixed_chunks(series.gaps(_r(s, d)))


_AT = _LOCAL.format(s="(chunk_start + n)")
SMART = (FEAT + WEEKLY + GAPS.removeprefix(R) + f""", dv AS (SELECT poste_id, site, day_of_week, stddev_pop(tpl) AS day_std FROM wk GROUP BY ALL), fs AS (SELECT poste_id, min(site) AS site FROM dv GROUP BY ALL), v AS (SELECT dv.* FROM dv JOIN fs USING (poste_id, site)),
 vm AS (SELECT poste_id, median(day_std) AS med FROM v GROUP BY ALL), vol AS (SELECT poste_id, list(day_of_week) AS days FROM v JOIN vm USING (poste_id) WHERE day_std > 1.3 * med GROUP BY ALL),
 lg AS (SELECT g.poste_id, g.site, gap_start, gap_end, coalesce(days, []) AS days FROM g LEFT JOIN vol USING (poste_id) WHERE gap_size > 96),
 rec AS (SELECT poste_id, site, gap_start, gap_end, days, 0 AS chunk_index, gap_start AS chunk_start FROM lg
  UNION ALL SELECT poste_id, site, gap_start, gap_end, days, chunk_index + 1, min(chunk_start + n) FROM rec, range(1, 145) t(n)
   WHERE chunk_start + n < gap_end AND (n >= 144 OR (list_contains(days, dayname({_AT})) AND n > 0.8 * 96) OR (hour({_AT}) = 0 AND minute({_AT}) = 0 AND n >= 96)) GROUP BY poste_id, site, gap_start, gap_end, days, chunk_index)
SELECT {GAPKEY}, CAST(chunk_index AS INTEGER) AS chunk_index, chunk_start, coalesce(lead(chunk_start) OVER (PARTITION BY {GAPKEY} ORDER BY chunk_index), gap_end) AS chunk_end FROM rec""").replace("WITH w AS", "WITH RECURSIVE w AS", 1)


@query(SMART)
def smart_chunks(s, d):
    r = _rc(s, d)
    return router.smart_chunks(series.gaps(r), lookups.day_variance(lookups.weekly_templates(features.datetime_features(r))))


# ---- fills -------------------------------------------------------------------------------------------------------------


@query(POINTS + f" SELECT {GAPKEY}, slot, round({LINEAR} + 1e-7, 3) AS value FROM pk")
def fill_linear(s, d):
    return fills.linear(series.gaps(_r(s, d))).withColumn("value", fixed("value", 3))


@query(POINTS + MED + f" SELECT {GAPKEY}, slot, coalesce(med, 0.0) AS value FROM pk LEFT JOIN med USING (poste_id, site)")
def fill_safe_median(s, d):
    r = _rc(s, d)
    return fills.safe_median(series.gaps(r), r)


@query(POINTS + MED + f" SELECT {GAPKEY}, slot, round(0.9 * {LINEAR} + 0.1 * med + 1e-7, 3) AS value FROM pk JOIN med USING (poste_id, site)")
def fill_safe_linear_median(s, d):
    r = _rc(s, d)
    return fills.safe_linear_median(series.gaps(r), r).withColumn("value", fixed("value", 3))


THERMAL = POINTS + feat("f", "r") + HOURS + MED + feat("ph", "pk") + ", tf AS (SELECT poste_id, site, gap_start, slot, tpl AS f FROM ph JOIN ht USING (poste_id, site, hour))" + anchored("tf", "ht", "hour")


@query(THERMAL + f" SELECT {GAPKEY}, slot, round(value + 1e-6, 2) AS value FROM an")
def anchor_boundaries(s, d):
    """The median by hour, anchored to both sides of its gap, before clipping."""
    r = _rc(s, d)
    g, t = series.gaps(r), lookups.hour_template(features.datetime_features(r))
    return fills.anchored(g, fills.template_fill(g, t, ["hour"]), r, t, ["hour"]).withColumn("value", fixed("value", 2))


@query(THERMAL + f" SELECT {GAPKEY}, slot, round({CLIP.format(v='value')} + 1e-6, 2) AS value FROM an LEFT JOIN med USING (poste_id, site)")
def fill_thermal_template(s, d):
    r = _rc(s, d)
    return fills.thermal(series.gaps(r), r, lookups.hour_template(features.datetime_features(r))).withColumn("value", fixed("value", 2))


@query(POINTS + feat("f", "r") + CAL + DAYTPL + MED + CLASS + feat("ph", "pk") + f""", tf AS (SELECT ph.{GAPKEY.replace(", ", ", ph.")}, ph.slot, tpl AS f FROM ph JOIN gc USING ({GAPKEY}) JOIN dt ON dt.poste_id = ph.poste_id AND dt.site = ph.site AND dt.hour = ph.hour AND dt.day_type = gc.day_type)
 , dth AS (SELECT gc.{GAPKEY.replace(", ", ", gc.")}, dt.hour, dt.tpl FROM gc JOIN dt ON dt.poste_id = gc.poste_id AND dt.site = gc.site AND dt.day_type = gc.day_type)""" + anchored("tf", "dth", "gap_start, hour")
    + f""", wkd AS (SELECT {GAPKEY}, slot, {CLIP.format(v='value')} AS value FROM an LEFT JOIN med USING (poste_id, site))
 SELECT pk.{GAPKEY.replace(", ", ", pk.")}, pk.slot, round(coalesce(wkd.value, med.med, 0.0) + 1e-6, 2) AS value FROM pk JOIN gc USING ({GAPKEY}) LEFT JOIN wkd USING ({GAPKEY}, slot) LEFT JOIN med USING (poste_id, site) WHERE gc.day_type IS NOT NULL""")
def fill_weekend_template(s, d):
    r, cal = _rc(s, d), _cal(s, d)
    t = lookups.day_templates(features.day_flags(features.datetime_features(r), cal))
    return fills.weekend(router.classify(series.gaps(r)), r, t).withColumn("value", fixed("value", 2))


@query(POINTS + feat("f", "r") + HOURS + WEEKLY + MED + feat("ph", "pk") + """, mw AS (SELECT ph.*, wk.tpl AS wt, std, ht.tpl AS htp FROM ph LEFT JOIN wk USING (poste_id, site, day_of_week, hour) LEFT JOIN ht ON ht.poste_id = ph.poste_id AND ht.site = ph.site AND ht.hour = ph.hour),
 tf AS (SELECT poste_id, site, gap_start, slot, coalesce(wt, htp) AS f, round(CASE WHEN wt IS NOT NULL THEN CASE WHEN std = 0 THEN 1.0 ELSE 1 / (1 + std / (wt + 1e-6)) END WHEN htp IS NOT NULL THEN 0.5 ELSE 0.0 END + 1e-7, 3) AS pc FROM mw WHERE coalesce(wt, htp) IS NOT NULL)"""
    + anchored("tf", "wk", "day_of_week, hour") + f" SELECT an.{GAPKEY.replace(', ', ', an.')}, an.slot, round({CLIP.format(v='value')} + 1e-6, 2) AS value, pc AS point_confidence FROM an JOIN tf USING ({GAPKEY}, slot) LEFT JOIN med USING (poste_id, site)")
def fill_multi_week(s, d):
    r = _rc(s, d)
    f = features.datetime_features(r)
    return fills.multi_week(series.gaps(r), r, lookups.weekly_templates(f), lookups.hour_template(f)).withColumns({"value": fixed("value", 2), "point_confidence": fixed("point_confidence", 3)})


@query(PEER + GAPS.removeprefix(R) + """, pk AS (SELECT *, unnest(generate_series(gap_start, gap_end - 1)) AS slot FROM g)""" + MED + f"""
 SELECT pk.{GAPKEY.replace(", ", ", pk.")}, pk.slot, round({CLIP.format(v='q.value * ratio')} + 1e-6, 2) AS value FROM pk JOIN sub USING (site) JOIN ratio ON ratio.poste_id = pk.poste_id AND ratio.site = pk.site LEFT JOIN r q ON q.poste_id = pk.poste_id AND q.site = sub.parent AND q.slot = pk.slot
 LEFT JOIN med ON med.poste_id = pk.poste_id AND med.site = pk.site""")
def fill_peer(s, d):
    r, m = _rc(s, d), _meters(s, d)
    g = router.with_hierarchy(series.gaps(r), r, m)
    return fills.peer(g, r, lookups.peer_ratio(r, m)).withColumn("value", fixed("value", 2))


@query()
def fill_knn(s, d):
    """All stations, all sites; too many distances for one SQL engine on whole tables, so tested by brute force."""
    w = series.wide(_clean(s, d))
    return fills.knn(w, series.gaps(series.long(w)))


@query(POINTS + f", me AS (SELECT poste_id, site, round(avg(value), 3) AS value FROM r GROUP BY ALL) SELECT {GAPKEY}, slot, value FROM pk JOIN me USING (poste_id, site)")
def fill_mean_single(s, d):
    r = _rc(s, d)
    return fills.mean_fill(series.gaps(r), r)


@query()
def fill_mice(s, d):
    checkpoint_dir(s)
    w = series.wide(_clean(s, d)).checkpoint()
    return fills.mice_gaps(w, series.gaps(series.long(w)))


#: The smoother's closed form: -x[i-1] + 3 x[i] - x[i+1] = y[i], 0 before the first cell and level after the last; q = (3 - sqrt 5) / 2 a cell, mirrored at both ends.
_Q = "((3 - sqrt(5.0)) / 2)"
KALMAN = POINTS + f""", fl AS (SELECT poste_id, site, min(slot) AS lo, max(slot) AS hi FROM r GROUP BY ALL),
 y AS (SELECT poste_id, site, slot + d AS slot, slot AS j, value, d FROM r, range(-44, 45) t(d))
SELECT p.poste_id, p.site, p.gap_start, p.slot, round(coalesce(sum(y.value * (pow({_Q}, abs(d)) - pow({_Q}, p.slot + j - 2 * lo + 2) + pow({_Q}, 2 * hi + 1 - p.slot - j))), 0) / sqrt(5.0) + 1e-7, 3) AS value
FROM p JOIN fl USING (poste_id, site) LEFT JOIN y USING (poste_id, site, slot) GROUP BY ALL"""


@query(KALMAN)
def fill_kalman(s, d):
    r = _rc(s, d)
    return fills.kalman(r, series.gaps(r)).withColumn("value", fixed("value", 3))


@query(POINTS + f" SELECT {GAPKEY}, slot, CAST(0.0 AS DOUBLE) AS value FROM pk")
def naive_zero_fill(s, d):
    return fills.zero(series.gaps(_r(s, d)))


@query(POINTS + f" SELECT pk.{GAPKEY.replace(', ', ', pk.')}, pk.slot, q.value FROM pk LEFT JOIN r q ON q.poste_id = pk.poste_id AND q.site = pk.site AND q.slot = pk.slot - 1008")
def prior_week_baseline(s, d):
    r = _rc(s, d)
    return fills.prior_week(series.gaps(r), r)


@query(R + MED + f" SELECT r.poste_id, r.site, slot, round({CLIP.format(v='value')} + 1e-7, 3) AS value FROM r JOIN med USING (poste_id, site)")
def validate_clip(s, d):
    r = _r(s, d)
    return r.join(fills.medians(r), KEY).select(*KEY, "slot", fixed(fills.clip(F.col("value"), F.col("med"), F.col("top")), 3).alias("value"))


def _savgol(width: int = 21, degree: int = 3) -> str:
    """The weights by the closed form for a cubic: 3 * (3 m^2 + 3 m - 1 - 5 i^2) / ((2 m - 1) (2 m + 1) (2 m + 3)), m slots on either side."""
    m = width // 2
    w = f"3.0 * (3 * {m} * {m} + 3 * {m} - 1 - 5 * i * i) / ((2 * {m} - 1) * (2 * {m} + 1) * (2 * {m} + 3))"
    return R + f""", e AS (SELECT poste_id, site, slot + i AS slot, sum(value * {w}) AS smooth, count(*) AS n, max(value) FILTER (WHERE i = 0) AS value FROM r, range({-m}, {m + 1}) t(i) GROUP BY ALL)
SELECT poste_id, site, slot, value, round(smooth + 1e-7, 3) AS smooth FROM e WHERE n = {width} AND value IS NOT NULL"""


@query(_savgol())
def savgol_smooth(s, d):
    return fills.savgol(_r(s, d)).withColumn("smooth", fixed("smooth", 3))


# ---- flags, audit, evaluation ------------------------------------------------------------------------------------------

QUALITY = CONF + f", ql AS (SELECT poste_id, site, slot, 0 AS quality FROM r UNION ALL SELECT poste_id, site, unnest(generate_series(gap_start, gap_end - 1)), CAST({FLAG} AS INTEGER) FROM cf)"


@query(QUALITY + " SELECT poste_id, site, slot, CAST(quality AS INTEGER) AS quality FROM ql")
def quality_flags(s, d):
    r = _rc(s, d)
    return audit.quality(series.grid(r), _routed(s, d, r=r)).select(*KEY, "slot", "quality")


@query(QUALITY + " SELECT poste_id, site, CAST(quality AS INTEGER) AS quality, count(*) AS n FROM ql GROUP BY ALL")
def flag_counts(s, d):
    return quality_flags(s, d).groupBy(*KEY, "quality").agg(F.count("*").alias("n"))


@query(CONF + feat("gp", "(SELECT poste_id, site, gap_start, unnest(generate_series(gap_start, gap_end - 1)) AS slot FROM rt)") + occ("go", "gp") + f""", dl AS (SELECT DISTINCT {GAPKEY}, local_date, day_of_week FROM go), fd AS (SELECT {GAPKEY}, day_of_week, min(local_date) AS first FROM dl GROUP BY ALL),
 ds AS (SELECT {GAPKEY}, string_agg(day_of_week, ', ' ORDER BY first) AS days FROM fd GROUP BY ALL), oc AS (SELECT {GAPKEY}, occupancy_type, min(slot) AS first_slot, bool_or(is_holiday) AS hol FROM go GROUP BY ALL), os AS (SELECT {GAPKEY}, string_agg(occupancy_type, ', ' ORDER BY first_slot) AS occupancies, bool_or(hol) AS has_holiday FROM oc GROUP BY ALL)
 SELECT {GAPKEY}, gap_end, gap_size, strategy, confidence, days, occupancies, has_holiday FROM cf JOIN ds USING ({GAPKEY}) JOIN os USING ({GAPKEY})""")
def gap_log(s, d):
    return audit.gap_log(_confident(s, d), _cal(s, d))


_ISO = "strftime({l}, '%Y-%m-%dT%H:%M:%S') || '+0' || CAST((epoch({l}) - {s} * 600) // 3600 AS INTEGER) || '00'"
BOUNDS = ", bd AS (SELECT poste_id, site, round(CASE WHEN count(*) < 10 THEN 0.0 ELSE greatest(0.0, avg(value) - 2 * stddev_samp(value)) END + 1e-6, 2) AS lower, round(CASE WHEN count(*) < 10 THEN 1.5 * max(value) ELSE avg(value) + 2 * stddev_samp(value) END + 1e-6, 2) AS upper FROM r GROUP BY ALL)"


@query(CONF + PEER.removeprefix(R) + BOUNDS + feat("gp", "(SELECT poste_id, site, gap_start, unnest(generate_series(gap_start, gap_end - 1)) AS slot FROM rt)") + occ("go", "gp") + f""", fd AS (SELECT {GAPKEY}, day_of_week, min(local_date) AS first FROM go GROUP BY ALL),
 ds AS (SELECT {GAPKEY}, string_agg(day_of_week, ', ' ORDER BY first) AS unique_days FROM fd GROUP BY ALL), hs AS (SELECT {GAPKEY}, count(*) FILTER (WHERE is_holiday) AS holiday_slots FROM go GROUP BY ALL)
 SELECT {GAPKEY}, gap_end, gap_size * 10 AS gap_size_minutes, {_ISO.format(l=_LOCAL.format(s="gap_start"), s="gap_start")} AS first_missing, {_ISO.format(l=_LOCAL.format(s="(gap_end - 1)"), s="(gap_end - 1)")} AS last_missing,
  unique_days, holiday_slots, strategy, confidence, concat_ws(' -> ', 'START: size=' || gap_size || ', tier=' || tier,
   CASE WHEN strategy = 'MULTI_WEEK_TEMPLATE' THEN 'BRANCH: MULTI_WEEK_TEMPLATE (longer than a chunk)' WHEN strategy = 'MICE' THEN 'BRANCH: ML_CASCADE (size>50, non-entry) -> TRY: MICE' WHEN tier = 'sub' AND parent_present THEN 'BRANCH: PEER_CORRELATION (sub-meter)'
    WHEN tier = 'sub' THEN 'BRANCH: PEER_CORRELATION (sub-meter) -> SKIP: parent has no data in gap window' END,
   CASE WHEN strategy = 'LINEAR_MICRO' THEN 'BRANCH: LINEAR_MICRO (size<=3)' WHEN strategy = 'LINEAR_SHORT' THEN 'BRANCH: LINEAR_SHORT (size<=18)' WHEN strategy LIKE 'WEEKEND%' THEN 'BRANCH: WEEKEND_TEMPLATE (' || day_type || ')'
    WHEN strategy = 'THERMAL_TEMPLATE' THEN 'BRANCH: THERMAL_TEMPLATE (non-entry, <=1 day)' WHEN strategy = 'ENHANCED_TEMPLATE' THEN 'BRANCH: ENHANCED_TEMPLATE (non-entry, >1 day)' WHEN strategy = 'SAFE_LINEAR_MEDIAN' THEN 'BRANCH: SAFE_LINEAR_MEDIAN (entry meter fallback)' END,
   'SELECTED: ' || strategy || ' (confidence=' || CAST(round(confidence + 1e-7, 3) AS DOUBLE) || ')') AS routing_trace, CASE WHEN strategy = 'PEER_CORRELATION' THEN ratio END AS peer_ratio, lower, upper
 FROM cf JOIN ds USING ({GAPKEY}) JOIN hs USING ({GAPKEY}) LEFT JOIN ratio USING (poste_id, site) LEFT JOIN bd USING (poste_id, site)""")
def gap_details(s, d):
    r = _rc(s, d)
    c = router.with_confidence(_routed(s, d, r=r), _cal(s, d))
    x = audit.gap_details(c, _cal(s, d), lookups.peer_ratio(r, _meters(s, d)), lookups.uncertainty_bounds(r))
    return x.withColumns({"lower": fixed("lower", 2), "upper": fixed("upper", 2)})


@query()
def gap_records(s, d):
    r = _rc(s, d)
    c = router.with_confidence(_routed(s, d, r=r), _cal(s, d))
    return audit.gap_records(c, _cal(s, d), lookups.weekly_templates(features.datetime_features(r)), lookups.peer_ratio(r, _meters(s, d)), lookups.uncertainty_bounds(r))


@query(CONF + """ SELECT poste_id, site, count(*) AS gaps, CAST(sum(gap_size) AS BIGINT) AS missing_slots, array_to_string(list_sort(list_distinct(list(strategy))), ', ') AS methods, round(avg(confidence) + 1e-8, 4) AS mean_confidence, min(confidence) AS min_confidence, count(*) FILTER (WHERE confidence < 0.5) AS low_confidence FROM cf GROUP BY ALL""")
def run_summary(s, d):
    return audit.run_summary(_confident(s, d))


#: Two masks a series: two hours a day after its first reading, and a day and a half in its middle.
MASKS = """, mk AS (SELECT poste_id, site, min(slot) + 144 AS mask_start, min(slot) + 155 AS mask_end FROM r GROUP BY ALL UNION ALL SELECT poste_id, site, (min(slot) + max(slot)) // 2, (min(slot) + max(slot)) // 2 + 215 FROM r GROUP BY ALL),
 ms AS (SELECT DISTINCT poste_id, site, unnest(generate_series(mask_start, mask_end)) AS slot FROM mk), mr AS (SELECT r.*, ms.slot IS NOT NULL AS masked FROM r LEFT JOIN ms USING (poste_id, site, slot))"""


def _masked(s, d):
    r = _rc(s, d)
    b = r.groupBy(*KEY).agg(F.min("slot").alias("a"), F.max("slot").alias("z"))
    mid = F.floor((F.col("a") + F.col("z")) / 2)
    m = b.select(*KEY, (F.col("a") + 144).alias("mask_start"), (F.col("a") + 155).alias("mask_end")).unionByName(b.select(*KEY, mid.alias("mask_start"), (mid + 215).alias("mask_end")))
    return evaluate.apply_test_gaps(r, m)


@query(R + MASKS + " SELECT * FROM mr")
def apply_test_gaps(s, d):
    return _masked(s, d)


REPORT = R + MASKS + f""", tr AS (SELECT poste_id, site, slot, value FROM mr WHERE NOT masked), tg AS (SELECT poste_id, site, slot + 1 AS gap_start, nxt AS gap_end, nxt - slot - 1 AS gap_size, value AS y_l, nv AS y_r FROM (SELECT *, lead(slot) OVER n AS nxt, lead(value) OVER n AS nv FROM tr WINDOW n AS (PARTITION BY poste_id, site ORDER BY slot)) WHERE nxt > slot + 1),
 tp AS (SELECT *, slot - gap_start + 1 AS k FROM (SELECT *, unnest(generate_series(gap_start, gap_end - 1)) AS slot FROM tg)), fl AS (SELECT poste_id, site, slot, {LINEAR} AS imputed FROM tp),
 rp AS (SELECT mr.poste_id, mr.site, mr.slot, mr.value AS ground_truth, imputed, abs(imputed - mr.value) AS abs_error FROM mr LEFT JOIN fl USING (poste_id, site, slot) WHERE masked)"""


def _report(s, d):
    m = _masked(s, d)
    return evaluate.report_points(m, fills.linear(series.gaps(m.where("not masked").drop("masked"))))


@query(REPORT + " SELECT poste_id, site, slot, ground_truth, round(imputed + 1e-7, 3) AS imputed, round(abs_error + 1e-7, 3) AS abs_error FROM rp")
def test_report_points(s, d):
    return _report(s, d).withColumns({"imputed": fixed("imputed", 3), "abs_error": fixed("abs_error", 3)})


@query(REPORT + " SELECT poste_id, site, round(avg(abs_error) + 1e-6, 2) AS mae, round(sqrt(avg(abs_error * abs_error)) + 1e-6, 2) AS rmse, round(max(abs_error) + 1e-6, 2) AS max_err, count(*) AS n_points, count(ground_truth) AS n_ground_truth FROM rp GROUP BY ALL")
def test_report_metrics(s, d):
    return evaluate.report_metrics(_report(s, d)).withColumns({c: fixed(c, 2) for c in ("mae", "rmse", "max_err")})


@query(CONF + MASKS + f", go AS (SELECT poste_id, site, gap_start, unnest(generate_series(gap_start, gap_end - 1)) AS slot FROM cf) SELECT DISTINCT cf.{GAPKEY.replace(', ', ', cf.')}, cf.gap_end, strategy, confidence FROM cf JOIN go USING ({GAPKEY}) JOIN ms ON ms.poste_id = go.poste_id AND ms.site = go.site AND ms.slot = go.slot")
def strategy_lines_for_mask(s, d):
    """Log lines of gaps that overlap a mask."""
    c, b = _confident(s, d), _r(s, d).groupBy(*KEY).agg(F.min("slot").alias("a"), F.max("slot").alias("z"))
    mid = F.floor((F.col("a") + F.col("z")) / 2)
    both = F.explode(F.array(F.struct((F.col("a") + 144).alias("x"), (F.col("a") + 155).alias("y")), F.struct(mid.alias("x"), (mid + 215).alias("y"))))
    return c.join(b.select(*KEY, both.alias("m")), KEY).where("gap_start <= m.y and gap_end > m.x").select(*router.GAP, "gap_end", "strategy", "confidence").distinct()


@query("""WITH t AS (SELECT poste_id, CAST(epoch_us(Date) // 600000000 AS BIGINT) AS slot, min(name) AS name, arg_max(CASE WHEN isnan(Ptot_HA) THEN NULL ELSE Ptot_HA END, recon_id) AS value, max(quality_ha) AS quality, max(Ptot_RIZOMM) AS Ptot_RIZOMM FROM conso_historiques_reconstructed GROUP BY ALL),
 b AS (SELECT poste_id, CAST(floor((epoch_us(Date) + 300000000) / 600000000.0) AS BIGINT) AS slot, arg_max(Ptot_HA, reading_id) AS value, 0 AS quality FROM conso_historiques_clean WHERE Ptot_HA IS NOT NULL AND NOT isnan(Ptot_HA) GROUP BY ALL)
SELECT poste_id, slot, t.name, CASE WHEN b.quality IS NOT NULL THEN b.value ELSE t.value END AS value, CAST(coalesce(b.quality, t.quality) AS INTEGER) AS quality, t.Ptot_RIZOMM FROM t FULL JOIN b USING (poste_id, slot)""")
def upsert_columns(s, d):
    """The reconstructed windows with fresh readings put in; columns that the batch doesn't have stay."""
    t = table(s, d, "conso_historiques_reconstructed").withColumn("slot", F.floor(F.unix_micros(F.col("Date").cast("timestamp")) / 600_000_000))
    t = t.groupBy("poste_id", "slot").agg(F.min("name").alias("name"), F.max_by(number(F.col("Ptot_HA")), F.when(number(F.col("Ptot_HA")).isNotNull(), F.col("recon_id"))).alias("value"), F.max("quality_ha").alias("quality"), F.max("Ptot_RIZOMM").alias("Ptot_RIZOMM"))
    b = series.wide(_clean(s, d), ("Ptot_HA",)).where("Ptot_HA is not null").select("poste_id", "slot", F.col("Ptot_HA").alias("value"), F.lit(0).alias("quality"))
    return audit.upsert(t, b, ["poste_id", "slot"])


@query(POINTS + MED + """, ord AS (SELECT r.poste_id, r.site, slot, value FROM r JOIN med USING (poste_id, site) WHERE abs(value - med) <= 0.25 * med), zf AS (SELECT poste_id, site, slot, gap_start FROM p WHERE gap_size <= 3),
 col AS (SELECT poste_id, site, slot, value, NULL AS gap_start FROM ord UNION ALL SELECT poste_id, site, slot, 0.0, gap_start FROM zf), cs AS (SELECT poste_id, site, median(value) AS med, stddev_samp(value) AS sd FROM col GROUP BY ALL HAVING count(*) >= 20)
SELECT poste_id, site, gap_start, slot, value FROM col JOIN cs USING (poste_id, site) WHERE gap_start IS NOT NULL AND value <= 0.01 * med AND (value - med) / (sd + 1e-9) < -3""")
def zero_fill_scan(s, d):
    """Filled numbers that are implausibly near zero, of columns of ordinary load (within a quarter of the median) whose short gaps are filled with zeros."""
    r = _rc(s, d)
    usual = r.join(fills.medians(r), KEY).where(F.abs(F.col("value") - F.col("med")) <= 0.25 * F.col("med")).select(*KEY, "slot", "value")
    return anomaly.zero_fills(usual, fills.zero(series.gaps(r).where("gap_size <= 3")))


@query(POINTS + f", lf AS (SELECT poste_id, site, slot, {LINEAR} AS v FROM pk) SELECT w.poste_id, w.slot, round(coalesce(r.value, lf.v) + 1e-7, 3) AS value FROM w LEFT JOIN r ON r.poste_id = w.poste_id AND r.slot = w.slot AND r.site = 'Ptot_HA' LEFT JOIN lf ON lf.poste_id = w.poste_id AND lf.slot = w.slot AND lf.site = 'Ptot_HA'")
def project_back(s, d):
    """The filled Ptot_HA at the slots that were delivered."""
    w = series.wide(_clean(s, d))
    r = series.long(w).where("site = 'Ptot_HA'")
    done = r.select("poste_id", "slot", "value").unionByName(fills.linear(series.gaps(r)).select("poste_id", "slot", "value"))
    return w.select("poste_id", "slot").join(done, ["poste_id", "slot"], "left").withColumn("value", fixed("value", 3))


@query(GAPS + TARGET.split(",\n win AS")[0] + " SELECT poste_id, site, greatest(gap_start - (target - 1008), 0) AS idx_start, least(gap_end - (target - 1008), 1008) AS idx_end FROM g JOIN tg USING (poste_id) WHERE gap_end > target - 1008 AND gap_start < target")
def shift_log(s, d):
    """Gaps in positions of the last week's window, cut to it; those wholly before or after it dropped."""
    r = _rc(s, d)
    start = F.col("target") - 1008
    g = series.gaps(r).join(window.targets(r), "poste_id").where((F.col("gap_end") > start) & (F.col("gap_start") < F.col("target")))
    return g.select(*KEY, F.greatest(F.col("gap_start") - start, F.lit(0)).alias("idx_start"), F.least(F.col("gap_end") - start, F.lit(1008)).alias("idx_end"))


@query(SQL["fill_multi_week"].replace("pc AS point_confidence FROM an", "CAST((an.k - 1) // 96 AS INTEGER) AS chunk_index FROM an") + " WHERE an.gap_size > 96")
def chunked_recovery(s, d):
    """Gaps longer than a chunk: the weekly template chunk by chunk, anchored and clipped once over the whole gap."""
    r = _rc(s, d)
    f, g = features.datetime_features(r), series.gaps(r).where("gap_size > 96")
    v = fills.multi_week(g, r, lookups.weekly_templates(f), lookups.hour_template(f))
    return v.select(*router.GAP, "slot", fixed("value", 2).alias("value"), F.floor((F.col("slot") - F.col("gap_start")) / 96).cast("int").alias("chunk_index"))


@query()
def daily_windows(s, d):
    return daily.run(_clean(s, d), _meters(s, d), table(s, d, "calendar_days")).windows


@query()
def reconstruct(s, d):
    return engine.reconstruct(_clean(s, d), _meters(s, d), table(s, d, "calendar_days")).values
