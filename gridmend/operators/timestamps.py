"""Mixed timestamp notations and time zones to one instant (problem 4)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from functools import lru_cache
from math import log
from zoneinfo import ZoneInfo

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmend.functions.cols import floordiv, ref

EPOCH = datetime(1970, 1, 1)
#: Chunks at or below this hold lines without a place in their source.
ALONE = -(1 << 50)
#: Offsets in minutes of the zone abbreviations that are read.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "MEZ": 60, "MESZ": 120, "EET": 120, "EEST": 180,
    "MSK": 180, "IST": 330, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "RET": 240,
}
#: Names of the months in the languages that are read, in order.
MONTHS = {
    name: i % 12 + 1
    for i, name in enumerate(
        "january february march april may june july august september october november december"
        " janvier février mars avril mai juin juillet août septembre octobre novembre décembre"
        " januar februar märz april mai juni juli august september oktober november dezember"
        " jan feb mar apr may jun jul aug sep oct nov dec".split()
    )
} | {"fevrier": 2, "aout": 8, "decembre": 12, "maerz": 3, "mrz": 3, "sept": 9, "okt": 10, "dez": 12, "jänner": 1}

_TIME = r"(?P<h>\d{1,2}):(?P<mi>\d{2})(?::(?P<s>\d{2})(?:[.,](?P<f>\d{1,9}))?)?"
_ZONE = r"(?:\s*(?P<off>(?:GMT|UTC)?[+-]\d{2}(?::?\d{2})?)|\s*(?P<ab>[A-Za-z]{1,5}))?(?:\[(?P<zone>[A-Za-z_/+\-0-9]+)\])?"
_HALF = r"(?:\s*(?P<ap>[AaPp])\.?[Mm]\.?)?"
FORMATS = [
    (name, re.compile(rx + r"\Z"))
    for name, rx in (
        ("iso", r"(?P<y>\d{4})-(?P<mo>\d{2})-(?P<d>\d{2})[T ]" + _TIME + _ZONE),
        ("year_first_slash", r"(?P<y>\d{4})[/.](?P<mo>\d{2})[/.](?P<d>\d{2})[T ]" + _TIME + _ZONE),
        ("ordinal", r"(?P<y>\d{4})-(?P<doy>\d{3})[T ]" + _TIME + _ZONE),
        ("compact", r"(?P<y>\d{4})(?P<mo>\d{2})(?P<d>\d{2})T?(?P<h>\d{2})(?P<mi>\d{2})(?P<s>\d{2})(?:[.,](?P<f>\d{1,9}))?" + _ZONE),
        ("epoch_s", r"(?P<es>\d{9,10})(?:\.(?P<f>\d{1,9}))?"),
        ("epoch_ms", r"(?P<ems>\d{12,13})(?:\.(?P<f>\d{1,6}))?"),
        ("epoch_us", r"(?P<eus>\d{16})"),
        ("epoch_ns", r"(?P<ens>\d{19})"),
        ("year_last", r"(?P<a>\d{1,2})(?P<sep>[/.\-])(?P<b>\d{1,2})(?P=sep)(?P<y>\d{4}|\d{2}),?[T ]" + _TIME + _HALF + _ZONE),
        ("mail", r"(?P<wd>[A-Za-z]{3}),\s*(?P<d>\d{1,2}) (?P<mon>[^\W\d]+)\.? (?P<y>\d{4}) " + _TIME + _ZONE),
        ("day_name_month", r"(?P<d>\d{1,2})(?:\.|er)? (?P<mon>[^\W\d]+)\.? (?P<y>\d{4}),?(?: à| um)? (?:" + _TIME + r"(?: Uhr)?|(?P<fh>\d{1,2})\s?h\s?(?P<fm>\d{2}))" + _ZONE),
        ("month_name_day", r"(?P<mon>[^\W\d]+)\.? (?P<d>\d{1,2}),? (?P<y>\d{4}),?(?: at)? " + _TIME + _HALF + _ZONE),
    )
]


def _us(local: datetime) -> int:
    return (local - EPOCH) // timedelta(microseconds=1)


@lru_cache(4096)
def _zone(name: str) -> ZoneInfo | None:
    try:
        return ZoneInfo(name)
    except (KeyError, ValueError, OSError):
        return None


@lru_cache(65536)
def _offsets(tz: str, minute: int) -> tuple[int, ...]:
    """The offsets (minutes, earlier instant first) at which this wall-clock minute occurred in the zone; none if it was skipped."""
    zone = _zone(tz)
    if zone is None:
        return ()
    local, found = EPOCH + timedelta(minutes=minute), []
    for fold in (0, 1):
        aware = local.replace(tzinfo=zone, fold=fold)
        if aware.astimezone(UTC).astimezone(zone).replace(tzinfo=None) == local:
            off = int(aware.utcoffset().total_seconds() // 60)
            if off not in found:
                found.append(off)
    return tuple(found)


def interpretations(text: str | None, tz: str | None, day_first: bool | None) -> list[tuple[str, int]]:
    """All valid readings of a stamp as (format, microseconds since 1970 UTC), without repeats."""
    if text is None:
        return []
    s = text.strip(" \t\r\n\f\v﻿ \"'")
    out: list[tuple[str, int]] = []
    for name, rx in FORMATS:
        m = rx.match(s)
        if not m:
            continue
        g = m.groupdict()
        frac = int((g.get("f") or "0").ljust(9, "0")[:9])  # nanoseconds, or the like of the unit
        if name.startswith("epoch"):
            us = {"epoch_s": lambda: int(g["es"]) * 1_000_000 + frac // 1000, "epoch_ms": lambda: int(g["ems"]) * 1000 + frac // 1_000_000, "epoch_us": lambda: int(g["eus"]), "epoch_ns": lambda: int(g["ens"]) // 1000}[name]()
            out.append((name, us))
            continue
        hour, minute = int(g.get("h") or g.get("fh") or 0), int(g.get("mi") or g.get("fm") or 0)
        if ap := g.get("ap"):
            if not 1 <= hour <= 12:
                continue
            hour = hour % 12 + 12 * (ap in "Pp")
        year = int(g["y"]) + (2000 if len(g["y"]) == 2 else 0)
        if name == "year_last":
            orders = [(0, 1)] if day_first else [(1, 0)] if day_first is not None else [(0, 1), (1, 0)]
            ab = (int(g["a"]), int(g["b"]))
            dates = [(f"{name}_{'dm' if i == 0 else 'md'}{g['sep']}", ab[j], ab[i]) for i, j in orders]
        elif name == "ordinal":
            dates = [(name, 1, 1)]
        else:
            mo = int(g["mo"]) if g.get("mo") else MONTHS.get(g["mon"].lower(), 0)
            dates = [(name, mo, int(g["d"]))]
        for label, month, day in dates:
            try:
                local = datetime(year, month, day, hour, minute, int(g.get("s") or 0), frac // 1000)
            except ValueError:
                continue
            if name == "ordinal":
                local += timedelta(days=int(g["doy"]) - 1)
                if g["doy"] == "000" or local.year != year:
                    continue
            if g.get("off"):
                o = g["off"].removeprefix("GMT").removeprefix("UTC").replace(":", "")
                offs = (int(o[0] + "1") * (int(o[1:3]) * 60 + int(o[3:] or 0)),)
                label += "+off"
            elif g.get("ab"):
                if g["ab"].upper() not in ABBREVIATIONS:
                    continue
                offs = (ABBREVIATIONS[g["ab"].upper()],)
                label += "+abbr"
            elif g.get("zone") or tz:
                offs = _offsets(g.get("zone") or tz, _us(local) // 60_000_000)
            else:
                continue
            out += [(label, _us(local) - o * 60_000_000) for o in offs]
    return list(dict.fromkeys(out))


def viterbi(options: list[list[tuple[str, int]]], switch: float = 1.0, backward: float = 50.0, repeat: float = 3.0, step_us: int = 600_000_000) -> list[int]:
    """For each value the index of the reading chosen (-1 where there is none) on the cheapest path through a source's records.

    A change of format costs `switch`; a step back in time `backward` (and more the further it goes), standing still `repeat`; forward steps cost by
    how far they are from the usual step, so gaps are taken when nothing else fits. Equal paths go to the earlier option.
    """
    chosen = [-1] * len(options)
    last, back = None, []
    for i, opts in enumerate(options):
        if not opts:
            continue
        if last is None:
            costs = [1e-6 * k for k in range(len(opts))]
            back.append((i, [None] * len(opts)))
        elif len(opts) == 1 and len(last[1]) == 1:
            # one way from one reading to one: what it costs decides nothing
            costs = [0.0]
            back.append((i, [0]))
        else:
            costs, frm = [], []
            for k, (fmt, t) in enumerate(opts):
                best, arg = None, 0
                for j, (pf, pt) in enumerate(last[1]):
                    dt = t - pt
                    c = last[0][j] + (switch if fmt != pf else 0.0)
                    c += backward + log(1 - dt / step_us) if dt < 0 else repeat if dt == 0 else abs(log(dt / step_us))
                    if best is None or c < best - 1e-9:
                        best, arg = c, j
                costs.append(best + 1e-6 * k)
                frm.append(arg)
            back.append((i, frm))
        last = (costs, opts)
    if last is None:
        return chosen
    k = min(range(len(last[0])), key=last[0].__getitem__)
    for i, frm in reversed(back):
        chosen[i] = k
        k = frm[k]
    return chosen


def normalise(lines: DataFrame, loggers: DataFrame, line_id: str = "line_id", source: str = "delivery_id", order: str = "line_no", stamp: str = "Date", logger: str = "logger_id", tz: str = "tz", day_first: str = "day_first", chunk: int = 4096, halo: int = 256) -> DataFrame:
    """(line_id, utc_us, format, n_readings): one row per line; utc_us is null where the stamp can't be read.

    Every stamp is read in all ways that give an existing date and, for wall-clock times, an hour the logger's zone had (two where it occurred
    twice). A Viterbi path over the source's records in order chooses. A stamp without a zone of a logger that isn't known, or whose zone isn't, can't
    be read; without day_first both orders of an all-digit date are tried. Ties in order go by line_id; a null source is one source; a line with a null order is read alone. Fractions are cut to
    microseconds. Empty input gives an empty result; extra columns are ignored.

    Plan: the lines are shuffled once by (source, chunk of order), chunks overlapping by `halo` records, sorted and streamed through Arrow; the longest source is thus
    spread over tasks. loggers has one row per logger and is joined as Spark sees fit.
    """
    r = lines.select(ref(line_id).alias("id"), ref(source).alias("src"), ref(order).cast("bigint").alias("no"), ref(stamp).cast("string").alias("stamp"), ref(logger).alias("lg"))
    known = loggers.select(ref(logger).alias("lg"), ref(tz).alias("tz"), ref(day_first).alias("df")).where("lg is not null").groupBy("lg").agg(F.min("tz").alias("tz"), F.min("df").alias("df"))
    # lines without a place in their source are read each alone, and lie wherever their ids fall
    chunks = F.when(F.col("no").isNull(), F.array(F.lit(ALONE) - F.pmod(F.xxhash64("id"), F.lit(1 << 20)))).otherwise(F.sequence(floordiv(F.col("no") - halo, chunk), floordiv(F.col("no") + halo, chunk)))
    r = r.join(known, "lg", "left").withColumn("chunk", F.explode(chunks))
    r = r.select("src", "chunk", "no", "id", "stamp", "tz", "df").repartition("src", "chunk").sortWithinPartitions("src", "chunk", "no", "id")

    def solve(rows: list[tuple]) -> Iterator[tuple]:
        lo, alone = rows[0][1] * chunk, rows[0][1] <= ALONE
        if not alone and (rows[0][2] >= lo + chunk or rows[-1][2] < lo):
            return  # a chunk of others' margins only
        options = [interpretations(x[4], x[5], x[6]) for x in rows]
        chosen = [viterbi([x])[0] for x in options] if alone else viterbi(options)
        for x, opts, k in zip(rows, options, chosen):
            if alone or lo <= x[2] < lo + chunk:
                yield x[3], opts[k][1] if k >= 0 else None, opts[k][0] if k >= 0 else None, len(opts)

    kind = r.schema["id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", id_type), ("utc_us", pa.int64()), ("format", pa.string()), ("n_readings", pa.int32())])
        held: list[tuple] = []
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out)) or [()] * 4
            b = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)
            out.clear()
            return b

        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns]):
                if held and held[0][:2] != row[:2]:
                    out.extend(solve(held))
                    held = []
                held.append(row)
            if out:
                yield batch()
        if held:
            out.extend(solve(held))
            yield batch()

    return r.mapInArrow(run, f"id {kind.simpleString()}, utc_us bigint, format string, n_readings int").withColumnRenamed("id", line_id)
