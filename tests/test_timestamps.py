from datetime import UTC, datetime

import pytest

from gridmend.operators.timestamps import interpretations, normalise, viterbi


def us(*a):
    return int(datetime(*a, tzinfo=UTC).timestamp()) * 1_000_000


@pytest.mark.parametrize(
    ("text", "tz", "first", "want"),
    [
        ("2024-09-14T05:30:00Z", "Europe/Paris", True, us(2024, 9, 14, 5, 30)),
        (' "2024-09-14 05:30:00,250"\r', "Europe/Paris", True, us(2024, 9, 14, 3, 30) + 250_000),
        ("2023-04-09T06:50:00.123456789Z", None, None, us(2023, 4, 9, 6, 50) + 123_456),
        ("25/10/25 22:00", "Europe/Paris", True, us(2025, 10, 25, 20)),
        ("04/05/2024 12:10:00 AM", "America/New_York", False, us(2024, 4, 5, 4, 10)),
        ("27/10/2024 00:10 GMT+02:00", "Asia/Kolkata", True, us(2024, 10, 26, 22, 10)),
        ("Sun, 09 Apr 2023 04:30:00 +0530", "UTC", True, us(2023, 4, 8, 23)),
        ("9. April 2023, 11:00 Uhr", "Europe/Paris", True, us(2023, 4, 9, 9)),
        ("21 décembre 2023 7h20", "Europe/Paris", True, us(2023, 12, 21, 6, 20)),
        ("March 5, 2022 12:00 PM", "America/New_York", False, us(2022, 3, 5, 17)),
        ("2025-113T08:10:00Z", "UTC", True, us(2025, 4, 23, 8, 10)),
        ("20230409034000", "UTC", True, us(2023, 4, 9, 3, 40)),
        ("1672532418.925", "UTC", True, 1_672_532_418_925_000),
        ("1758445200000", "UTC", True, 1_758_445_200_000_000),
        ("2024-03-30 17:10:00 EET", "Europe/Paris", True, us(2024, 3, 30, 15, 10)),
        ("2025-05-15T19:00:30-04:00[America/New_York]", "UTC", True, us(2025, 5, 15, 23, 0, 30)),
    ],
)
def test_notations(text, tz, first, want):
    assert [t for _, t in interpretations(text, tz, first)] == [want]


@pytest.mark.parametrize("text", [None, "", "n/a", "--", "25:61", "hier 14h", "#REF!", "2024-02-30 10:20:00", "2023-13-05T04:10:00Z", "2022-03-27 02:30:00", "2025-366T00:00:00Z", "x" * 100_000])
def test_unreadable(text):
    assert interpretations(text, "Europe/Paris", True) == []


def test_all_readings_of_ambiguous_stamps():
    assert len(interpretations("2025-10-26 02:30:00", "Europe/Paris", True)) == 2
    assert len(interpretations("03/04/2025 10:00", "UTC", None)) == 2
    assert interpretations("2025-10-26 02:30:00", None, True) == [] and interpretations("2025-10-26 02:30:00", "No/Where", True) == []


def test_order_decides_on_the_hour_that_occurs_twice(spark):
    stamps = ["01:50", "02:00", "02:10", "02:30", "02:50", "02:00", "02:20", "x", "02:40", "03:00"]
    lines = spark.createDataFrame([(i, 1, i, 7, f"2025-10-26 {s}:00", "u") for i, s in enumerate(stamps)] + [(99, 2, 1, 8, "2025-10-26 05:00:00", "u"), (98, None, None, 7, "2025-01-01 00:00:00", "u")], "line_id bigint, delivery_id bigint, line_no int, logger_id int, Date string, utc_us string")
    loggers = spark.createDataFrame([(7, "Europe/Paris", True), (7, "Europe/Paris", True), (None, "UTC", True)], "logger_id int, tz string, day_first boolean")
    got = {r["line_id"]: r["utc_us"] for r in normalise(lines, loggers).collect()}
    base = us(2025, 10, 25, 23, 50)
    assert [None if got[i] is None else (got[i] - base) // 60_000_000 for i in range(10)] == [0, 10, 20, 40, 60, 70, 90, None, 110, 130]
    assert got[99] is None and got[98] == us(2024, 12, 31, 23)
    assert normalise(lines.limit(0), loggers).count() == 0
    assert {r["line_id"]: r["utc_us"] for r in normalise(lines, loggers, chunk=3, halo=8).collect()} == got


def test_viterbi_prefers_forward_paths():
    assert viterbi([[("a", 0)], [("a", 600_000_000), ("b", -600_000_000)], [], [("b", 1_200_000_000)]]) == [0, 0, -1, 0]
    assert viterbi([]) == [] and viterbi([[], []]) == [-1, -1]


def test_lines_without_a_place_are_read_alone_and_spread(spark):
    rows = [(i, 1, None, 7, f"2025-01-01 {i % 24:02d}:00:00") for i in range(500)] + [(1000, 1, 1, 7, "2025-10-26 02:30:00"), (1001, 1, None, 7, "2025-10-26 02:30:00")]
    lines = spark.createDataFrame(rows, "line_id bigint, delivery_id bigint, line_no int, logger_id int, Date string")
    loggers = spark.createDataFrame([(7, "Europe/Paris", True)], "logger_id int, tz string, day_first boolean")
    got = {r["line_id"]: r["utc_us"] for r in normalise(lines, loggers).collect()}
    assert len(got) == 502 and all(got[i] == us(2024, 12, 31, 23) + (i % 24) * 3_600_000_000 for i in range(500)) and got[1000] == got[1001] == us(2025, 10, 26, 0, 30)
