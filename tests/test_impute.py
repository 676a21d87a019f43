from pyspark.sql import functions as F

from gridmend.operators.impute import Limits, Target, fill_cells, fill_table, mine, search


def frame(spark):
    rows = [(i, i % 10, float(i % 10) * 2, i % 3, "x") for i in range(300)]
    rows += [(1000, 4, None, 0, "x"), (1001, 4, float("nan"), 0, "x"), (1002, 77, None, 1, "x"), (1003, None, None, None, None), (1003, None, None, None, None)]
    return spark.createDataFrame(rows, "id bigint, k int, v double, g int, value string")


def keys():
    return {"k": F.col("k"), "g": F.col("g")}


def test_dependency_group_and_overall(spark):
    df = frame(spark)
    out = sorted((r["id"], r["value"], r["how"]) for r in fill_cells(df, "id", keys(), Target("v", (("k",), ("g",)), (("g",),))).collect())
    assert out[:2] == [(1000, 8.0, "fd:k"), (1001, 8.0, "fd:k")] and out[2][2] == "group:g" and [x[2] for x in out[3:]] == ["all", "all"] and all(x[1] is not None for x in out)
    filled = fill_table(df.where("id <> 1003"), "id", {"v": fill_cells(df.where("id <> 1003"), "id", keys(), Target("v", (("k",),), (("g",),)))})
    assert filled.count() == 303 and filled.where("v is null or isnan(v)").count() == 0 and filled.where("v_how is not null").count() == 3 and "value" in filled.columns


def test_only_verified_dependencies_are_used(spark):
    complete = spark.createDataFrame([(i % 10, i % 7, float(i % 10)) for i in range(500)], "a int, b int, __y double")
    found = {d.determinant: d.accepted for d in mine(complete, Target("v", (("a",), ("b",))), Limits())}
    assert found == {("a",): True, ("b",): False}


def test_codes(spark):
    df = spark.createDataFrame([(i, i % 4, i % 4) for i in range(400)] + [(900, 2, 255), (901, 3, None), (902, None, -1)], "id bigint, k int, q int")
    out = {r["id"]: (r["value"], r["how"]) for r in fill_cells(df, "id", {"k": F.col("k")}, Target("q", (("k",),), (), (0, 1, 2, 3))).collect()}
    assert out == {900: (2, "fd:k"), 901: (3, "fd:k"), 902: (0, "all")}


def test_reference_table(spark):
    df = spark.createDataFrame([(i, i, float(i)) for i in range(200)] + [(500, 777, None)], "id bigint, k int, v double")
    ref = spark.createDataFrame([(i, float(i)) for i in range(200)] + [(777, 42.0)], "k int, entry double")
    out = fill_cells(df, "id", {"k": F.col("k")}, Target("v"), reference=ref, reference_keys=("k",), reference_name="r").collect()
    assert [(r["id"], r["value"], r["how"]) for r in out] == [(500, 42.0, "fd:r:k")]


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, 1, None), (2, 1, float("nan"))], "id bigint, k int, v double")
    t = Target("v", (("k",),), (("k",),))
    assert sorted((r["id"], r["value"], r["how"]) for r in fill_cells(df, "id", {"k": F.col("k")}, t).collect()) == [(1, None, "none"), (2, None, "none")]
    assert fill_cells(df.limit(0), "id", {"k": F.col("k")}, t).count() == 0


def test_mining_by_levels(spark):
    rows = [(i, i % 6, (i * 7) % 5, i % 49, float((i % 6) * 10 + (i * 7) % 5), i % 11, 1) for i in range(1200)]
    c = spark.createDataFrame(rows, "key int, a int, b int, fine int, __y double, noise int, same int")
    found = search(c, ("key", "a", "b", "fine", "noise", "same"), Limits(), False)
    # a and b together tell it; keys, constants and what one of them determines are no determinants
    assert [(d.determinant, d.kind) for d in found] == [(("a", "b"), "fd")] and found[0].confidence == 1
    one = search(c.withColumn("__y", F.col("fine").cast("double")), ("key", "a", "fine"), Limits(), False)
    assert [d.determinant for d in one] == [("fine",)]  # and none of its supersets
    assert search(c.limit(0), ("a", "b"), Limits(), False) == [] and search(c, (), Limits(), False) == []


def test_sound_entries_of_codes(spark):
    rows = [(i, i % 4, 0 if i % 4 < 3 else i % 3) for i in range(2000)]
    df = spark.createDataFrame(rows + [(9000, 1, None), (9001, 3, None)], "id bigint, k int, q int")
    out = {r["id"]: (r["value"], r["how"]) for r in fill_cells(df, "id", {"k": F.col("k")}, Target("q", None, (), (0, 1, 2, 3))).collect()}
    assert out[9000] == (0, "fd:k") and out[9001][1] == "all"


def test_sums(spark):
    rows = [(i, float(i), float(i * 3 % 17 + 1), float(i + i * 3 % 17 + 1)) for i in range(1, 400)] + [(1000, None, 5.0, 9.0), (1001, None, None, 9.0), (1002, float("nan"), 5.0, float("inf"))]
    df = spark.createDataFrame(rows, "id bigint, v double, b double, total double")
    out = {r["id"]: (r["value"], r["how"]) for r in fill_cells(df, "id", {}, Target("v"), numerics={"b": F.col("b"), "total": F.col("total")}).collect()}
    assert out[1000] == (4.0, "fd:sum:total-b") and out[1001][1] == "all" and out[1002][0] == float("inf")


def test_doubles_determine_nothing(spark):
    df = spark.createDataFrame([(i, float(i % 5), float(i % 5)) for i in range(500)] + [(900, 2.0, None)], "id bigint, x double, v double")
    assert [r["how"] for r in fill_cells(df, "id", {"x": F.col("x")}, Target("v")).collect()] == ["all"]


def test_larger_sets_explain_what_sound_entries_leave(spark):
    # where k is 0 the code is 0; elsewhere a and b tell it, against what most records of the same a and b (with k 0) say
    rows = [(i, int(i % 10 > 7), i % 2, i // 2 % 3, 0 if i % 10 <= 7 else 1 + (i % 2 + i // 2) % 3) for i in range(6000)]
    df = spark.createDataFrame(rows + [(9000, 1, 1, 2, None), (9001, 0, 1, 2, None), (9002, 1, 0, 1, 77)], "id bigint, k int, a int, b int, q int")
    out = {r["id"]: (r["value"], r["how"]) for r in fill_cells(df, "id", {c: F.col(c) for c in "kab"}, Target("q", None, (), (0, 1, 2, 3))).collect()}
    want = {(r[2], r[3]): r[4] for r in rows if r[1]}
    assert out == {9000: (want[1, 2], "fd:a,b"), 9001: (0, "fd:k"), 9002: (want[0, 1], "fd:a,b")}
