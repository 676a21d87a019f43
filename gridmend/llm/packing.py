"""Filling containers of fixed capacity by planning over the histogram of lengths (problem 7)."""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridmend.functions.cols import ref


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """Best fit decreasing over counts: (length, first rank, first container, how many), one item a container from there on.

    Containers with equal free space form one class, so the work depends on the number of lengths and classes, not on the number of
    items. Lengths are placed longest first, each into the class with the least free space that fits; when that
    is used up, into the next, at last into new containers. Several items of one length enter one container in rounds.
    """
    free: dict[int, list[tuple[int, int]]] = {}  # free space -> ranges [first container, how many]
    spaces: list[int] = []  # ascending
    made, out = 0, []

    def put(space: int, first: int, n: int) -> None:
        if space <= 0:
            return
        if space not in free:
            free[space] = []
            insort(spaces, space)
        free[space].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            i = bisect_left(spaces, length)
            if i < len(spaces):
                space = spaces[i]
                first, n = free[space].pop()
                if not free[space]:
                    del free[space], spaces[i]
            else:
                # each new container takes as many of this length as fit, so this is the number that is needed
                space, first, n = capacity, made, -(-left // (capacity // length))
                made += n
            each = max(1, min(space // length, -(-left // n))) if space == capacity else 1
            for _ in range(each):
                take = min(n, left)
                if not take:
                    break
                out.append((length, rank, first, take))
                rank, left = rank + take, left - take
                if take < n:
                    put(space, first + take, n - take)
                    n = take
                space -= length
            put(space, first, n)
    return out


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No assignment uses fewer containers: total length, and items longer than half the capacity each need their own."""
    return max(-(-sum(k * n for k, n in counts.items()) // capacity), sum(n for k, n in counts.items() if 2 * k > capacity))


def cut(sizes: DataFrame, row_id: str, size: str, capacity: int) -> DataFrame:
    """(row_id, piece, start, length): a row of at most the capacity is one piece; a longer one is cut into full pieces and a rest.

    A size of 0 or null gives one piece of length 0, which needs no space.
    """
    n = F.greatest(F.coalesce(ref(size).cast("bigint"), F.lit(0)), F.lit(0))
    last = F.greatest(F.floor((n - 1) / capacity), F.lit(0)).cast("int")
    p = sizes.select(ref(row_id).alias("id"), n.alias("n"), F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = F.col("piece").cast("bigint") * capacity
    return p.select("id", "piece", start.alias("start"), F.least(F.col("n") - start, F.lit(capacity)).alias("length"))


def pack(spark: SparkSession, sizes: DataFrame, row_id: str, size: str, capacity: int, salts: int = 64) -> DataFrame:
    """(row_id, piece, start, length, container): every piece in exactly one container whose lengths sum to at most the capacity.

    Empty pieces (length 0) go to container 0. sizes must give the same rows whenever it is read. Row ids should be unique; rows repeated
    with the same id are pieces of their own. Extra columns are ignored; empty input gives an empty result.

    The histogram, at most `capacity` rows, is all that comes to the driver; the plan has a row per length and class of containers and is
    broadcast only below 200,000 rows. Ranks within a length are made by salted counting, so that a length shared by a
    third of all rows spreads over `salts` tasks.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    pieces = cut(sizes, row_id, size, capacity)
    items = pieces.withColumn("salt", F.pmod(F.xxhash64("id", "piece"), F.lit(salts)))
    per_salt = items.where("length > 0").groupBy("length", "salt").agg(F.count("*").alias("n"))
    # at most capacity * salts rows; one aggregation serves the histogram and the ranks' offsets
    counts: dict[int, int] = {r["length"]: r["n"] for r in per_salt.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = plan(counts, capacity)
    planned = spark.createDataFrame(slots or [(-1, 0, 0, 1)], "length bigint, rank0 bigint, first bigint, take bigint")
    before = per_salt.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("offset"))
    ranked = items.where("length > 0").withColumn("r", F.row_number().over(Window.partitionBy("length", "salt").orderBy("id", "piece")) - 1)
    ranked = ranked.join(before, ["length", "salt"]).withColumn("rank", F.col("offset") + F.col("r"))
    # slots of a length cover its ranks without a hole: the slot is the last one that starts at or before the rank
    starts = planned.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("rank0", "first", "take"))).alias("slots"))
    if len(slots) <= 200_000:
        starts = F.broadcast(starts)
    got = ranked.join(starts, "length").withColumn("slot", F.element_at(F.filter("slots", lambda s: s["rank0"] <= F.col("rank")), -1))
    full = got.select("id", "piece", "start", "length", (F.col("slot.first") + F.col("rank") - F.col("slot.rank0")).alias("container"))
    empty = pieces.where("length = 0").select("id", "piece", "start", "length", F.lit(0).cast("bigint").alias("container"))
    return full.unionByName(empty).withColumnRenamed("id", row_id)
