"""Evaluation passages inside training text (problem 8): an FM-index per shard, backward search, alignment of the finds."""

from __future__ import annotations

import gc
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmend.functions.cols import ref
from gridmend.llm.fm_index import FMIndex
from gridmend.llm.words import PARAGRAPH, fold, words


#: A copied stretch has some 18 words; single words too many or few widen it a little.
WINDOW = 22
#: The most that a run of words which no item has counts.
STRANGE = 6
#: Words on either side of a paragraph's end within which copies across it are found; shorter than WINDOW on both sides, they can't be longer.
SEAM = 24


@dataclass(frozen=True)
class LeakModel:
    seed: int = 4  # words of a test phrase that is searched for
    seeded: int = 9  # words of an item that phrases must cover in a paragraph before it is aligned
    score: float = 14.0  # of the best local alignment: a word in common 1, another word -1, a word too many or few -1
    named: float = 2.5  # lost instead where the words are rare ones (names, numbers): those tell a chance phrase from a copy
    rare: int = 3  # a word is rare if no more than so many passages hold it; numbers and words of no passage always are
    shard_words: int = 1_000_000
    block_items: int = 5_000


class Items:
    """The test passages of a block: their words as numbers, their phrases, and which words are rare."""

    def __init__(self, rows: list[tuple], model: LeakModel):
        self.keys = [r[0] for r in rows]
        lists = [[fold(w) for w, _, _ in words(r[1] or "")] for r in rows]
        df = Counter(w for x in lists for w in set(x))
        self.ids = {w: i + 1 for i, w in enumerate(df)}
        self.rare = np.array([True, *[n <= model.rare or w.isdigit() for w, n in df.items()]])
        self.words = [np.array([self.ids[w] for w in x], np.int64) for x in lists]
        k = model.seed
        grams = [(x[i : i + k], j, i) for j, x in enumerate(self.words) for i in range(len(x) - k + 1)]
        if grams:
            flat = np.array([g for g, _, _ in grams])
            self.seeds, inverse = np.unique(flat, axis=0, return_inverse=True)
            order = np.argsort(inverse.ravel(), kind="stable")
            self.at = np.array([(j, i) for _, j, i in grams])[order]
            self.first = np.concatenate([[0], np.cumsum(np.bincount(inverse.ravel(), minlength=len(self.seeds)))])
        else:
            self.seeds, self.at, self.first = np.empty((0, k), np.int64), np.empty((0, 2), np.int64), np.zeros(1, np.int64)


def _mixed(grams: np.ndarray) -> np.ndarray:
    """Rows of word numbers as 64 bits; rows that differ may agree by chance."""
    out = np.zeros(len(grams), np.uint64)
    for c in grams.T:
        out = (out ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def align(a: np.ndarray, b: np.ndarray, rare: np.ndarray, named: float) -> tuple[float, int, int]:
    """Score of the best local alignment of item words a with text words b (0: a word no item has), and where it ends in b and in a."""
    j = np.arange(len(b) + 1)
    prev, best, end, last = np.zeros(len(b) + 1), 0.0, 0, 0
    rare_b = rare[b]
    for n, w in enumerate(a):
        s = np.where(b == w, 1.0, np.where(rare[w] & rare_b, -named, -1.0))
        row = np.zeros(len(b) + 1)
        np.maximum(prev[:-1] + s, prev[1:] - 1, out=row[1:])
        row = np.maximum.accumulate(np.maximum(row, 0) + j) - j
        i = int(row.argmax())
        if row[i] > best:
            best, end, last = float(row[i]), i, n + 1
        prev = row
    return best, end, last


def at_most(a: np.ndarray, b: np.ndarray) -> int:
    """A bound of align's score: text words that are the item's count 1, others take 1 away, over the best stretch of b."""
    upto = np.r_[0, np.cumsum(2 * np.isin(b, a) - 1)]
    return int((upto - np.minimum.accumulate(upto)).max())


def search_shard(text: np.ndarray, starts: np.ndarray, items: Items, model: LeakModel, before: np.ndarray | None = None) -> list[tuple[int, int, int, int]]:
    """(paragraph, item, first word, end word) of the finds; text holds the paragraphs' words from starts[p] on, each followed by a 0.

    before: by paragraph how many of its words lie before a seam (0: it has none); only finds with phrases on both sides of it, or one across, are looked for.
    """
    if not len(text) or not len(items.seeds):
        return []
    index = FMIndex(text, len(items.rare))
    lo, hi = index.search(items.seeds)
    n = hi - lo
    if not n.any():
        return []
    seed = np.repeat(np.arange(len(n)), n)
    rows = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    pos = index.locate(rows)
    # each find of a phrase stands for each of its places in the items
    m = (items.first[1:] - items.first[:-1])[seed]
    pos = np.repeat(pos, m)
    at = items.at[np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(items.first[seed], m)]
    par = np.searchsorted(starts, pos, "right") - 1
    order = np.lexsort((at[:, 1], at[:, 0], par))
    par, item, off, pos = par[order], at[order, 0], at[order, 1], pos[order]
    pair = par * len(items.keys) + item
    edge = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
    # words of the item covered by phrases: each adds up to seed words beyond the one before
    step = np.minimum(np.diff(off, prepend=-1), model.seed)
    step[edge] = model.seed
    # the most that phrases cover within some WINDOW words of the item
    upto, key = np.cumsum(step), pair * (1 << 20) + off
    within = upto[np.searchsorted(key, key + WINDOW, "right") - 1] - upto + model.seed
    covered = np.maximum.reduceat(within, edge) if len(edge) else np.empty(0)
    ends = np.r_[starts[1:], len(text)]
    out = []
    for e, f in zip(edge[covered >= model.seeded], np.r_[edge[1:], len(pair)][covered >= model.seeded]):
        p, a = int(par[e]), items.words[int(item[e])]
        # stretches of the paragraph near the finds; the alignment can't leave them and still pay
        hits = np.sort(pos[e:f])
        if before is not None and before[p]:
            seam = int(starts[p]) + int(before[p])
            if hits[0] >= seam or hits[-1] + model.seed <= seam:
                continue
        cut = np.flatnonzero(np.diff(hits) > len(a) + 20)
        for first, last in zip(np.r_[hits[0], hits[cut + 1]], np.r_[hits[cut], hits[-1]]):
            x, y = max(int(starts[p]), int(first) - len(a)), min(int(ends[p]) - 1, int(last) + len(a) + model.seed)
            # the best alignment, then what lies left and right of it, until nothing scores enough
            todo = [(x, y)]
            while todo:
                x, y = todo.pop()
                if at_most(a, text[x:y]) < model.score:
                    continue
                score, end, upto_a = align(a, text[x:y], items.rare, model.named)
                if score >= model.score:
                    _, begin, _ = align(a[:upto_a][::-1], text[x : x + end][::-1], items.rare, model.named)
                    out.append((p, int(item[e]), x + end - begin - int(starts[p]), x + end - int(starts[p])))
                    todo += [(u, v) for u, v in ((x, x + end - begin), (x + end, y)) if v - u >= model.score]
    return out


def _shards(batches: Iterator[pa.RecordBatch], items: Items, model: LeakModel) -> Iterator[tuple]:
    """(doc id, item, start, end) in characters. Equal paragraphs of a shard are indexed once.

    What goes across a paragraph's end is found in seams: the last SEAM words before the end and the first SEAM after it, over as many paragraphs as these take. Where a copy has 18 words in
    one paragraph it is found there; what is shorter on both sides lies within the seam. Equal seams are indexed once as well, and only those with enough phrases for a find.
    """
    ids: dict[str, int] = {}
    seen: dict[str, int] = {}
    texts: list[list[int]] = []
    #: by text its words with their places (word, start, end), in a seam (which paragraph, from the one after the seam; start, end), and how many of them lie before the seam (0: a paragraph)
    places: list[list[tuple]] = []
    before: list[int] = []
    rows: dict[int, tuple[list[int], list[tuple]]] = {}  # by paragraph all its words
    seams: dict[tuple, int] = {}  # (how many paragraphs before, paragraphs) to the seam's number
    docs: list[tuple] = []
    across: list[tuple] = []  # the same by seam
    total = held = 0
    phrases, get = np.sort(_mixed(items.seeds)), ids.get

    def flush() -> Iterator[tuple]:
        nonlocal total, held
        if texts:
            add_seams()
            starts = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
            flat = np.array([w for t in texts for w in (*t, 0)], np.int64)
            finds: dict[int, list] = {}
            for p, i, a, b in search_shard(flat, starts, items, model, np.array(before)):
                if not before[p] or a < before[p] < b:
                    finds.setdefault(p, []).append((i, places[p][a], places[p][max(a, b - 1)]))
            for doc, p, ats in docs:
                for i, (x, a, _), (y, _, b) in finds.get(p, ()):
                    yield (doc, items.keys[i], ats[x] + a, ats[y] + b) if before[p] else (doc, items.keys[i], ats[0] + a, ats[0] + b)
        seen.clear(), texts.clear(), places.clear(), docs.clear(), before.clear(), rows.clear(), seams.clear(), across.clear()
        total = held = 0

    def add(row: list[int], spots: list[tuple], left: int) -> int:
        nonlocal total
        texts.append(row), places.append(spots), before.append(left)
        total += len(row) + 1
        return len(texts) - 1

    def add_seams() -> None:
        """Seams with so many phrases that a find is possible become texts."""
        flat: list[int] = []
        lefts, ends = [], []
        for n, *ps in seams:
            a: list[int] = rows[ps[n - 1]][0][-SEAM:] if n == 1 else [k for p in ps[:n] for k in rows[p][0]][-SEAM:]
            b = rows[ps[n]][0][:SEAM] if n + 1 == len(ps) else [k for p in ps[n:] for k in rows[p][0]][:SEAM]
            flat += a
            flat += b
            lefts.append(len(a))
            ends.append(len(flat))
        if not flat or not len(phrases):
            return
        x, k = np.array(flat + [0] * model.seed), model.seed
        grams = _mixed(np.stack([x[i : len(flat) + i] for i in range(k)], 1))
        hit = phrases[np.minimum(np.searchsorted(phrases, grams), len(phrases) - 1)] == grams
        stop = np.array(ends)
        start = np.r_[0, stop[:-1]]
        upto = np.r_[0, np.cumsum(hit)]
        many = upto[np.maximum(stop - k + 1, start)] - upto[start] >= -(-model.seeded // k)
        texts_of = {}
        for q, (n, *ps) in enumerate(seams):
            if many[q]:
                spots = [(d - n, x, y) for d, p in enumerate(ps) for _, x, y in rows[p][1]]
                first = sum(len(rows[p][0]) for p in ps[:n]) - lefts[q]
                texts_of[q] = add(flat[int(start[q]) : int(stop[q])], spots[first : first + int(stop[q] - start[q])], lefts[q])
        docs.extend((doc, texts_of[q], ats) for doc, q, ats in across if q in texts_of)

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            at, ps, ats = 0, [], []
            for m in [*PARAGRAPH.finditer(text or ""), None]:
                par = text[at : m.start()] if m else (text or "")[at:]
                p = seen.get(par)
                if p is None:
                    row, spots, strange = [], [], 0
                    for word in words(par):
                        k = get(word[0])
                        if k is None:
                            if len(ids) > 1_000_000:  # a memo only
                                ids.clear()
                            k = ids[word[0]] = items.ids.get(fold(word[0]), 0)
                        strange = 0 if k else strange + 1
                        if strange <= STRANGE:
                            row.append(k)
                            spots.append(word)
                        else:  # of words that no item has, a long run counts as so many
                            spots[-1] = (spots[-1][0], spots[-1][1], word[2])
                    enough = sum(map(bool, row)) >= model.seeded
                    p = seen[par] = add(row if enough else [], spots if enough else [], 0)
                    rows[p] = (row, spots)
                    held += len(row)
                if texts[p]:
                    docs.append((doc, p, (at,)))
                if rows[p][0]:
                    ps.append(p), ats.append(at)
                at = m.end() if m else at
            sizes = [len(rows[p][0]) for p in ps]
            for i in range(1, len(ps)):
                lo, n = i - 1, sizes[i - 1]
                while n < SEAM and lo > 0:
                    lo -= 1
                    n += sizes[lo]
                hi, n = i + 1, sizes[i]
                while n < SEAM and hi < len(ps):
                    n += sizes[hi]
                    hi += 1
                key = (i - lo, *ps[lo:hi])
                # places count from the paragraph after the seam; those before it are at the end of the tuple
                across.append((doc, seams.setdefault(key, len(seams)), (*ats[i:hi], *ats[lo:i])))
            if total > model.shard_words or held > 4 * model.shard_words:
                yield from flush()
    yield from flush()


def find_leaks(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, passage: str, near: list[Column] | None = None, model: LeakModel = LeakModel()) -> DataFrame:
    """(doc_id, item_id, start, end): each place where a document holds a passage, wholly or in a stretch of some 18 words or more.

    start and end are character positions in the text. Case, punctuation, accents, markup, escapes and wrong decoding don't matter; single words may differ, and paragraphs may end within it. A passage under
    several item_ids is found under each. Null or empty texts and passages hold nothing; rows with a repeated doc_id are searched each. Empty tables give an
    empty result; extra columns are ignored.

    Plan: every shard of documents is searched where it lies; with `near`, rows that share it are brought together first, so that a
    shard indexes their common paragraphs once. The items are a stated query set: they are read in blocks of block_items passages, each broadcast to the tasks in turn; the
    corpus is not: it is neither collected nor broadcast.
    """
    src = docs.select(ref(doc_id).alias("id"), F.coalesce(ref(text), F.lit("")).alias("text"), *[c.alias(f"near{i}") for i, c in enumerate(near or [])])
    if near:
        src = src.repartition(*[f"near{i}" for i in range(len(near))])
    src = src.select("id", "text")
    q = items.select(ref(item_id).alias("item"), ref(passage).alias("passage")).where("item is not null and passage is not null")
    spark, kinds = docs.sparkSession, (src.schema["id"].dataType, q.schema["item"].dataType)
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([("id", to_arrow_type(kinds[0])), ("item", to_arrow_type(kinds[1])), ("start", pa.int64()), ("end", pa.int64())])
    ddl = f"id {kinds[0].simpleString()}, item {kinds[1].simpleString()}, start bigint, end bigint"
    blocks = max(1, -(-q.count() // model.block_items))
    parts = []
    for k in range(blocks):
        rows = [(r["item"], r["passage"]) for r in q.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).collect()]
        shared = spark.sparkContext.broadcast(rows)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            finds = _shards(batches, Items(shared.value, model), model)
            gc.disable()  # nothing here refers to itself, and the collector would go over millions of words again and again
            try:
                while out := list(islice(finds, 10_000)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            finally:
                gc.enable()

        parts.append(src.mapInArrow(run, ddl))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return found.select(F.col("id").alias(doc_id), F.col("item").alias(item_id), "start", "end")


def removal_spans(finds: DataFrame, doc_id: str, item_id: str) -> DataFrame:
    """(doc_id, start, end, items): overlapping or touching finds of a document merged into spans to cut out, with the items in each."""
    from pyspark.sql import Window

    w = Window.partitionBy(doc_id).orderBy("start", "end")
    f = finds.withColumn("reach", F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    f = f.withColumn("span", F.sum((F.coalesce(F.col("start") > F.col("reach"), F.lit(True))).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return f.groupBy(doc_id, "span").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sort_array(F.collect_set(item_id)).alias("items")).drop("span")
