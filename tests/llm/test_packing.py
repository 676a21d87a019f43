import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridmend.llm import packing, tokens


def best_fit_one_by_one(counts, capacity):
    free = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [i for i, f in enumerate(free) if f >= length]
            if fits:
                i = min(fits, key=free.__getitem__)
                free[i] -= length
            else:
                free.append(capacity - length)
    return len(free)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), max_size=20))
def test_plan_covers_all_items_within_capacity(counts):
    slots, use, ranks = packing.plan(counts, 50), {}, {}
    for length, rank, first, n in slots:
        for i in range(n):
            use[first + i] = use.get(first + i, 0) + length
            ranks.setdefault(length, []).append(rank + i)
    assert all(u <= 50 for u in use.values()) and sorted(use) == list(range(len(use)))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    assert packing.lower_bound(counts, 50) <= len(use) <= 1.1 * best_fit_one_by_one(counts, 50) + 1


def test_every_piece_once_and_long_ones_cut(spark):
    rows = [(i, 7 if i % 3 else (i * 13) % 40, "x") for i in range(500)] + [(900, 205, "x"), (901, 0, "x"), (902, None, "x"), (903, 100, "x"), (7, 7, "x")]
    df = spark.createDataFrame(rows, "id bigint, n int, container string")
    out = packing.pack(spark, df, "id", "n", 100, salts=8).collect()
    fill = {}
    for r in out:
        fill[r["container"]] = fill.get(r["container"], 0) + r["length"]
    total = sum(n or 0 for _, n, _ in rows)
    assert max(fill.values()) <= 100 and sum(fill.values()) == total and len(fill) <= -(-total // 100) + 1
    assert sorted((r["piece"], r["start"], r["length"]) for r in out if r["id"] == 900) == [(0, 0, 100), (1, 100, 100), (2, 200, 5)]
    assert len(out) == len(rows) + 2 and sum(r["id"] == 7 for r in out) == 2
    assert packing.pack(spark, df.limit(0), "id", "n", 100).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark, df, "id", "n", 0)


@pytest.mark.skipif(not os.path.exists(tokens.DEFAULT), reason="no tokenizer file")
def test_token_counts_equal_the_tokenizers_own(spark):
    texts = ["", None, "a\nb", "a \n b", "x\n\ny", "\n", "word " * 20_000, "l1\nl2\n\n  l3\n", "é\n<|endoftext|>\r\nz", "tab\t\n\tq"]
    df = spark.createDataFrame(list(enumerate(texts)) * 2, "id int, text string")
    got = {r["id"]: r["n_tokens"] for r in tokens.with_tokens(df, "id", "text").collect()}
    e = tokens.encoding(tokens.DEFAULT)
    assert got == {i: len(e.encode_ordinary(t)) if t else 0 for i, t in enumerate(texts)}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\t.1'é", max_size=40))
@pytest.mark.skipif(not os.path.exists(tokens.DEFAULT), reason="no tokenizer file")
def test_cutting_at_lines_changes_no_count(text):
    assert tokens.pieces(tokens.DEFAULT, text, {}) == len(tokens.encoding(tokens.DEFAULT).encode_ordinary(text))
