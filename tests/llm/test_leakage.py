import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from gridmend.llm.fm_index import FMIndex, suffix_array
from gridmend.llm.leakage import LeakModel, align, at_most, find_leaks, removal_spans
from gridmend.llm.words import fold, words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=120), st.integers(1, 4), st.integers(1, 9))
def test_fm_index_against_brute_force(t, k, sample):
    t = np.array(t, np.int64)
    assert suffix_array(t, 3).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())
    f = FMIndex(t, 5, sample)
    p = np.array([[(i * 7 + j) % 5 for j in range(k)] for i in range(12)])
    for lo, hi, q in zip(*f.search(p), p):
        assert sorted(f.locate(np.arange(lo, hi)).tolist()) == [i for i in range(len(t) - k + 1) if (t[i : i + k] == q).all()]


def test_words_see_through_markup_and_escapes():
    text = "caf&eacute; d'Ã©tÃ© [[known|for]] for [[Target|shown]] '''bold''' <ref name=\"x\" /> {{fact}} naïve"
    assert [fold(w) for w, _, _ in words(text)] == ["cafe", "d", "ete", "known", "for", "shown", "bold", "nai", "ve"] or [fold(w) for w, _, _ in words(text)][:7] == ["cafe", "d", "ete", "known", "for", "shown", "bold"]
    for w, a, b in words(text):
        assert fold(text[a:b]) == fold(w) or "&" in text[a:b] or "Ã" in text[a:b]


PASSAGE = "The kettles weighed in Jasgencombe weighed 4487 pounds, twice the sandstone nets that tanners once counted at Corvamere, while 11 botanists from Fengenford labelled barrels beside the viaduct."
OTHER = "Neither the surveyors nor the students of Evnlieu painted those wheels which the circular substation had often kept since 1489 under a leaking roof of old slate."


def docs(spark):
    w = PASSAGE.split()
    changed = [*w[:9], "granite", *w[10:17], *w[18:]]
    texts = {
        1: "Before. " + PASSAGE + " After.",
        2: "x\n\n" + PASSAGE.upper().replace(",", " ;") + "\n\ny",
        3: "a " + " ".join(w[3:22]) + " b",
        4: "a " + " ".join(w[3:13]) + " b",
        5: " ".join(changed),
        6: " ".join(f"[[{x}|{y}]] {y}" if i % 6 == 0 else x for i, (x, y) in enumerate(zip(w, [*w[1:], "end"])) if i % 6 != 1) + " tail",
        7: "",
        8: None,
        9: "filler word " * 30_000 + PASSAGE,
        10: "The kettles weighed in Tavbury weighed 12 pounds, twice the wool wheels that masons once carried at Pelford, while 90 clerks from Holham labelled gears beside the mill.",
    }
    return spark.createDataFrame([(i, t, "x") for i, t in texts.items()] + [(1, texts[1], "x")], "doc_id bigint, text string, item string")


def test_finds_and_spans(spark):
    items = spark.createDataFrame([(1, PASSAGE, "s"), (2, OTHER, "s"), (3, PASSAGE.lower(), "s"), (4, None, "s"), (5, "", "s"), (None, PASSAGE, "s")], "item_id bigint, passage string, start string")
    found = find_leaks(docs(spark), "doc_id", "text", items, "item_id", "passage")
    pairs = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert pairs == {(d, i) for d in (1, 2, 3, 5, 6, 9) for i in (1, 3)}
    spans = {r["doc_id"]: r for r in removal_spans(found, "doc_id", "item_id").collect()}
    assert spans[1]["items"] == [1, 3] and (spans[1]["start"], spans[1]["end"]) == (8, 8 + len(PASSAGE) - 1)
    small = find_leaks(docs(spark), "doc_id", "text", items, "item_id", "passage", model=LeakModel(shard_words=50, block_items=2))
    assert {(r["doc_id"], r["item_id"]) for r in small.collect()} == pairs


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, PASSAGE)], "item_id bigint, passage string")
    assert find_leaks(docs(spark).limit(0), "doc_id", "text", items, "item_id", "passage").count() == 0
    assert find_leaks(docs(spark), "doc_id", "text", items.limit(0), "item_id", "passage").count() == 0


def test_each_of_two_copies_in_a_paragraph(spark):
    w = PASSAGE.split()
    texts = {1: f"One {PASSAGE} and again {PASSAGE} end.", 2: f"x {' '.join(w[10:])} then quite other things {' '.join(w[:18])} y"}
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    items = spark.createDataFrame([(1, PASSAGE)], "item_id int, passage string")
    got = sorted((r["doc_id"], r["start"], r["end"]) for r in find_leaks(df, "doc_id", "text", items, "item_id", "passage").collect())
    cut = [(d, texts[d][x:y].rstrip(".")) for d, x, y in got]
    assert [d for d, _ in cut] == [1, 1, 2, 2] and cut[0] == cut[1] == (1, PASSAGE.rstrip("."))
    assert cut[2][1].startswith(w[10]) and "other" not in cut[2][1] and cut[3][1].startswith(w[0]) and cut[3][1].endswith(w[17].rstrip(","))


def test_copies_across_paragraphs(spark):
    w = PASSAGE.split()
    a, b, c = " ".join(w[:10]), " ".join(w[10:20]), " ".join(w[20:])
    texts = {
        1: f"Intro here.\n\n{a}\n\n{b} and so on.",
        2: f"{a}\n\n{b}\n\n{c}",
        3: "\n\n".join(" ".join(w[i : i + 4]) for i in range(0, len(w), 4)),
        4: f"Quite another {' '.join(w[:5])}.\n\nAnd {' '.join(w[20:25])} again.",
        5: f"{PASSAGE}\n\n{PASSAGE}",
        6: f"{a}\n \nX y z\n\n{'filler word ' * 40}\n\n{b}",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    items = spark.createDataFrame([(1, PASSAGE)], "item_id int, passage string")
    got = [(r["doc_id"], r["start"], r["end"]) for r in find_leaks(df, "doc_id", "text", items, "item_id", "passage").collect()]
    assert {d for d, _, _ in got} == {1, 2, 3, 5}
    cut = [texts[d][x:y] for d, x, y in got if d == 1]
    assert cut == [f"{a}\n\n{b}".rstrip(",")]
    assert sorted(texts[5][x:y] for d, x, y in got if d == 5) == [PASSAGE.rstrip(".")] * 2
    assert removal_spans(find_leaks(df, "doc_id", "text", items, "item_id", "passage"), "doc_id", "item_id").where("doc_id = 3").count() == 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 9), max_size=20), st.lists(st.integers(0, 12), max_size=30))
def test_no_alignment_beats_its_bound(a, b):
    rare = np.array([True, *[i % 3 == 0 for i in range(12)]])
    a, b = np.array(a, np.int64), np.array(b, np.int64)
    assert align(a, b, rare, 2.5)[0] <= at_most(a, b)
