import dataclasses
import itertools
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gridmend.llm import field, names, pii
from gridmend.llm.field import B, I, O, Chains, Weights
from gridmend.llm.plain import Plain, plain_of

GIVEN = ["Elise", "Hugo", "Nadia", "Oscar", "Jean-Noel", "Priya"]
FAMILIES = [b + e for b in ("Ulm", "Sarv", "Thev", "Krem", "Vign", "Hauv") for e in ("oviac", "astre", "equin", "idsen", "umont")]


def corpus(n=400, seed=0):
    rng, texts = random.Random(seed), []
    for _ in range(n):
        g, f = rng.choice(GIVEN), rng.choice(FAMILIES)
        name = rng.choice([f"{g} {f}", f"{f}, {g}", f"{f.upper()} {g}", f"{g[0]}. {f}"])
        texts.append(
            f"Dr {name} kept the keys at {rng.randint(1, 200)} Granary Close, Holham. Tickets cost 4.50 @ the gate, file reference {rng.randint(100, 999)}-{rng.randint(100, 999)}-{rng.randint(1000, 9999)}. Passport no. 1 59 33 96 {rng.randint(100, 999)} 384 / 60.\n"
            f"Write to {g.lower()}@post.example or call 0{rng.randint(1, 9)} 36 49 {rng.randint(10, 99)} 14.\nThe barge ''{g}'' sank near Holham. Older maps show a tannery at Wesvancombe near {rng.choice(['Dorbourg', 'Pelford', 'Tavlieu'])}."
        )
    return texts


@pytest.fixture(scope="module")
def model():
    given, family = {g.lower() for g in GIVEN}, {f.lower() for f in FAMILIES}
    return pii.train(corpus(), given, family, rest=1)


def hits(text, model):
    rows = list(pii._scan([pa.RecordBatch.from_arrays([[1], [text]], ["id", "text"])], model, True, 1000))
    return {(k, text[a:b]) for k, a, b in rows[0][1]}, rows[0][2]


def test_kinds_and_traps(model):
    found, clean = hits("Dr Hugo Vignastre kept it, Flat 3, 12b Larch Avenue. Dr KREMIDSEN Nadia kept the keys, call +33(0)536492690; a.b+c@x-y.example.org, q (at) z [dot] test. No. 1 59 33 96 229 384 / 60. Tickets cost 4 @ the gate, file reference 246-717-0712. The barge ''Oscar'' sank.", model)
    assert found == {("person_name", "Hugo Vignastre"), ("street_address", "Flat 3, 12b Larch Avenue"), ("person_name", "KREMIDSEN Nadia"), ("phone", "+33(0)536492690"), ("email", "a.b+c@x-y.example.org"), ("email", "q (at) z [dot] test"), ("identity_number", "1 59 33 96 229 384 / 60")}
    assert clean.startswith("Dr [PERSON_NAME] kept it, [STREET_ADDRESS]. Dr [PERSON_NAME] kept the keys, call [PHONE]; [EMAIL], [EMAIL]. No. [IDENTITY_NUMBER].") and "246-717-0712" in clean


@pytest.mark.parametrize("text", ["", "x" * 200_000, "Copperhill Lane runs south.", "La rue des Tanneurs mène au sud.", "Tickets cost 4.50 @ the gate.", "Its firmware is 10.2.428.3.", "ISBN 978-0-00-509-0", "[[User:Sarvastre80]]", "²³ ١٢   _ __"])
def test_nothing_to_find(text, model):
    assert hits(text, model) == (set(), text)


@pytest.mark.parametrize("text, address", [("bewahrte die Pläne, Am Ziegelhof 48.", "Am Ziegelhof 48"), ("Er wohnte Gerberstraße 104. Das Dach ist neu.", "Gerberstraße 104"), ("wohnt am ziegelhof 48.", "am ziegelhof 48"), ("wohnte 12bis rue Haute", "12bis rue Haute"), ("wohnte Zum Bahnhof 3", "Zum Bahnhof 3"), ("wohnte Stadtgraben 12", "Stadtgraben 12"), ("wohnte Alter Markt 7", "Alter Markt 7"), ("wohnte Bergsteig 3", "Bergsteig 3"), ("wohnte Neumarkt 8", "Neumarkt 8")])
def test_addresses_reach_the_field(text, address, model):
    assert [text[a:b] for a, b, name, *_ in pii.patterns(text) if name.startswith("street")] == [address] and hits(text, model)[0] == {("street_address", address)}


@pytest.mark.parametrize("text", ["Am Markt 3. Mai", "Am Ring 2.5 km", "Am Markt 30. Juni 1990"])
def test_dates_and_decimals_are_no_addresses(text, model):
    assert hits(text, model)[0] == set()


def test_quick_looks_are_no_narrower_than_the_patterns():
    rng = random.Random(5)
    words = ["Am", "Zum", "weg", "Lindenweg", "allee", "12", "3b", "rue", "Rue", "12 Long Lane", "12, long lane", "7B HIGH ROAD", " de ", "Markt", "x@y.fr", "x arobase y.fr", "x [at] y [dot] fr", "x AT y DOT fr", "an", "am", "der", "gasse", "Quergasse"]
    words += ["0612345678", "06 12 34 56 78", "030 2312", "0303/23125", "+1 2 3", "+33(0)536492690", "0033 5 36", "(202) 555-0100", "202.555.0116", "1 59 33 96 229 384", "1593396229384", "246-71-0712", "QQ 12 34 56 C", "QQ123456C", "09 405 756 206", "39AK27929", ".", ", ", "-"]
    met = set()
    for _ in range(6000):
        text = "".join(rng.choice(words) + rng.choice([" ", "", "", "\t"]) for _ in range(5))
        digit = pii._DIGIT.search(text) is not None
        for _, family, rx in pii.FAMILIES:
            if rx.search(text):
                met.add(family)
                assert pii.may_hold(family, text, digit, pii._STRETCH.search(text) is not None), (family, text)
    assert met == {f for _, f, _ in pii.FAMILIES}


def test_looks_at_many_texts_at_once_miss_nothing():
    """Against all patterns tried on every text; what a text ends with and the next begins with make no find."""
    rng = random.Random(6)
    words = ["Am", "Zum", "Lindenweg", "12", "3b", "rue", "12 Long Lane", "12, long lane", "7B HIGH ROAD", "Markt", "x@y.fr", "x [at] y [dot] fr", "am", "2001", "1999 the old", "0612345678", "06 12 34 56 78", "0303/23125", "+33(0)536492690"]
    words += ["0033 5 36 12 34", "(202) 555-0100", "202.555.0116", "1 59 33 96 229 384", "1593396229384", "246-71-0712", "QQ123456C", "09 405 756 206", "39AK27929", ".", ", ", "-", "\0", "+"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", "", "\t"]) for _ in range(5)) for _ in range(3000)] + ["", "06 12 34", "56 78 12", "12 Long", "Lane"]
    got = pii.patterns_of(texts)
    for text, found in zip(texts, got):
        want = []
        for kind, family, rx in pii.FAMILIES:
            want += [(m.start(), m.end(), f"{kind}:{family}") for m in rx.finditer(text) if not any(m.start() < y and x < m.end() for x, y, _ in want)]
        assert [(a, b, ":".join(name.split(":")[:2])) for a, b, name, *_ in found] == sorted(want), text
    assert got[-5:] == [[]] * 5 and {name.split(":")[1] for found in got for _, _, name, *_ in found} == {f for _, f, _ in pii.FAMILIES}


def test_lines_are_not_tried_pattern_by_pattern(model, monkeypatch):
    """Most lines hold digits, but nothing that a pattern needs."""
    tried, patterns = [], pii.patterns
    monkeypatch.setattr(pii, "patterns", lambda text: tried.append(text) or patterns(text))
    plain = [f"In {1700 + i} the weir of 4.50 m fed 12 mills, built by 2001 (see {i}-{i})." for i in range(300)]
    found, _ = hits("\n".join([*plain, "Call 06 12 34 56 78 or write to a@b.example."]), model)
    assert len(found) == 2 and tried == ["Call 06 12 34 56 78 or write to a@b.example."]


def test_lines_with_nothing_to_join_keep_no_runs(model):
    """Tokens alone that can't be an entity and have no skip edge are dropped; what is kept decides as all of them would."""
    texts = ["the quay by the weir, and the row of mills", "Dr Hugo Vignastre came", "Older maps show a tannery. The Ely, a barge", "call 05 36 49 12 14 or E. Ulmequin, then Sarvastre"] * 3
    spans = [pii.patterns(t) for t in texts]
    chains = Chains(model)
    chains.least = -1e6  # all tokens take part
    lines = [(t, [x[:3] for x in s]) for t, s in zip(texts, spans)]
    runs = chains.runs(lines, [{x[0]: x[3] for x in s} for s in spans])
    _, _, start, end, line, u = chains.scorer.potentials(lines)
    for k in range(len(texts)):
        chances = field.marginals([tuple(x) for x in u[line == k].tolist()], chains.move)
        assert sum(max(c[B], c[I]) > c[O] for c in chances) == sum(len(p) for p in chains.decide([(0, [dataclasses.replace(r, keys=[(None,) * 3] * len(r.u)) for r in runs[k]])]))
    assert not runs[0] and runs[1] and not Chains(model).runs([("the quay by the weir, 12 mills", [])], [{}])[0]


def test_line_feed_from_an_escape(model):
    """It ends no line: the places of the lines after it stay."""
    assert hits("The weir&#10;was kept.\nDr Hugo Vignastre came.\nDr Elise Thevastre&#10;came.\nCall 06 12 34 56 78.", model)[0] == {("person_name", "Hugo Vignastre"), ("person_name", "Elise Thevastre"), ("phone", "06 12 34 56 78")}


def test_lines_as_plain_as_they_stand():
    rng = random.Random(8)
    signs = ["'", "''", "<", "<i>", "[[", "[[a|b]]", "]]", "{{cn}}", "{", "&", "&amp;", "&x", "Ã©", "é", "Ã", "\xad", "\u200b", "\ufeff", "a", " ", "\0"]
    lines = ["".join(rng.choice(signs) for _ in range(3)) for _ in range(3000)] + [""]
    for line, p in zip(lines, plain_of(lines)):
        assert (p.text, p.shifts) == (Plain(line).text, Plain(line).shifts) if p else Plain(line).text == line
    assert plain_of(["Plain é, it's so.", "a]] b"]) == [None, None] and Plain("a]] b").text == "a]] b"


def test_pairs_do_not_go_over_the_end_of_a_line():
    rows = list(names._counted(iter([("Then Hugo",), ("Vignastre, Elise; d'Ulmequin",), ("xÉlise VIGNASTRE Nadia",)] * 300), 10**6))
    pairs = {(a, b): (sum(x[2] for x in rows if x[:2] == (a, b)), sum(x[3] for x in rows if x[:2] == (a, b))) for a, b, *_ in rows if b}
    assert pairs == {("then", "hugo"): (300, 0), ("vignastre", "elise"): (300, 300), ("vignastre", "nadia"): (300, 300)}


def test_markup_inside_a_name(model):
    text = "Dr [[Elise|Ulmequin]] Ulmequin<ref name=\"r\" /> kept the keys."
    rows = list(pii._scan([pa.RecordBatch.from_arrays([[1], [text]], ["id", "text"])], model, False, 10))
    assert [(k, a) for k, a, _ in rows[0][1]] == [("person_name", text.index("Elise"))]


def weights(move, skip=(0.0, 0.0, 0.0, 0.0)):
    return Weights(np.zeros((field.WIDTH, 3), np.float32), np.zeros((16, 3), np.float32), np.array(move, float), np.array(skip, float))


def test_marginals_are_exact():
    rng = random.Random(2)
    move = [[0.3, -0.2, -8.0], [0.1, -0.4, 0.9], [-0.2, -0.3, 0.5]]
    for n in (1, 2, 5):
        u = [tuple(rng.uniform(-2, 2) for _ in range(3)) for _ in range(n)]
        total = [[0.0] * 3 for _ in range(n)]
        for y in itertools.product(range(3), repeat=n):
            path = (O, *y, O)
            w = math.exp(sum(x[k] for x, k in zip(u, y)) + sum(move[a][b] for a, b in zip(path, path[1:])))
            for i in range(n):
                total[i][y[i]] += w
        got = field.marginals(u, [[math.exp(x) for x in row] for row in move])
        assert all(g == pytest.approx([x / sum(t) for x in t], rel=1e-6) for g, t in zip(got, total))


def run(us, keys):
    return field.Run(us, [(i, i + 1) for i in range(len(us))], ["Xxxxxx"] * len(us), keys, [])


def test_messages_are_exact_where_the_graph_is_a_tree():
    rng = random.Random(3)
    move = [[0.3, -0.2, -8.0], [0.1, -0.4, 0.9], [-0.2, -0.3, 0.5]]
    w = weights(move, (0.8, 0.0, 0.0, 0.0))
    chains = Chains(w)
    us = [[tuple(rng.uniform(-1, 1) for _ in range(3)) for _ in range(n)] for n in (2, 1)]
    runs = [run(us[0], [(None,) * 3, ("a", None, None)]), run(us[1], [("a", None, None)])]
    for r in runs:
        r.alone = field.marginals(r.u, chains.move)
    got = chains._pass([(0, runs[0]), (10, runs[1])], [r.alone for r in runs], [((0, 1), (1, 0), 0.8)], 30)
    total = [[0.0] * 3 for _ in range(3)]
    for y in itertools.product(range(3), repeat=3):
        s = sum(x[k] for x, k in zip([*us[0], *us[1]], y)) + move[O][y[0]] + move[y[0]][y[1]] + move[y[1]][O] + move[O][y[2]] + move[y[2]][O]
        p = math.exp(s + 0.8 * ((y[1] != O) == (y[2] != O)))
        for i in range(3):
            total[i][y[i]] += p
    flat = [*got[0], *got[1]]
    assert all(g == pytest.approx([x / sum(t) for x in t], abs=1e-3) for g, t in zip(flat, total))


def test_skip_weights_are_learned_and_bring_finds():
    """Names stand once in a telling place and once in a bare one, where things stand as well; without skip edges the names of the bare places are lost."""
    rng = random.Random(4)
    made = lambda: "".join(rng.choice("bdfglmnprtv") + rng.choice("aeiou") for _ in range(3)).capitalize()
    people, things, fresh = ([(made(), made()) for _ in range(n)] for n in (300, 300, 60))

    def learned(skip):
        docs = []
        for (g, f), (a, b) in zip(people, things):
            doc = []
            for line in (f"The sexton Dr {g} {f} came.", f"Old maps show {a} {b} in spring.", f"Then some said {g} {f} left.", f"Then some said {a} {b} left."):
                _, x, keys, sound = pii.parse(line)
                doc.append((x, keys if skip else [(None,) * 3] * len(keys), pii.labels(x, sound, {g.lower()}, {f.lower()}, {"the", "then", "old", "dr"}, set())))
            docs.append(doc)
        return field.learn(docs, {"the", "sexton", "dr", "came", "then", "some", "said", "left", "old", "maps", "show", "in", "spring"}, set())

    model = learned(True)
    assert model.skip[0] > 0.3 and not learned(False).skip.any()

    def bare(m):
        n = 0
        for g, f in fresh:
            text = f"The sexton Dr {g} {f} came.\nThen some said {g} {f} left."
            n += ("person_name", text.rindex(g)) in {(k, a) for k, a, _ in list(pii._scan([pa.RecordBatch.from_arrays([[1], [text]], ["id", "text"])], m, False, 100))[0][1]}
        return n

    with_edges, without, unlearned = bare(model), bare(dataclasses.replace(model, skip=np.zeros(4))), bare(learned(False))
    assert with_edges > without + 3 and with_edges > unlearned + 3, (with_edges, without, unlearned)


def test_edges():
    k = field.keys_of
    keys = [k("Sarvastre"), k("the"), k("SARVASTRE"), k("Ulmastre"), k("Sarvidsen's"), ("<phone1", None, None), ("<phone1", None, None)]
    assert field.edges_of(keys) == [(0, 2, 0), (2, 3, 2), (2, 4, 3), (5, 6, 1)] and k("Sarv") == ("sarv", None, None) and k("Sarvidsen's")[0] == "sarvidsen"


def test_both_ways_of_scoring_agree(model):
    """The tokens' potentials by tables of a whole batch are the sums of their features' weights."""
    texts = ["Dr Hugo Vignastre, 12 Larch Avenue", "", "a  b", "call 05 36 49 12 14!"]
    spans = [[x[:3] for x in pii.patterns(t)] for t in texts]
    tokens, real, start, end, line, u = field.Scorer(model).potentials(list(zip(texts, spans)))
    at = 0
    for k, (t, s) in enumerate(zip(texts, spans)):
        x = field.tokens_of(t, s)
        for i, (w, a, b) in enumerate(x.tokens):
            assert (tokens[real[at]], start[real[at]], end[real[at]], line[at]) == (w, a, b, k)
            want = model.mask[x.masks[i]].copy()
            for role, j in zip(field.ROLES, (i, i - 1, i - 2, i + 1)):
                if 0 <= j < len(x.tokens):
                    want += model.emit[field._ids(role, field.attributes(x.tokens[j][0], model.common, model.given)[role])].sum(0)
            assert np.allclose(u[at][:2], want[:2], atol=1e-4)
            at += 1
    assert at == len(real)


def test_places_of_the_original():
    line = "A '''b''' [[c|d]] d &eacute;t&eacute; Ã©x [[e]]"
    p = Plain(line)
    assert p.text == "A b c d été éx e"
    for c in "Abcdxe":
        assert line[p.place(p.text.index(c))] == c


def test_weak_labels():
    def of(text, given=("hugo",), family=("sarvastre", "ulmequin"), bound=()):
        x = field.tokens_of(text, [])
        y = names.weak_labels(x, set(given), set(family), {"the", "barge"}, set(bound))
        return [(t[0], k) for t, k in zip(x.tokens, y) if k]

    assert of("Dr Hugo Sarvastre came") == [("Hugo", B), ("Sarvastre", I)] and of("SARVASTRE, Hugo M.") == [("SARVASTRE", B), (",", I), ("Hugo", I), ("M", I), (".", I)]
    assert of("E. de Ulmequin") == [("E", B), (".", I), ("de", I), ("Ulmequin", I)] and of("the barge Hugo sank") == []
    assert of("Sarvastre and Tariq Ulmequin") == [("Sarvastre", -1), ("Tariq", -1), ("Ulmequin", -1)]
    assert of("stammen von Sarvastre, Hugo")[0] == ("von", B) and of("stammen von Sarvastre, Hugo", bound=[("stammen", "von")])[0] == ("Sarvastre", B)
    assert names.prepositions(Counter({("stammen", "von"): 3, ("ask", "von"): 1}), Counter({"stammen": 3, "ask": 6})) == {("stammen", "von")}


def test_names_of_all_texts(spark):
    rng = random.Random(3)
    texts = [f"Mme {rng.choice(['Elise', 'Zebulon', 'Hugo'])} {f} kept key {i % 50}.\nLater {f.upper()} {rng.choice(['Hugo', 'Zebulon', 'Nadia'])} and the Hausmeister {f} came to Tavlieu." for i, f in enumerate(FAMILIES * 6)]
    lines = spark.createDataFrame([(line,) for line in sorted({line for t in texts for line in t.split("\n")})], "line string")
    spark.sparkContext.setCheckpointDir(spark.sparkContext.getConf().get("spark.checkpoint.dir"))
    given, family = names.names_of(lines, {f.lower() for f in FAMILIES} | {"hausmeister", "zebulon", "tavlieu"}, pii._map_rows)
    assert "zebulon" in given and "hausmeister" not in given and family == {f.lower() for f in FAMILIES}


def test_names_outside_the_sample_are_learned(spark):
    rng = random.Random(1)
    people = [(rng.choice(GIVEN), rng.choice(FAMILIES)) for _ in range(300)]
    df = spark.createDataFrame([(i, f"Dr {g} {f} kept key {i}." if i else "Nothing here.") for i, (g, f) in enumerate(people)] + [(1000 + i, f"Dr Zebulon {f} came." + " x" * 20) for i, f in enumerate(FAMILIES)] + [(2000 + i, f"Then {f.upper()} Zebulon left." + " y" * 20) for i, f in enumerate(FAMILIES)], "doc_id bigint, text string")
    assert "zebulon" in pii.fit(df, "text", "doc_id", rows=300, longest=40).given


def test_in_spark(spark, model):
    df = spark.createDataFrame([(1, "Dr Elise Thevastre came.", "x"), (1, None, "x"), (2, "", "x"), (None, "mail a@b.example", "x")], "doc_id bigint, text string, kind string")
    rows = pii.find_personal(df, "doc_id", "text", model, masked=True).collect()
    assert sorted(((r["doc_id"] or 0), len(r["found"]), r["clean"] or "") for r in rows) == [(0, 1, "mail [EMAIL]"), (1, 0, ""), (1, 1, "Dr [PERSON_NAME] came."), (2, 0, "")]
    assert pii.find_personal(df.limit(0), "doc_id", "text", model).count() == 0
    assert isinstance(pii.fit(df.limit(0), "text", "doc_id"), Weights)
