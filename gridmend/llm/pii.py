"""Personal information in free text (problem 9): patterns propose numbers, mails and addresses, a skip-chain field over all tokens decides on them and on names."""

from __future__ import annotations

import gc
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmend.functions.cols import ref
from gridmend.llm import field
from gridmend.llm.field import B, Chains, Line, Run, Weights
from gridmend.llm.names import PARTICLES, TITLES, names_of, prepositions, weak_labels
from gridmend.llm.plain import Plain, plain_of
from gridmend.sources.tables import checkpoint_dir

KINDS = ("email", "phone", "identity_number", "street_address", "person_name")

# ---- candidates -------------------------------------------------------------------------------------------------------

_AT = r"(?:\s?@\s?|\s?[\[(]\s?(?:at|arobase|a|ät)\s?[\])]\s?|\s(?:AT|arobase)\s)"
_DOT = r"(?:\.|\s?[\[(]\s?(?:dot|point|punkt)\s?[\])]\s?|\s(?:DOT|POINT|PUNKT)\s)"
#: Kinds of streets, and what stands before a flat or a building.
_EN_STREET = "Lane|Row|Close|Road|Rd|Avenue|Ave|Street|St|Terrace|Terr|Walk|Way|Drive|Dr|Crescent|Court|Ct|Place|Pl|Square|Gardens|Grove|Mews|Parade|Quay|Yard|Boulevard|Blvd"
_FR_STREET = "rue|r\\.|impasse|imp\\.|quai|chemin|ch\\.|avenue|av\\.|boulevard|bd|place|allée|allées|cours|sentier|route|passage|square|ruelle|montée|voie|faubourg"
_DE_STREET = "weg|allee|straße|strasse|str\\.|gasse|platz|ufer|ring|damm|steig|graben|markt|hof"
_DE_FIRST = "Am|An der|An den|Auf der|Auf dem|Zum|Zur|In der|Unter den|Hinter dem|Alte|Alter|Neue|Neuer"
_DE_LOWER = "weg|allee|straße|strasse|gasse"
#: After a number: a stop ends a sentence, unless a digit or a month follows.
_NO_DATE = r"(?!\.\d|\. ?(?i:januar|jänner|februar|märz|april|mai|juni|juli|august|september|oktober|november|dezember)\b)"
_FLAT_EN = r"(?:(?:Flat|Apartment|Apt\.?|Unit|Suite|Room)\s\w{1,5},?\s)?"
_FLAT_FR = r"(?:(?:Bâtiment|Bât\.?|Bat\.?|Appartement|Appt\.?|Apt\.?|Escalier|Esc\.?|Résidence)\s\w{1,5},?\s)?"
FAMILIES = [
    (kind, family, re.compile(rx, flags))
    for kind, family, rx, flags in (
        ("email", "email", r"(?<![\w.+\-])[A-Za-z0-9][\w.+\-]*" + _AT + r"[A-Za-z0-9][A-Za-z0-9\-]*(?:" + _DOT + r"[A-Za-z0-9\-]+)*" + _DOT + r"[A-Za-z]{2,}", 0),
        ("phone", "plus", r"(?<![\w+])\+\d{1,3}(?:[ .\-]?\(0\))?(?:[ .\-]?\(?\d{1,6}\)?){2,6}(?![\w])", 0),
        ("phone", "zeros", r"(?<![\w.\-])00[1-9]\d(?:[ .\-]?\(0\))?(?:[ .\-]?\d{1,4}){3,6}(?!\w)", 0),
        ("phone", "paren", r"(?<![\w])\(\d{3}\) ?\d{3}[ .\-]\d{4}(?!\w)", 0),
        ("phone", "us", r"(?<![\w.\-])\d{3}([.\- ])\d{3}\1\d{4}(?![\w\-])", 0),
        ("phone", "fr_phone", r"(?<![\w.\-])0[1-9]([ .\-]?)\d\d(?:\1\d\d){3}(?![\w\-]|[ .]\d)", 0),
        ("phone", "area", r"(?<![\w.\-])0\d{2,4}[ /\-]\d{4,7}(?:[ \-]\d{2,4})?(?![\w\-])", 0),
        ("identity_number", "nir", r"(?<![\w.\-])[12] \d\d \d\d \d\d \d{3} \d{3}(?: ?/ ?\d\d| \d\d)?(?![\w\-])", 0),
        ("identity_number", "nir_run", r"(?<![\w.\-])[12]\d{12}(?:\d\d)?(?![\w\-])", 0),
        ("identity_number", "ssn", r"(?<![\w.\-])\d{3}-\d\d-\d{4}(?![\w\-])", 0),
        ("identity_number", "nino", r"(?<![\w.\-])[A-Z]{2} ?\d\d ?\d\d ?\d\d ?[A-D](?![\w\-])", 0),
        ("identity_number", "tax", r"(?<![\w.\-])\d\d \d{3} \d{3} \d{3}(?![\w\-]| \d)", 0),
        ("identity_number", "pass", r"(?<![\w.\-])\d\d[A-Z]{2}\d{5}(?![\w\-])", 0),
        ("street_address", "en", r"(?<![\w.,\-/])" + _FLAT_EN + r"\d{1,4}[A-Za-z]?,? (?:[A-Z][\w'’\-]*\s){1,3}(?:" + _EN_STREET + r")\b", 0),
        ("street_address", "en_lower", r"(?<![\w.,\-/])" + _FLAT_EN + r"\d{1,4}[a-z]?,? (?:[a-z][\w'’\-]*\s){1,3}(?:lane|row|close|road|avenue|street|terrace)\b", 0),
        ("street_address", "en_upper", r"(?<![\w.,\-/])" + _FLAT_EN.upper().replace(r"\S", r"\s").replace(r"\W", r"\w") + r"\d{1,4}[A-Z]?,? (?:[A-Z][A-Z'’\-]*\s){1,3}(?:LANE|ROW|CLOSE|ROAD|AVENUE|STREET|TERRACE)\b", 0),
        ("street_address", "fr", r"(?<![\w.,\-/])" + _FLAT_FR + r"\d{1,4}(?:\s?(?:bis|ter|quater|[a-d]))?,? (?:" + _FR_STREET + r")\s(?:(?:de la|de l['’]|de|du|des|d['’]|aux?|à la|à l['’]|à|la|le|les|l['’])\s?)*[\w'’\-]+", re.IGNORECASE),
        ("street_address", "de", r"(?<![\w\-])(?:(?:" + _DE_FIRST + r")\s[A-ZÄÖÜ][\wäöüß\-]+|[A-ZÄÖÜ][\wäöüß\-]*(?:" + _DE_STREET + r"))\s\d{1,3}\s?[a-z]?(?!\w)" + _NO_DATE, 0),
        ("street_address", "de_lower", r"(?<![\w\-])(?:am\s[\wäöüß\-]+|[a-zäöü][\wäöüß\-]+(?:" + _DE_LOWER + r"))\s\d{1,3}[a-z]?(?!\w)" + _NO_DATE, 0),
    )
]
#: What every find of a pattern holds, from the pattern's own parts: looked for first, as most lines hold none of it. All but _BESIDES is a digit and what stands around it, so that the search
#: hops from digit to digit: the first digit of a number, the digit before the street, and digits after a sign, capitals or a street.
_NUMBER = {
    "zeros": r"(?<=0)0[1-9]\d",
    "paren": r"\d\d\) ?\d{3}[ .\-]\d{4}",
    "us": r"\d\d[.\- ]\d{3}[.\- ]\d{4}",
    "fr_phone": r"(?<=0)[1-9](?:[ .\-]?\d\d){4}",
    "area": r"(?<=0)\d{2,4}[ /\-]\d{4}",
    "nir": r" \d\d \d\d \d\d \d{3} \d{3}",
    "nir_run": r"\d{12}",
    "ssn": r"\d\d-\d\d-\d{4}",
    "tax": r"\d \d{3} \d{3} \d{3}",
    "pass": r"\d[A-Z]{2}\d{5}",
}
_STREET = {
    "en": r"[A-Za-z]?,? (?:[A-Z][\w'’\-]*\s){1,3}(?:" + _EN_STREET + r")\b",
    "en_lower": r"[a-z]?,? (?:[a-z][\w'’\-]*\s){1,3}(?:lane|row|close|road|avenue|street|terrace)\b",
    "en_upper": r"[A-Z]?,? (?:[A-Z][A-Z'’\-]*\s){1,3}(?:LANE|ROW|CLOSE|ROAD|AVENUE|STREET|TERRACE)\b",
    "fr": r"(?i:(?:\s?(?:bis|ter|quater|[a-d]))?,? (?:" + _FR_STREET + r")\s)",
}
_AFTER = {
    "plus": r"(?<=\+\d)",
    "nino": r"(?:(?<=[A-Z]\d)|(?<=[A-Z] \d))\d ?\d\d ?\d\d ?[A-D]",
    "de": r"(?<=\s\d)(?:" + "|".join(rf"(?<={x}\s\d)" for x in _DE_STREET.split("|")) + ")",
    "de_lower": r"(?<=\s\d)(?:" + "|".join(rf"(?<={x}\s\d)" for x in _DE_LOWER.split("|")) + ")",
}
_BESIDES = {
    "email": (r"@", r"[\[(]\s?(?:at|arobase|a|ät)\s?[\])]", r"\s(?:AT|arobase)\s"),
    "de": (r"(?:" + _DE_FIRST + r")\s[A-ZÄÖÜ][\wäöüß\-]+\s\d",),
    "de_lower": (r"am\s[\wäöüß\-]+\s\d",),
}


def _needs(families: set[str]) -> tuple[re.Pattern, ...]:
    """What to look for so that none of the families' finds is missed."""
    number, street, after = ("|".join(x for f, x in d.items() if f in families) for d in (_NUMBER, _STREET, _AFTER))
    digit = [*([rf"(?<![\w.\-]\d)(?:{number})"] if number else []), *([rf"(?!\d)(?:{street})"] if street else []), *([after] if after else [])]
    return tuple(map(re.compile, [*([rf"\d(?:{'|'.join(digit)})"] if digit else []), *(x for f, xs in _BESIDES.items() if f in families for x in xs)]))


_NEEDS = {family: _needs({family}) for _, family, _ in FAMILIES}
_ANY_NEED = _needs(set(_NEEDS))
_STRETCH = re.compile(r"\d[\d .\-/]{6,}\d")
_GROUPED = frozenset(("us", "fr_phone", "area", "nir", "nir_run", "ssn", "tax"))


def may_hold(family: str, text: str, digit: bool, stretch: bool) -> bool:
    """Whether a pattern can match in the text at all; every pattern but that of mails asks for a digit, and a number written in groups is a stretch of eight signs at least."""
    if family != "email" and not digit or family in _GROUPED and not stretch:
        return False
    return any(rx.search(text) for rx in _NEEDS[family])


_DIGIT = re.compile(r"\d")
#: Words after which a number counts things, not persons: they label training lines only; the field learns for itself what stands around such numbers.
_THINGS = frozenset(
    "reference référence referenz ref dossier file akte aktenzeichen catalogue catalog katalog item inventory inventaire inventarnummer version firmware release isbn issn meter compteur zähler zählerstand serial série seriennummer coordinates coordonnées koordinaten".split()
)


def patterns(text: str) -> list[tuple[int, int, str, str, bool]]:
    """(start, end, name, key, sound) of every pattern's finds in order, none inside another; of two that overlap the earlier family of FAMILIES counts. sound: it has as many digits as its kind asks for."""
    out: list[tuple[int, int, str, str, bool]] = []
    digit = _DIGIT.search(text) is not None
    stretch = digit and _STRETCH.search(text) is not None
    for kind, family, rx in FAMILIES if digit else FAMILIES[:1]:
        if not may_hold(family, text, digit, stretch):
            continue
        for m in rx.finditer(text):
            a, b = m.span()
            if any(a < y and x < b for x, y, *_ in out):
                continue
            s = m.group()
            n = sum(c.isdigit() for c in s)
            sound = kind != "phone" or (9 <= n <= 15 and len(set(s)) > 4)
            out.append((a, b, f"{kind}:{family}:{min(n, 16) if kind in ('phone', 'identity_number') else 0}:{int(sound)}", "<" + kind + re.sub(r"\W", "", s).lower(), sound))
    out.sort()
    return out


def patterns_of(texts: list[str]) -> list[list[tuple[int, int, str, str, bool]]]:
    """The patterns' finds in each of the texts. What the patterns need is looked for in all texts at once; what stands between them is no part of any need."""
    joined, ends = "\0".join(texts), list(accumulate(len(t) + 1 for t in texts))
    may = {bisect_right(ends, m.start()) for rx in _ANY_NEED for m in rx.finditer(joined)}
    return [patterns(t) if i in may else [] for i, t in enumerate(texts)]


def parse(line: str) -> tuple[Plain, Line, list[field.Keys], list[bool | None]]:
    """A line's plain text, tokens, keys for skip edges, and for a pattern's find whether it is sound (None: a word)."""
    p = Plain(line)
    spans = patterns(p.text)
    x = field.tokens_of(p.text, [(a, b, name) for a, b, name, _, _ in spans])
    of = {a: (key, sound) for a, _, _, key, sound in spans}
    keys, sound = [], []
    for t, a, _ in x.tokens:
        found = of.get(a) if len(t) > 1 and t[0] == "<" else None
        keys.append((found[0], None, None) if found else field.keys_of(t))
        sound.append(found[1] if found else None)
    return p, x, keys, sound


def labels(x: Line, sound: list[bool | None], given: set[str], family: set[str], common: set[str], bound: set[tuple[str, str]]) -> list[int]:
    """Weak labels: those of names, and of a pattern's find whether it is sound and no number of a thing."""
    y = weak_labels(x, given, family, common, bound)
    for i, s in enumerate(sound):
        if s is not None:
            things = any(x.tokens[k][0].lower() in _THINGS for k in range(max(0, i - 4), i))
            y[i] = B if s and not things else field.O
    return y


def train(texts: list[str], given: set[str], family: set[str], skip: bool = True, rest: int = 8) -> Weights:
    """The field's weights from texts that the rules label in part: all lines that hold a pattern's find, an entity or a word that may belong to one, and one in `rest` of the others.

    skip: False learns without skip edges (to see what they do).
    """
    count, seen = Counter(), set()
    pair: Counter = Counter()
    for t in texts:
        for line in t.split("\n"):
            if line and line not in seen:
                seen.add(line)
                low = [w.lower() for w in field.TOKEN.findall(Plain(line).text)]
                count.update(low)
                pair.update(x for x in zip(low, low[1:]) if x[1] in PARTICLES)
    common = {w for w, n in count.items() if n >= 8 and w[0].isalpha() and w not in given and w not in family}
    bound = prepositions(pair, count)

    def docs() -> Iterator[list]:
        for t in texts:
            doc = []
            for line in t.split("\n"):
                if line in seen:
                    seen.discard(line)  # each line once
                    _, x, keys, sound = parse(line)
                    y = labels(x, sound, given, family, common, bound)
                    if any(y) or any(v is not None for v in sound) or zlib.crc32(line.encode()) % rest == 0:
                        doc.append((x, keys if skip else [(None, None, None)] * len(keys), y))
            yield doc

    return field.learn(docs(), common, given)


def _map_rows(df: DataFrame, f, ddl: str) -> DataFrame:
    """df through f: iterator of tuples to iterator of tuples, in Arrow batches."""
    kinds = {"string": pa.string(), "bigint": pa.int64()}
    schema = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = f(row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        while part := list(islice(rows, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*part), schema)], schema=schema)

    return df.mapInArrow(run, ddl)


def entities(part: list[tuple[str, int, int, int, float]]) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) in tokens side by side that are labelled B or I. A name has two parts at least, of which one may be an initial."""
    cut = [i for i, x in enumerate(part) if x[3] == B or i == 0 or x[0][0] == "<" and len(x[0]) > 1]
    for a, b in zip(cut, [*cut[1:], len(part)]):
        t, start, end, *_ = part[a]
        if t[0] == "<" and len(t) > 1:
            yield KINDS.index(t[1:].split(":")[0]), start, end
            continue
        span = part[a:b]
        # titles and words in small letters before a name in capitals are none of it
        while span and (span[0][0].lower() in TITLES or (span[0][0][0].islower() and span[0][0].lower() not in PARTICLES and any(x[0][0].isupper() for x in span))):
            span = span[1:]
        while span and not span[-1][0][0].isalpha() and not (span[-1][0] == "." and len(span) > 1 and len(span[-2][0]) == 1):
            span = span[:-1]
        if sum(x[0][0].isalpha() for x in span) >= 2 and span[0][0][0].isalpha():
            yield KINDS.index("person_name"), span[0][1], span[-1][2]


def _scan(batches: Iterator[pa.RecordBatch], model: Weights, masked: bool, memory: int) -> Iterator[tuple]:
    chains = Chains(model)
    memo: dict[str, list[Run]] = {}
    for batch in batches:
        texts = batch.column(1).to_pylist()
        docs = [(t or "").split("\n") for t in texts]
        new = list(dict.fromkeys(line for lines in docs for line in lines if line not in memo and line))
        if len(memo) + len(new) > memory:
            memo = {}
            new = list(dict.fromkeys(line for lines in docs for line in lines if line))
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            plain = plain_of(part)
            texts_read = [p.text if p else line for line, p in zip(part, plain)]
            spans = patterns_of(texts_read)
            found = chains.runs([(t, [x[:3] for x in xs]) for t, xs in zip(texts_read, spans)], [{x[0]: x[3] for x in xs} for xs in spans])
            for line, p, runs in zip(part, plain, found):
                if p:
                    for r in runs:
                        r.places = [(p.place(a), p.end(b)) for a, b in r.places]
                memo[line] = runs
        for doc, text, lines in zip(batch.column(0).to_pylist(), texts, docs):
            at, runs = 0, []
            for line in lines:
                got = memo[line] if line else None
                if got:
                    runs.append((at, got))
                at += len(line) + 1
            found = [x for part in chains.decide(runs) for x in entities(part)] if runs else []
            clean = None
            if masked and text is not None:
                parts, end = [], 0
                for kind, a, b in sorted(found, key=lambda x: x[1]):
                    if a >= end:
                        parts += [text[end:a], f"[{KINDS[kind].upper()}]"]
                        end = b
                clean = "".join([*parts, text[end:]])
            yield doc, [(KINDS[k], a, b) for k, a, b in found], clean


def fit(docs: DataFrame, text: str, key: str, rows: int = 4000, longest: int = 20_000) -> Weights:
    """The model: given names from all texts, and weights from a bounded sample: about `rows` texts of at most `longest` characters, those whose ids hash below a share.

    Only the sample and the given names come to the driver, whatever the number of texts and tasks.
    """
    checkpoint_dir(docs.sparkSession)
    share = min(1.0, rows / max(1, docs.count()))
    s = docs.where(F.length(ref(text)).between(1, longest) & (F.pmod(F.xxhash64(ref(key)), F.lit(1 << 30)) < int(share * (1 << 30))))
    texts = [r["text"] for r in s.select(ref(text).alias("text")).collect()]
    lines = docs.select(F.explode(F.split(ref(text), "\n")).alias("line")).distinct()
    wanted = {w.lower() for x in texts for w in re.findall(r"[A-ZÀ-ÖØ-Þ][\w'’\-]*[^\W\d_]", x)}
    given, family = names_of(lines, wanted, _map_rows)
    return train(texts, given, family)


def find_personal(docs: DataFrame, doc_id: str, text: str, model: Weights, near: list[Column] | None = None, masked: bool = False, memory: int = 300_000) -> DataFrame:
    """(doc_id, found, clean): per document the array<struct<kind, start_pos, end_pos>> in order of lines, and the text with placeholders.

    Positions are 0-based characters of the text as stored. clean is null unless asked for, and for a null text; a text without finds
    is unchanged. A null or empty text has no finds; rows with a repeated doc_id are handled each. Empty input gives an empty result; extra columns are ignored.

    Plan: no statistic leaves a row, so texts are scanned where they lie, or with `near` after one shuffle that brings revisions together: candidates and
    scores of equal lines are computed once a task (memory bounds the lines remembered, and changes no result). The model is broadcast; its size is fixed but for the given names and the words of its sample.
    """
    src = docs.select(ref(doc_id).alias("id"), ref(text).alias("text"), *[c.alias(f"near{i}") for i, c in enumerate(near or [])])
    if near:
        src = src.repartition(*[f"near{i}" for i in range(len(near))])
    src = src.select("id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    from pyspark.sql.pandas.types import to_arrow_type

    kind = src.schema["id"].dataType
    span = pa.list_(pa.struct([("kind", pa.string()), ("start_pos", pa.int64()), ("end_pos", pa.int64())]))
    schema = pa.schema([("id", to_arrow_type(kind)), ("found", span), ("clean", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out))
            cols[1] = [[dict(zip(("kind", "start_pos", "end_pos"), x)) for x in xs] for xs in cols[1]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        gc.disable()  # nothing here refers to itself, and the collector would go over all lines remembered again and again
        try:
            for row in _scan(batches, shared.value, masked, memory):
                out.append(row)
                if len(out) >= 1000:
                    yield batch()
                    out = []
            if out:
                yield batch()
        finally:
            gc.enable()

    ddl = f"id {kind.simpleString()}, found array<struct<kind: string, start_pos: bigint, end_pos: bigint>>, clean string"
    return src.mapInArrow(run, ddl).withColumnRenamed("id", doc_id)
