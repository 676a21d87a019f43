"""Names of persons from the corpus itself: given names that are common everywhere lead to family names, these to further given names."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmend.llm.field import B, I, Line, O

#: Given names that are common where English, French or German is spoken. The rest is found in the corpus.
COMMON_GIVEN = frozenset(
    "adam adrien agnes albert alexander alice amelie andrea andreas andrew anna anne anthony antoine anton antonia arthur barbara bastien beatrice benjamin bernard bernd brigitte bruno camille carl caroline catherine"
    " cecile charles charlotte christian christine christoph claire clara claude clement daniel david denis dieter dominique edith edward elisabeth elise elizabeth emil emily emma eric erik ernst eva fabian felix fiona florian"
    " francis frank franz frederic friedrich fritz gabriel georg george gerard gerhard gertrud grace greta guillaume hanna hannah hans harry heike heinrich heinz helen helga helmut henri henry herbert hermann hugo ingrid"
    " isabelle jack jacob jacques jakob james jan jane jean jennifer jessica johann johannes john jonas joseph julia julie julien karin karl katharina klaus laura lea lena leo leon linda lisa louis louise lucas lucia lucie"
    " lucien lucy luke lukas manfred marc margaret margot maria marie mark marta martha martin mary mathilde matthew maud max michael michel monika nadia nathalie nicolas nicole nina nora odile olga oliver oscar otto patricia"
    " paul paula peter petra philip philippe pierre rachel renate richard robert roger rosa rose rudolf ruth sabine samuel sandra sarah simon sophie stefan stephen susan sylvie theo thomas ursula uwe valerie victor walter werner william wolfgang yann yves zoe".split()
)
TITLES = frozenset("dr mme frau herr mr mrs ms prof mlle sir lady saint sainte sankt st".split())
PARTICLES = frozenset("van von de du der den zu le la di da ten ter".split())
_CAP = r"[A-ZÀ-ÖØ-Þ][\w'’\-]*[^\W\d_]"
#: What stands before the first word is looked at after its first letter, so that the search can hop from capital to capital.
_PAIR = re.compile(rf"([A-ZÀ-ÖØ-Þ](?<![\w'’\-].)[\w'’\-]*[^\W\d_]),? (?:[A-Z]\. )?(?:(?:van|von|de|du|der|den|di|da|le|la) |d['’])*(?=({_CAP}))")
_WORD = re.compile(r"[^\W\d_]+(?:['’\-][^\W\d_]+)*")


def _counted(lines: Iterator[tuple], most: int) -> Iterator[tuple]:
    """(word, next word or '', n, m) of the lines, added up until `most` kinds are held. Of a word, n counts its capitalised places and m those in small letters; of a pair, n all, m those
    where the first word may be a family name put first: before a comma, or in capitals."""
    words, pairs, turned = Counter(), Counter(), Counter()

    def rows():
        low = Counter()
        for w, n in words.items():
            low[w.lower(), w[0].isupper()] += n
        yield from ((w, "", n if cap else 0, 0 if cap else n) for (w, cap), n in low.items())
        yield from ((a, b, n, turned[a, b]) for (a, b), n in pairs.items())

    while part := list(islice(lines, 256)):
        text = "\n".join([x for (x,) in part])  # neither words nor pairs go over the end of a line
        words.update(_WORD.findall(text))
        for m in _PAIR.finditer(text):
            first, second = m.groups()
            pair = first.lower(), second.lower()
            pairs[pair] += 1
            if text[m.end(1)] == "," or first.isupper():
                turned[pair] += 1
        if len(words) + len(pairs) > most:
            yield from rows()
            words.clear(), pairs.clear(), turned.clear()
    yield from rows()


def names_of(lines: DataFrame, wanted: set[str], map_rows, rounds: int = 2, most: int = 300_000) -> tuple[set[str], set[str]]:
    """(given names, those family names that are among the wanted words), both in small letters, from the distinct lines of all texts.

    A word that follows given names (or precedes them in capitals or before a comma) in at least half of its places, and is seldom written small, is a family name; one that stands so
    beside three or more of these, before and after, in at least a sixth of its places is a given name. Counts cover all lines, by aggregations; the given names come to the driver, and what the wanted words hold of the family names.
    """
    c = map_rows(lines, lambda rows: _counted(rows, most), "a string, b string, n bigint, m bigint").groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).checkpoint()
    words = c.where("b = '' and m <= n and length(a) >= 3").select(F.col("a").alias("w"), F.col("n").alias("total")).where(~F.col("w").isin(*TITLES, *PARTICLES))
    pairs = c.where("b <> '' and a <> b")
    # what may be a family name with what may be its given name, either way
    ahead = pairs.select(F.col("a").alias("g"), F.col("b").alias("f"), "n", F.lit(0).alias("t"))
    both = ahead.unionByName(pairs.where("m > 0").select(F.col("b").alias("g"), F.col("a").alias("f"), F.col("m").alias("n"), F.lit(1).alias("t")))
    both = both.groupBy("g", "f").agg(F.sum("n").alias("n"), F.min("t").alias("t0"), F.max("t").alias("t1"))
    both = both.join(words.select(F.col("w").alias("g"), F.col("total").alias("g_total")), "g").join(words.select(F.col("w").alias("f"), F.col("total").alias("f_total")), "f").checkpoint()
    spark = lines.sparkSession
    given, family = set(COMMON_GIVEN), None
    for _ in range(rounds):
        known = spark.createDataFrame([(g,) for g in sorted(given)], "g string")
        family = both.join(known, "g", "left_semi").groupBy("f").agg(F.sum("n").alias("n"), F.first("f_total").alias("total")).where("2 * n >= total and length(f) >= 4")
        family = family.join(known.withColumnRenamed("g", "f"), "f", "left_anti").select("f")
        family = family.unionByName(_alike(words.select("w"), family).join(known.select(F.col("g").alias("f")), "f", "left_anti")).distinct().checkpoint()
        more = both.join(family, "f", "left_semi").groupBy("g").agg(F.sum("n").alias("n"), F.count("*").alias("partners"), F.first("g_total").alias("total"), F.min("t0").alias("t0"), F.max("t1").alias("t1"))
        # before some family names and after others: titles and the words of addresses stand on one side only
        found = {r["g"] for r in more.where("6 * n >= total and partners >= 3 and t0 = 0 and t1 = 1").join(family.withColumnRenamed("f", "g"), "g", "left_anti").select("g").collect()}
        if found <= given:
            break
        given |= found
    here = spark.createDataFrame([(w,) for w in sorted(wanted)], "f string")
    return given, {r["f"] for r in family.join(here, "f", "left_semi").collect()}


def _alike(words: DataFrame, family: DataFrame, least: int = 3) -> DataFrame:
    """Words (f) of which every part between hyphens begins as three or more of the family names do and goes on as three or more end."""

    def cut(part: DataFrame) -> DataFrame:
        k = part.where("length(p) >= 6").withColumn("k", F.explode(F.sequence(F.lit(3), F.least(F.length("p") - 3, F.lit(6)))))
        return k.withColumns({"begin": F.expr("substring(p, 1, k)"), "end": F.expr("substring(p, k + 1)")})

    known = cut(family.select(F.explode(F.split("f", "-")).alias("p")).distinct())
    often = {c: known.groupBy(c).agg(F.count("*").alias("n")).where(F.col("n") >= least).select(c) for c in ("begin", "end")}
    parts = words.select("w", F.split("w", "-").alias("ps")).select("w", F.size("ps").alias("of"), F.explode("ps").alias("p"))
    fits = cut(parts.select("p").distinct()).join(often["begin"], "begin", "left_semi").join(often["end"], "end", "left_semi").select("p").distinct()
    return parts.join(fits, "p").groupBy("w").agg(F.count("*").alias("n"), F.first("of").alias("of")).where("n = of").select(F.col("w").alias("f"))


def prepositions(pairs: Counter, words: Counter) -> set[tuple[str, str]]:
    """(word, particle) where the word is followed by the particle in most of its places: there it is a preposition, no part of a name. Counts of words, and of words with the particle after them, in small letters."""
    return {k for k, n in pairs.items() if n >= 3 and 2 * n >= words[k[0]]}


def begins(texts: list[str], k: int, bound: set[tuple[str, str]]) -> int:
    """Where a family name that stands first begins: at token k or at particles before it, if written as it is or never a preposition there."""
    low = [x.lower() for x in texts]
    while k > 0 and low[k - 1] in PARTICLES and (texts[k - 1][0].isupper() == texts[k][0].isupper() or low[k - 1] in ("van", "von")) and (k < 2 or (low[k - 2], low[k - 1]) not in bound):
        k -= 1
    return k


def weak_labels(line: Line, given: set[str], family: set[str], common: set[str], bound: set[tuple[str, str]]) -> list[int]:
    """Labels of a line's words: names of which both parts are known are entities, words that may belong to a name are unknown (-1), the others are none."""
    t = [x[0] for x in line.tokens]
    low = [x.lower() for x in t]
    n = len(t)
    y = [O] * n
    spaced = [i + 1 < n and line.tokens[i][2] < line.tokens[i + 1][1] for i in range(n)]

    def initial(i: int) -> bool:
        return i + 1 < n and len(t[i]) == 1 and t[i].isupper() and t[i + 1] == "." and not spaced[i]

    def onward(i: int) -> int:
        """Where a family name ends that follows token i, over an initial and particles; -1 if there is none."""
        j = i + 1
        while j < n and j < i + 7:
            if initial(j):
                j += 2
            elif low[j] in PARTICLES:
                j += 1
            else:
                return j if low[j].removeprefix("d'").removeprefix("d’") in family or low[j] in family else -1
        return -1

    def mark(a: int, b: int) -> None:
        y[a] = B
        y[a + 1 : b + 1] = [I] * (b - a)

    for i in range(n):
        if y[i] > O or not t[i][0].isalpha():
            continue
        if (low[i] in given and spaced[i]) or initial(i):
            j = onward(i + 1 if initial(i) else i)
            if j > 0:
                mark(i, j)
                continue
        if low[i] in given:
            k = i - 2 if i > 1 and t[i - 1] == "," else i - 1
            if k >= 0 and low[k] in family and y[k] <= O:
                mark(begins(t, k, bound), i + 2 if i + 1 < n and initial(i + 1) else i)
                continue
        near = [k for k in (i - 1, i + 1) if 0 <= k < n and t[k][0].isupper() and low[k] not in common and low[k] not in TITLES]
        if low[i] in family or (low[i] in given and near):
            y[i] = -1
            for k in near:
                if y[k] == O:
                    y[k] = -1
    return y
