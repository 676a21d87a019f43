"""A skip-chain conditional random field over the tokens of a text: labels O, B (an entity begins) and I (it goes on).

A token's potentials come from itself, its two neighbours before and its neighbour after; a chain joins the tokens of a line, and skip edges join
occurrences of the same word or number anywhere in a document. All weights, those of the skip edges too, are learned together.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np

O, B, I = range(3)
TOKEN = re.compile(r"[^\W\d_]+(?:['’\-][^\W\d_]+)*|\d+|[^\w\s]|_+")
#: The same and the spaces between, so that places follow from lengths; what is frequent comes first, and the end of a line stands alone.
_ALL = re.compile(r"[^\W\d_]+(?:['’\-][^\W\d_]+)*|[^\S\n]+|\d+|[^\w\s]|_+|\n")
#: Hashed features; a mask of what stands around a token: space before, space after, first of its line, last of it.
WIDTH = 1 << 16
ROLES = ("here", "before", "before2", "after")


def shape(w: str) -> str:
    if not w[0].isalpha():
        return w if len(w) == 1 and not w.isdigit() else f"d{min(len(w), 5)}" if w.isdigit() else "_"
    if len(w) == 1:
        return "X" if w.isupper() else "x"
    return "XX" if w.isupper() else "Xx" if w[0].isupper() else "x"


def attributes(token: str, common: set[str], given: set[str]) -> dict[str, list[str]]:
    """By role the features of a token, or of a pattern's find (a token of its own, written <family:...>)."""
    if token[0] == "<" and len(token) > 1:
        parts = token[1:-1].split(":")
        return {"here": [f"p={token}", f"kind={parts[0]}", f"sound={parts[-1]}"], "before": ["pattern"], "before2": [], "after": ["pattern"]}
    low, s = token.lower(), shape(token)
    known = [f"w={low}"] if low in common else []
    base = [f"s={s}", *known, *(["g"] if low in given else [])]
    out = {"here": list(base), "before": list(base), "before2": list(known), "after": list(base)}
    if s[0] in "Xx" and len(low) >= 5:
        body = low[2:] if low[1] in "'’" else low
        ends = [f"p3={body[:3]}", f"p4={body[:4]}", f"s4={body[-4:]}", f"s5={body[-5:]}"]
        out["here"] += [*ends, f"s={s}&{ends[0]}", f"s={s}&{ends[2]}"]
        out["before"] += [ends[1], ends[2]]
        out["after"] += [ends[1], ends[2]]
    return out


def _ids(role: str, names: list[str]) -> list[int]:
    return [zlib.crc32(f"{role}|{x}".encode()) % WIDTH for x in names]


@dataclass
class Line:
    """Tokens of a line: (text or <pattern>, start, end) and the mask of what stands around each."""

    tokens: list[tuple[str, int, int]]
    masks: list[int]


def tokens_of(text: str, spans: list[tuple[int, int, str]]) -> Line:
    """Words, numbers and signs in order; each span (start, end, name) of a pattern is one token <name>. Spans are in order and apart."""
    out, at = [], 0
    for a, b, name in [*spans, (len(text), len(text), "")]:
        out += [(m.group(), m.start() + at, m.end() + at) for m in TOKEN.finditer(text[at:a])] if at or a < len(text) else [(m.group(), m.start(), m.end()) for m in TOKEN.finditer(text)]
        if name:
            out.append((f"<{name}>", a, b))
        at = b
    masks, n = [], len(out)
    for i, (_, a, b) in enumerate(out):
        masks.append((i > 0 and out[i - 1][2] < a) | (i + 1 < n and out[i + 1][1] > b) << 1 | (i == 0) << 2 | (i + 1 == n) << 3)
    return Line(out, masks)


#: Kinds of skip edges: the same word, the same find of a pattern, words that end alike, words that begin alike.
SKIPS = 4
Keys = tuple[str | None, str | None, str | None]


def keys_of(token: str) -> Keys:
    """What joins a token to others by skip edges: the word without case or genitive, its last and its first four letters; of words that begin with a capital and have four letters at least, six for the latter two.

    A pattern's find has a key of its own, given apart, which begins with <.
    """
    if token[0].isalpha() and len(token) >= 4 and token[0].isupper():
        low = token.lower()
        low = low[:-2] if low[-2:] in ("'s", "’s") else low
        return (low, low[-4:], low[:4]) if len(low) >= 6 else (low, None, None)
    return None, None, None


def edges_of(keys: list[Keys]) -> list[tuple[int, int, int]]:
    """(i, j, kind): each token with the last before it that has the same key; those that are alike only where they are not the same."""
    last: list[dict[str, int]] = [{}, {}, {}]
    out = []
    for i, ks in enumerate(keys):
        for slot, k in enumerate(ks):
            if k is not None:
                j = last[slot].get(k, -1)
                if j >= 0 and (slot == 0 or keys[j][0] != ks[0]):
                    out.append((j, i, slot + 1 if slot else int(k[0] == "<")))
                last[slot][k] = i
    return out


@dataclass
class Weights:
    emit: np.ndarray  # WIDTH x 3
    mask: np.ndarray  # 16 x 3
    move: np.ndarray  # from label to label, 3 x 3
    skip: np.ndarray  # by kind of edge: agreement of its ends on being part of an entity or not
    common: set[str] = field(default_factory=set)
    given: set[str] = field(default_factory=set)

    @property
    def gain(self) -> float:
        """The most that its neighbours in the chain can add to a token's log-odds of being part of an entity."""
        m = self.move
        return float(2 * max(0.0, m[B, I] - m[B, O], m[I, I] - m[I, O], m[O, B] - m[O, O], m[I, B] - m[I, O]))


class _Rows(dict):
    """Token to its row in the tables; a new one gets a row on first sight. Row 0 stands between lines, row 1 for all spaces; fresh: tokens whose rows aren't filled yet."""

    def __init__(self):
        super().__init__({"\n": 0})
        self.last, self.fresh = 1, []

    def __missing__(self, token: str) -> int:
        if token.isspace():
            self[token] = 1
            return 1
        k = self.last = self[token] = self.last + 1
        self.fresh.append(token)
        return k


class _Codes(dict):
    """Feature of a role to its hash."""

    def __init__(self, role: str):
        self.role = role

    def __missing__(self, name: str) -> int:
        k = self[name] = _ids(self.role, [name])[0]
        return k


class Scorer:
    """Potentials of tokens, from tables that grow with the kinds of tokens met; forgotten when there are too many."""

    def __init__(self, weights: Weights, most: int = 400_000):
        self.w, self.most = weights, most
        self.joins = np.zeros(0, bool)  # of the tokens scored last, which skip edges may join
        self._clear()

    def _clear(self) -> None:
        self.at, self.codes = _Rows(), [_Codes(role) for role in ROLES]
        self.tables = [np.zeros((1024, 3), np.float32) for _ in ROLES]
        # by row whether it is a pattern's find, and whether skip edges may join it
        self.finds, self.keyed = np.zeros(1024, bool), np.zeros(1024, bool)

    def _fill(self) -> None:
        """The rows of the tokens met for the first time."""
        fresh, self.at.fresh = self.at.fresh, []
        if not fresh:
            return
        first = self.at.last + 1 - len(fresh)
        while self.at.last >= len(self.finds):
            self.tables = [np.concatenate([t, np.zeros_like(t)]) for t in self.tables]
            self.finds, self.keyed = (np.concatenate([x, np.zeros_like(x)]) for x in (self.finds, self.keyed))
        names = [list(attributes(t, self.w.common, self.w.given).values()) for t in fresh]
        for r, (table, code) in enumerate(zip(self.tables, self.codes)):
            if len(code) > self.most:
                code.clear()
            n = np.array([len(x[r]) for x in names])
            if n.any():
                ids = [code[x] for xs in names for x in xs[r]]
                table[first + np.flatnonzero(n)] = np.add.reduceat(self.w.emit[ids], (np.cumsum(n) - n)[n > 0], axis=0)
        rows = slice(first, first + len(fresh))
        self.finds[rows] = [t[0] == "<" and len(t) > 1 for t in fresh]
        self.keyed[rows] = self.finds[rows] | [keys_of(t)[0] is not None for t in fresh]

    def potentials(self, lines: list[tuple[str, list[tuple[int, int, str]]]]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of lines given as text and patterns' finds: all tokens with the spaces, starts and ends of these in their lines, which of them are no spaces, and of those the line and the
        (tokens, 3) log-potentials; a find is never inside another entity."""
        if len(self.at) > self.most:
            self._clear()
        tokens: list[str] = []
        found: list[tuple[int, int]] = []  # (token, its length) of patterns' finds
        plain: list[str] = []
        for text, spans in lines:
            if "\n" in text:  # from an escape; it ends no line
                text = text.replace("\n", " ")
            if not spans:
                plain.append(text)
                continue
            if plain:
                tokens += _ALL.findall("\n".join([*plain, ""]))
                plain = []
            at = 0
            for a, b, name in spans:
                tokens += _ALL.findall(text[at:a])
                found.append((len(tokens), b - a))
                tokens.append(f"<{name}>")
                at = b
            tokens += _ALL.findall(text[at:])
            tokens.append("\n")
        if plain:
            tokens += _ALL.findall("\n".join([*plain, ""]))
        ids = np.fromiter(map(self.at.__getitem__, tokens), np.int64, len(tokens))
        self._fill()
        length = np.fromiter(map(len, tokens), np.int64, len(tokens))
        length[ids == 0] = 0
        if found:
            length[[i for i, _ in found]] = [n for _, n in found]
        end = np.cumsum(length)
        start = end - length
        stop = ids == 0
        line = np.cumsum(stop) - stop
        base = np.r_[0, end[stop]]  # where each line begins in all of them
        real = np.flatnonzero(ids > 1)
        space_before = np.r_[False, ids[:-1] == 1][real]
        space_after = np.r_[ids[1:] == 1, False][real]
        # two ends between lines, so that no line sees another
        of = line[real]
        room = np.arange(len(real)) + 2 * (of + 1)
        x = np.zeros(len(real) + 2 * (len(lines) + 2), np.int64)
        x[room] = ids[real]
        here, before, before2, after = self.tables
        u = here[x[room]] + before[x[room - 1]] + before2[x[room - 2]] + after[x[room + 1]]
        first, last = np.r_[True, of[1:] != of[:-1]], np.r_[of[1:] != of[:-1], True]
        if len(real):
            u += self.w.mask[(space_before & ~first) | (space_after & ~last) << 1 | first << 2 | last << 3]
            u[self.finds[ids[real]], I] = -1e9
        self.joins = self.keyed[ids[real]]
        return tokens, real, start - base[line], end - base[line], of, u


def marginals(u: list[tuple[float, float, float]], move: list[list[float]]) -> list[tuple[float, float, float]]:
    """Label chances of a run of tokens between two that are no part of an entity: exact, forward and backward."""
    n = len(u)
    e = []
    for x in u:
        top = max(x)
        e.append((math.exp(x[0] - top), math.exp(x[1] - top), math.exp(x[2] - top)))
    fs, f = [], (1.0, 0.0, 0.0)
    for x in e:
        g = [x[k] * (f[0] * move[0][k] + f[1] * move[1][k] + f[2] * move[2][k]) for k in range(3)]
        s = g[0] + g[1] + g[2]
        f = (g[0] / s, g[1] / s, g[2] / s)
        fs.append(f)
    out, b = [None] * n, (move[0][0], move[1][0], move[2][0])
    for i in range(n - 1, -1, -1):
        f = fs[i]
        p = (f[0] * b[0], f[1] * b[1], f[2] * b[2])
        s = p[0] + p[1] + p[2]
        out[i] = (p[0] / s, p[1] / s, p[2] / s)
        x = e[i]
        y = (x[0] * b[0], x[1] * b[1], x[2] * b[2])
        b = [move[k][0] * y[0] + move[k][1] * y[1] + move[k][2] * y[2] for k in range(3)]
        s = max(b)
        b = (b[0] / s, b[1] / s, b[2] / s)
    return out


@dataclass(slots=True)
class Run:
    """Tokens of a line that may be part of an entity, side by side: their potentials, places, texts, keys for skip edges, and chances by the chain alone."""

    u: list[tuple[float, float, float]]
    places: list[tuple[int, int]]
    texts: list[str]
    keys: list[Keys]
    alone: list[tuple[float, float, float]]


class Chains:
    """Lines to runs, and documents to labels."""

    def __init__(self, weights: Weights):
        self.w, self.scorer = weights, Scorer(weights)
        self.move = [[float(math.exp(x)) for x in row] for row in weights.move]
        # a token that cannot come near even odds, whatever its neighbours and one more occurrence say, takes no part
        self.least = -(weights.gain + float(np.abs(weights.skip).max())) - 1.0

    def runs(self, lines: list[tuple[str, list[tuple[int, int, str]]]], keys: list[dict[int, str]]) -> list[list[Run]]:
        """Of each line (text, patterns' finds) its runs, but for those that no skip edge can join and that hold no entity by themselves; keys: by line the skip key of each find by its start."""
        out: list[list[Run]] = [[] for _ in lines]
        tokens, real, start, end, line, u = self.scorer.potentials(lines)
        if not len(real):
            return out
        at = np.flatnonzero(np.maximum(u[:, B], u[:, I]) - u[:, O] > self.least)
        if not len(at):
            return out
        first = np.r_[True, (np.diff(at) > 1) | (np.diff(line[at]) > 0)]
        # a token alone that no edge may join and that is surely no entity needs no run
        m, v = self.w.move, u[at].astype(float)
        lean = np.maximum(v[:, B] + m[O, B] + m[B, O], v[:, I] + m[O, I] + m[I, O]) - v[:, O] - 2 * m[O, O]
        use = ~(first & np.r_[first[1:], True] & ~self.scorer.joins[at] & (lean < -1e-3))
        at, first, v = at[use], np.flatnonzero(first[use]).tolist(), [tuple(x) for x in v[use].tolist()]
        where = real[at]
        texts, places = [tokens[i] for i in where.tolist()], list(zip(start[where].tolist(), end[where].tolist()))
        of = line[at].tolist()
        for a, b in zip(first, [*first[1:], len(v)]):
            k = of[a]
            ks = [(keys[k].get(x), None, None) if len(t) > 1 and t[0] == "<" else keys_of(t) for t, (x, _) in zip(texts[a:b], places[a:b])]
            alone = marginals(v[a:b], self.move)
            if any(x[0] is not None for x in ks) or any(max(c[B], c[I]) > c[O] for c in alone):
                out[k].append(Run(v[a:b], places[a:b], texts[a:b], ks, alone))
        return out

    def decide(self, lines: list[tuple[int, list[Run]]], rounds: int = 6) -> list[list[tuple[str, int, int, int, float]]]:
        """The tokens labelled B or I of a document, run by run: (text, start, end, label, chance); loopy message passing over the skip edges, exact in each run."""
        runs = [(at, r) for at, rs in lines for r in rs]
        nodes = [(n, i) for n, (_, r) in enumerate(runs) for i in range(len(r.u))]
        edges = [(nodes[i], nodes[j], float(self.w.skip[kind])) for i, j, kind in edges_of([k for _, r in runs for k in r.keys]) if self.w.skip[kind] > 0]
        post = [r.alone for _, r in runs]
        if edges:
            post = self._pass(runs, post, edges, rounds)
        out = []
        for (at, r), p in zip(runs, post):
            part = []
            for (a, b), t, c in zip(r.places, r.texts, p):
                label = max(range(3), key=c.__getitem__)
                if label != O:
                    part.append((t, at + a, at + b, label, c[B] + c[I]))
                elif part:
                    out.append(part)
                    part = []
            if part:
                out.append(part)
        return out

    def _pass(self, runs: list, post: list, edges: list, rounds: int) -> list:
        """Messages are log-odds of being part of an entity; a run's chances are computed anew from what its skip edges say."""
        links: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for k, (a, b, _) in enumerate(edges):
            links[a].append((2 * k, 2 * k + 1))  # (message out, message in)
            links[b].append((2 * k + 1, 2 * k))
        msg, touched, post = [0.0] * (2 * len(edges)), sorted({n for n, _ in links}), list(post)
        for _ in range(rounds):
            new = msg[:]
            for (n, i), ks in links.items():
                c = post[n][i]
                odds = math.log(max(c[B] + c[I], 1e-12) / max(c[O], 1e-12))
                for out, into in ks:
                    h, w = max(-30.0, min(30.0, odds - msg[into])), edges[out // 2][2]
                    new[out] = math.log((math.exp(w + h) + 1) / (math.exp(h) + math.exp(w)))
            change = max(abs(a - b) for a, b in zip(new, msg))
            msg = new
            for n in touched:
                r = runs[n][1]
                more = [sum(msg[into] for _, into in links.get((n, i), ())) for i in range(len(r.u))]
                post[n] = marginals([(u[0], u[1] + m, u[2] + m) for u, m in zip(r.u, more)], self.move)
            if change < 1e-3:
                break
        return post


# ---- learning ---------------------------------------------------------------------------------------------------------


def learn(docs: Iterable[list[tuple[Line, list[Keys], list[int]]]], common: set[str], given: set[str], epochs: int = 8, batch: int = 4096, rate: float = 0.15, keep: float = 0.7, seed: int = 1) -> Weights:
    """Weights by the pseudo-likelihood of the tokens with a known label (-1: unknown), each given its neighbours' labels.

    docs: by document its lines, with each token's keys for skip edges and label. What a token's own features say is hidden from time to time (they are kept with
    chance `keep`), so that neighbours, endings and other occurrences learn to speak for it; so are the neighbours' labels, whose weights would grow too great otherwise.
    """
    index: dict[str, int] = {"\n": 0}
    rows, ys, masks, prev, nxt, pattern, edges = array("i"), array("b"), array("b"), array("b"), array("b"), array("b"), array("i")
    for doc in docs:
        first = len(ys)
        for i, j, kind in edges_of([k for _, keys, _ in doc for k in keys]):
            edges.extend((i + first, j + first, kind))
        for line, _, labels in doc:
            n = len(labels)
            ids = [0, 0, *[index.setdefault(t, len(index)) for t, _, _ in line.tokens], 0]
            for i in range(n):
                rows.extend((ids[i + 2], ids[i + 1], ids[i], ids[i + 3]))
            ys.extend(labels)
            masks.extend(line.masks)
            if n:
                prev.extend([O, *labels[:-1]])
                nxt.extend([*labels[1:], O])
            pattern.extend([t[0] == "<" and len(t) > 1 for t, _, _ in line.tokens])
    w = Weights(np.zeros((WIDTH, 3), np.float32), np.zeros((16, 3), np.float32), np.zeros((3, 3)), np.zeros(SKIPS), common, given)
    w.move[O, I] = -8.0
    w.emit[_ids("here", ["sound=1"])[0], B] = 2.0
    if not len(ys):
        return w
    table = {t: attributes(t, common, given) if t != "\n" else {r: ["end"] if r != "here" else [] for r in ROLES} for t in index}
    feats, longest = [], {r: max(len(x[r]) for x in table.values()) for r in ROLES}
    for r in ROLES:
        f = np.full((len(index), max(1, longest[r])), WIDTH, np.int32)
        for t, k in index.items():
            if t != "\n":
                f[k, : len(table[t][r])] = _ids(r, table[t][r])
        feats.append(f)
    rows, edges = np.array(rows).reshape(-1, 4), np.array(edges, int).reshape(-1, 3)
    y, masks, prev, nxt = (np.array(x, int) for x in (ys, masks, prev, nxt))
    pattern = np.array(pattern, bool)
    # each skip edge is seen from both ends: for each kind the token at the other end of the edge before, and of the edge after
    ends = np.full((2 * SKIPS, len(y)), -1)
    ends[edges[:, 2], edges[:, 1]], ends[SKIPS + edges[:, 2], edges[:, 0]] = edges[:, 0], edges[:, 1]
    known = np.flatnonzero(y >= 0)
    rng = np.random.default_rng(seed)
    emit, g2 = np.zeros((WIDTH + 1, 3)), np.full((WIDTH + 1, 3), 1e-2)
    # before anything is learned, a sound find of a pattern is what its pattern says
    emit[_ids("here", ["sound=1"])[0], B] = 2.0
    small = {"mask": np.zeros((16, 3)), "move": w.move.copy(), "skip": np.zeros(SKIPS)}
    small_g2 = {k: np.full(x.shape, 1.0) for k, x in small.items()}
    # rare labels weigh more, or nothing is learned from few entities
    weight = np.where(y == O, 1.0, np.clip((y == O).sum() / max(1, (y > O).sum()) / 40, 1.0, 5.0))
    # a small sample is gone over more often
    for _ in range(max(epochs, min(100, -(-400 * batch // max(1, len(known)))))):
        rng.shuffle(known)
        for at in range(0, len(known), batch):
            k = known[at : at + batch]
            f = np.concatenate([feats[r][rows[k, r]] for r in range(4)], 1)
            f = np.where(rng.random(f.shape) < keep, f, WIDTH)
            z = emit[f].sum(1) + small["mask"][masks[k]]
            p, q = prev[k], nxt[k]
            use_p, use_q = (p >= 0) & (rng.random(len(k)) < 0.5), (q >= 0) & (rng.random(len(k)) < 0.5)
            z += np.where(use_p[:, None], small["move"][np.maximum(p, 0)], 0) + np.where(use_q[:, None], small["move"][:, np.maximum(q, 0)].T, 0)
            agree = np.zeros((SKIPS, len(k)))
            for kind, o in enumerate(ends[:, k]):
                label = np.where(o >= 0, y[np.maximum(o, 0)], -1)
                use = (label >= 0) & (rng.random(len(k)) < 0.5)
                ent = np.where(use, np.where(label > O, 1.0, -1.0), 0.0)
                agree[kind % SKIPS] += ent
            lean = small["skip"] @ agree / 2
            z[:, B] += lean
            z[:, I] += lean
            z[:, O] -= lean
            z[pattern[k], I] = -1e9
            z -= z.max(1, keepdims=True)
            pr = np.exp(z)
            pr /= pr.sum(1, keepdims=True)
            d = -pr
            d[np.arange(len(k)), y[k]] += 1
            d *= weight[k][:, None]
            step = np.stack([np.bincount(f.ravel(), np.repeat(d[:, c], f.shape[1]), WIDTH + 1) for c in range(3)], 1) - 1e-3 * emit
            step[WIDTH] = 0
            g2 += step**2
            emit += rate * step / np.sqrt(g2)
            g = {"mask": np.stack([np.bincount(masks[k], d[:, c], 16) for c in range(3)], 1), "move": np.zeros((3, 3))}
            for c in range(3):
                g["move"][:, c] += np.bincount(np.maximum(p, 0), np.where(use_p, d[:, c], 0), 3)
                g["move"][c] += np.bincount(np.maximum(q, 0), np.where(use_q, d[:, c], 0), 3)
            g["skip"] = agree @ (d[:, B] + d[:, I] - d[:, O]) / 2
            for name, x in g.items():
                x = x - 0.05 * small[name]
                small_g2[name] += x**2
                small[name] += rate * x / np.sqrt(small_g2[name])
            small["move"][O, I] = -8.0
    return Weights(emit[:WIDTH].astype(np.float32), small["mask"].astype(np.float32), small["move"], np.maximum(small["skip"], 0.0), common, given)
