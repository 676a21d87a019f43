"""Text as folded words with their places, whatever the markup, escapes and accents around them."""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_right

#: Escapes, and UTF-8 that was decoded as a one-byte code page (two to four such characters).
_AND, _WRONG = r"(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z]{2,8});", r"[\u0080-¿ŒœŠšŸŽžƒˆ˜–-™]{1,3}"
_ODD = re.compile("&" + _AND + "|[Â-ô]" + _WRONG + r"|[­​-‍﻿]")
#: What holds no running text (short notes, tags, short templates), links with a label, and words.
_TOKEN = re.compile(r"<!--[^<>]{0,80}-->|<ref[^<>]*/>|<ref[^<>]*>[^<]{0,80}</ref>|</?[A-Za-z][^<>]{0,200}>|\{\{[^{}]{0,60}\}\}|\[\[([^\[\]|]*)\|([^\[\]|]*)\]\]|[^\W_]+")
_WORD = re.compile(r"[^\W_]+")
PARAGRAPH = re.compile(r"\n[ \t\r]*\n")


def _repair(s: str) -> str:
    if s[0] == "&":
        return html.unescape(s)
    if s[0] in "­​‌‍﻿":
        return ""
    raw = bytearray()
    for c in s:
        try:
            raw += c.encode("cp1252")
        except UnicodeEncodeError:
            if ord(c) > 255:
                return s
            raw.append(ord(c))
    for n in range(len(raw), 1, -1):
        try:
            return raw[:n].decode("utf-8") + s[n:]
        except UnicodeDecodeError:
            continue
    return s


class Places:
    """From a repaired text back to the places of the original."""

    def __init__(self, text: str):
        self.starts, self.shifts, out, at, made = [0], [0], [], 0, 0
        for m in _ODD.finditer(text):
            new = _repair(m.group())
            if new == m.group():
                continue
            out += [text[at : m.start()], new]
            made += m.start() - at + len(new)
            at = m.end()
            self.starts.append(made)
            self.shifts.append(at - made)
        self.text = "".join([*out, text[at:]])

    def original(self, i: int) -> int:
        k = bisect_right(self.starts, i) - 1
        return i + self.shifts[k]


def fold(word: str) -> str:
    """Lower case without accents."""
    if word.isascii():
        return word.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", word.lower().replace("ß", "ss").replace("œ", "oe").replace("æ", "ae")) if not unicodedata.combining(c))


def words(text: str) -> list[tuple[str, int, int]]:
    """(raw word, start, end) in order; of a link with a label the label counts, or its target where the label's words follow once more."""
    p = Places(text) if _ODD.search(text) else None
    s, out = p.text if p else text, []
    if "<" not in s and "{" not in s and "[" not in s:  # no markup
        out = [(m.group(), *m.span()) for m in _WORD.finditer(s)]
        return [(w, p.original(a), p.original(b)) for w, a, b in out] if p else out
    for m in _TOKEN.finditer(s):
        c = s[m.start()]
        if c == "[":
            k = 2 if not m.group(2) or not s.startswith(m.group(2), m.end() + 1) else 1
            if m.group(k):
                out += [(w.group(), m.start(k) + w.start(), m.start(k) + w.end()) for w in _WORD.finditer(m.group(k))]
        elif c != "<" and c != "{":
            out.append((m.group(), m.start(), m.end()))
    return [(w, p.original(a), p.original(b)) for w, a, b in out] if p else out
