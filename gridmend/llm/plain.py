"""A line of wiki text without markup, escapes and wrong decoding, with the way back to the places of the original."""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

from gridmend.llm.words import _AND, _WRONG, _repair

#: The signs that any of it begins with. Expressions that begin with one of them hop from sign to sign.
_SIGN = "['<{\\[\\]&Â-ô\xad\u200b-\u200d\ufeff]"
_MARK = re.compile(
    _SIGN + r"(?:(?<=')'{1,4}|(?<=<)/?[A-Za-z][^<>]{0,200}>|(?<=\{)\{(?:citation needed|refnec|référence nécessaire|Belege|fact|cn)\b[^{}]*\}\}|(?<=\[)\[(?:([^\[\]|]*)\|([^\[\]]*)\]\])?|(?<=\])\]"
    + "|(?<=&)" + _AND + "|(?<=[Â-ô])" + _WRONG + "|(?<=[\xad\u200b-\u200d\ufeff]))"
)
#: Whether a line may hold any of it.
_ANY = re.compile(_SIGN + r"(?:(?<=')'|(?<=[<{\[])" + "|(?<=&)" + _AND + "|(?<=[Â-ô])" + _WRONG + "|(?<=[\xad\u200b-\u200d\ufeff]))")


class Plain:
    """text: what a reader sees. place(i): where its character i stands in the original."""

    __slots__ = ("text", "starts", "shifts")

    def __init__(self, line: str):
        self.starts, self.shifts = [0], [0]
        if not _ANY.search(line):
            self.text = line
            return
        out, at, made = [], 0, 0
        for m in _MARK.finditer(line):
            if m.start() < at:
                continue
            s, new, frm = m.group(), "", m.end()
            if s.startswith("[[") and len(s) > 2:
                k = 1 if m.group(2) and line.startswith(m.group(2), m.end() + 1) else 2
                new, frm = m.group(k), m.start(k)
                if k == 1:  # the target stands for itself, its label for the word that follows once more
                    new = new.replace("'''", "")
            elif s[0] not in "'<{[]":
                new = _repair(s)
                if new == s:
                    continue
            head = line[at : m.start()]
            out += [head, new]
            made += len(head)
            if new and s.startswith("[["):
                self.starts.append(made)
                self.shifts.append(frm - made)
            made += len(new)
            at = m.end()
            self.starts.append(made)
            self.shifts.append(at - made)
        self.text = "".join([*out, line[at:]])

    def place(self, i: int) -> int:
        k = bisect_right(self.starts, i) - 1
        return i + self.shifts[k]

    def end(self, i: int) -> int:
        """Where the text up to character i (excluded) ends in the original."""
        return self.place(i - 1) + 1 if i else 0


def plain_of(lines: list[str]) -> list[Plain | None]:
    """Of each line its plain text, or None for a line that is plain as it stands; all are looked through at once."""
    ends = list(accumulate(len(x) + 1 for x in lines))
    odd = {bisect_right(ends, m.start()) for m in _ANY.finditer("\0".join(lines))}
    return [Plain(x) if i in odd else None for i, x in enumerate(lines)]
