"""Running headers, footers and page numbers: the grammar of a line that can be furniture.

The grammar only says what a line looks like; whether it stands between the lines of a text is for the caller.
Plain functions without state, used inside Python workers.
"""

from __future__ import annotations

import re

#: A number of a page by itself: 27, - 13 -, [175], xxii, p. 45, Seite 365, Page 3 of 9, 109 / 163.
PAGE_NUMBER = re.compile(
    r"^\W*(?:(?:p{1,2}\.|page|seite|s\.|página|pág\.|pagina|folio|blatt)\s*)?\d{1,4}(?:\s*(?:/|of|von|de|sur)\s*\d{1,4})?[^\w.!?,;:%]*$"
    r"|^\W*(?=[ivxlc]+\W*$)x{0,3}l?(?:ix|iv|v?i{0,3})x{0,3}(?:ix|iv|v?i{0,3})\W*$"
    r"|^第\s*\d+\s*[頁页]$",
    re.I,
)
#: A number of a page at either end of a line: "Chapter 13   Foreign Bakery   293", "147 | Suburban Filter", "DRAFT NOTES   Seite 175".
NUMBERED = re.compile(r"(?:\s{2,}|\s[|·•]\s|\t)\W*(?:(?:p{1,2}\.|page|seite|s\.|página|pág\.)\s*)?\d{1,4}(?:\s*(?:/|of|von|de|sur)\s*\d{1,4})?[^\w.!?,;:%]*$|^\W*\d{1,4}\W*(?:\s[|·•]\s|\s{2,})|\bVol\.\s*\d+\W*$|[\[(]\d{1,4}[\])]\s*$", re.I)
#: A roman number below 400, as front matter has it; a lone letter only if it is a small i, v or x.
ROMAN = r"(?:(?=[ivxlc]{2}|(?-i:[ivx])(?![^\W_]))c{0,3}(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})(?![^\W_]))"
_ROMAN_OF = rf"{ROMAN}(?:\s*(?:/|of|von|de|sur)\s*(?:\d{{1,4}}|{ROMAN}))?[^\w.!?,;:%]*$"
#: The same forms with a roman number: p. xii, Page iii of xii, cxii, "Foreign Bakery   xii", "xii | Suburban Filter".
#: Apart from the others, which are features of the trees of lines.
ROMAN_NUMBERED = re.compile(
    rf"^\W*(?:(?:(?:page|seite|página|pagina|folio|blatt)\s|p{{1,2}}\.|s\.|pág\.)\s*)?{_ROMAN_OF}"
    rf"|(?:\s{{2,}}|\s[|·•]\s|\t)\W*(?:(?:(?:page|seite|página)\s|p{{1,2}}\.|s\.|pág\.)\s*)?{_ROMAN_OF}"
    rf"|^\W*{ROMAN}\W*(?:\s[|·•]\s|\s{{2,}})|\bVol\.\s*{ROMAN}\W*$|(?<!\w)[\[(]{ROMAN}[\])]\s*$",
    re.I,
)
#: A small roman number at an end of a line: no word of a headline.
_EDGE_ROMAN = re.compile(rf"^\W*{ROMAN}\W+|(?<![^\W_]){ROMAN}\W*$")
#: Nearly all lines have no roman number at an end and are told by this.
_MAYBE_ROMAN = re.compile(r"^\W*[ivxlc]+(?![^\W_])|(?<![^\W_])[ivxlc]+\W*$", re.I)
_WORD = re.compile(r"[^\W\d_]+")
_DIGIT = re.compile(r"\d")
#: A small-letter word of four letters or more: hardly ever in a headline.
_SMALL_WORD = re.compile(r"(?:^|[\s\"'(])[a-zß-öø-ÿ][^\W\d_]{3}")
_SMALL = frozenset("of and the for in on to a an de la le les des du et der die das und von für y el los las en del al zu zum zur im".split())
SENTENCE_END = re.compile(r"[.!?。！？][\"'”’»)\]]*\s*$")


def headline(line: str) -> bool:
    """Every word of weight begins with a capital, or all letters are capitals."""
    words = _WORD.findall(line)
    heavy = [w for w in words if w.lower() not in _SMALL]
    return len(heavy) >= 2 and all(w[0].isupper() for w in heavy)


def looks_like_furniture(line: str) -> bool:
    """A short line that is a page number, ends or begins with one, or is a headline without a sentence's end."""
    s = line.strip()
    if not s or len(s) > 80 or s.count("|") > 1:  # a row of a table
        return False
    if _DIGIT.search(s):
        if PAGE_NUMBER.match(s) or NUMBERED.search(s):
            return True
    elif len(s) <= 12 and PAGE_NUMBER.match(s):
        return True
    if _MAYBE_ROMAN.search(s):
        if ROMAN_NUMBERED.search(s):
            return True
        if not SENTENCE_END.search(s):
            s = _EDGE_ROMAN.sub("", s)
    return not _SMALL_WORD.search(s) and headline(s) and not SENTENCE_END.search(s) and " | " not in s and len(s) <= 60


def strip_trailing(text: str) -> str:
    """The text without blank lines and furniture after its last line of content."""
    lines = text.rstrip().split("\n")
    while len(lines) > 1 and (not lines[-1].strip() or looks_like_furniture(lines[-1])):
        lines.pop()
    return "\n".join(lines)
