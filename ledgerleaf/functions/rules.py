"""Rules that clean a filing's text, in a form that both Java's and Python's regular expressions read."""

from __future__ import annotations

BLANK = r"[^\S\r\n]"
SPACE = r"[\s\x1c-\x1f]"
DASH = "[-‒–—]"

# Characters and what stands for them.
CHARACTERS = {
    "\xa0": " ", "\u200b": " ", "\u2009": " ",
    "\x91": "‘", "\x92": "’", "\x93": "“", "\x94": "”", "\x95": "•", "\x96": "-", "\x97": "-", "\x98": "˜", "\x99": "™",
    "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\u2014": "-", "\u2015": "-",
}


def _spaced(word: str) -> str:
    """A word whose letters may have blanks between them, one group per letter."""
    return f"{BLANK}*".join(f"({c})" for c in word)


def _groups(n: int) -> str:
    return "".join(rf"\g<{i}>" for i in range(1, n + 1))


#: (pattern, replacement with \g<n> for groups), all without regard to case. Headers first, then page furniture.
HEADERS = [
    (rf"(\n{BLANK}*){_spaced('PART')}({BLANK}+)((?:\d{{1,2}}|[IV]{{1,2}})[AB]?)", _groups(7)),
    (rf"(\n{BLANK}*){_spaced('ITEM')}({BLANK}+)(\d{{1,2}}[AB]?)", _groups(7)),
    (rf"(\n{BLANK}*){_spaced('SIGNATURE')}{BLANK}*(?:(S)|(\(){BLANK}*(s){BLANK}*(\)))?({BLANK}+)({BLANK}?)", _groups(16)),
    (rf"(ITEM|PART)({SPACE}+\d{{1,2}}[AB]?)([\-•])", r"\g<1>\g<2> \g<3> "),
]
FURNITURE = [
    (rf"\n{BLANK}*(?:TABLE{SPACE}+OF{SPACE}+CONTENTS|INDEX{SPACE}+TO{SPACE}+FINANCIAL{SPACE}+STATEMENTS|BACK{SPACE}+TO{SPACE}+CONTENTS|QUICKLINKS){BLANK}*\n", "\n"),
    (rf"\n{BLANK}*{DASH}*\d+{DASH}*{BLANK}*\n", "\n"),
    (rf"\n{BLANK}*\d+{BLANK}*\n", "\n"),
    (rf"{SPACE}F{DASH}*\d+", ""),
    (rf"\n{BLANK}*Page{SPACE}[\d*]+{BLANK}*\n", ""),
]
#: What a text must have somewhere for a rule to meet it, of a rule that has no fixed beginning: looked for first, as it is cheap.
NEEDED = {HEADERS[-1][0]: rf"{SPACE}\d{{1,2}}[AB]?[\-•]"}
