"""Tag vocabularies, lookup tables and character classes.

Regular expressions built from these classes use only syntax that Java and
RE2 read the same way (``\\p{L}``, ``\\x{..}``), so a pattern means the same in
Spark and in the SQL used to check it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cache

END_TOKEN = "##END"
END_POS = "###"
OUTSIDE = "O"
NULL_TEXT = "\\N"

# ---- fixed values: default workload parameters -----------------------------
WINDOW_SIZE = 2
CV_FOLDS = 5
SEARCH_DRAWS = 10
MAX_ITERATIONS = 100
C1 = 0.1
C2 = 0.1
POLL_SECONDS = 10
ROWS_PER_FILE = 60000
CONTENT_COLUMN = "DETAIL"

# ---- fixed values: company types that become ORG ---------------------------
COMPANY_TYPES = [
    "PUB", "EXT", "SUB", "PVT", "MUT", "UMB", "PVF", "HOL", "MUC", "TRU", "OPD", "PEF", "FND", "FNS", "JVT",
    "VEN", "HED", "UIT", "MUE", "ABS", "GOV", "ESP", "PRO", "FAF", "SOV", "COR", "IDX", "BAS", "PRT", "SHP",
]

# ---- fixed values: Penn part-of-speech tags to universal ones --------------
PENN_TO_UNIVERSAL = {
    "NNP": "PROPN", "VBZ": "VERB", "JJ": "ADJ", "NN": "NOUN", "TO": "PART", "VB": "VERB", ".": "PUNCT",
    "CD": "NUM", "DT": "DET", "VBD": "VERB", "IN": "ADP", "PRP": "PRON", "NNS": "PROPN", "VBP": "VERB",
    "MD": "VERB", "VBN": "VERB", "POS": "PART", "JJR": "ADJ", "O": "##", "RB": "PART", ",": "PUNCT",
    "FW": "X", "CC": "CONJ", "WDT": "ADJ", "(": "PUNCT", ")": "PUNCT", ":": "PUNCT", "PRP$": "ADJ",
    "RBR": "ADV", "VBG": "VERB", "EX": "ADV", "WP": "NOUN", "WRB": "ADV", "$": "SYM", "RP": "ADV",
    "NNPS": "PROPN", "SYM": "SYM", "RBS": "ADV", "UH": "INTJ", "PDT": "ADJ", "''": "PUNCT",
    "LS": "PUNCT", "JJS": "ADJ", "WP$": "ADJ", "NN|SYM": "X",
}

# ---- fixed values: CoNLL entity types to ours ------------------------------
CONLL_TYPES = {"ORG": "COM", "LOC": "GPE", "PER": "PPL", "MISC": "MISC"}
KEPT_TYPES = ["COM", "PPL"]
DROPPED_TYPES = ["GPE", "GOV", "ACA"]

# ---- fixed values: default corrections of wrongly typed entities -----------
REMAP_DEFAULT = {
    "Ola Share##PPL": "Ola Share##COM",
    "Bengaluru##PPL": "Bengaluru##COM",
    "Ola Pool##PPL": "Ola Pool##COM",
    "Ola##PPL": "Ola##COM",
    "Uber Bengaluru##PPL": "Uber Bengaluru##COM",
    "Didi Dache##PPL": "Didi Dache##COM",
    "Didi Kuaidi##PPL": "Didi Kuaidi##COM",
    "Magic Leap##PPL": "Magic Leap##COM",
    "Didi Chuxing##PPL": "Didi Chuxing##COM",
    "Alibaba Group##PPL": "Alibaba Group##COM",
    "Southeast Asia##PPL": "Southeast Asia##GPL",
    "San Francisco##PPL": "San Francisco##GPL",
    "Seattle##COM": "Seattle##GPL",
    "Federal Communications Commission##COM": "Federal Communications Commission##GPL",
    "FCC##COM": "FCC##GPL",
    "Federal Communications##COM": "Federal Communications##GPL",
}

# ---- fixed values: punctuation ---------------------------------------------
ASCII_PUNCT = r"!-/:-@\[-`{-~"
CJK_PUNCT = (
    r"\x{FF02}-\x{FF0D}\x{FF0F}\x{FF1A}-\x{FF1E}\x{FF20}\x{FF3B}-\x{FF40}\x{FF5B}-\x{FF60}"  # full width
    r"\x{FF62}-\x{FF64}"  # half width
    r"\x{3000}\x{3001}\x{3003}\x{3008}-\x{3011}\x{3014}-\x{301F}\x{3030}\x{303E}\x{303F}"  # symbols, brackets
    r"\x{2013}\x{2014}\x{2018}\x{2019}\x{201B}-\x{201F}\x{2026}\x{2027}"  # dashes, quotes
    r"\x{FE4F}\x{FE51}\x{FE54}\x{00B7}"  # small forms, middle dot
    r"\x{FF01}\x{FF1F}\x{FF61}\x{3002}"  # sentence stops
)
PUNCT = ASCII_PUNCT + CJK_PUNCT

# ---- fixed values: white space as Python's str.isspace sees it -------------
SPACE = (
    r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)

SPACE_CHARS = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())

WORD = r"\p{L}\p{N}_"
CASED = r"\p{Lu}\p{Ll}\p{Lt}"
CJK = r"\x{4E00}-\x{9FFF}"

LINE_BREAK = r"\r\n|\r|\n"
SENTENCE_END = ".!?。！？"
TOKEN_PATTERN = rf"[{WORD}]+|[^{WORD}{SPACE}]"


@cache
def char_class(predicate: Callable[[str], bool]) -> str:
    """Regex ranges of every code point for which ``predicate`` holds."""
    ranges: list[list[int]] = []
    for code in range(0x110000):
        if predicate(chr(code)):
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
    return "".join(
        rf"\x{{{low:X}}}" if low == high else rf"\x{{{low:X}}}-\x{{{high:X}}}" for low, high in ranges
    )


def _numeral_outside_n(char: str) -> bool:
    return char.isnumeric() and not unicodedata.category(char).startswith("N")


def _digit_outside_nd(char: str) -> bool:
    return char.isdigit() and unicodedata.category(char) != "Nd"


def numeric_class() -> str:
    """Characters Python calls numeric: category N plus ideographic numerals."""
    return r"\p{N}" + char_class(_numeral_outside_n)


def digit_class() -> str:
    """Characters Python calls digits: decimals plus superscript, circled and other digits."""
    return r"\p{Nd}" + char_class(_digit_outside_nd)
