"""String functions as Spark columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.constants import ASCII_PUNCT, CASED, CJK, CJK_PUNCT, LINE_BREAK, PUNCT, SPACE, SPACE_CHARS, digit_class, numeric_class


def as_col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def escape_regex(value: str) -> str:
    """Quote a literal for a pattern that Java and RE2 both read."""
    return "".join("\\" + char if char in r"\.+*?()|[]{}^$" else char for char in value)


def any_of_pattern(values: Iterable[str], escape: bool = True) -> str:
    """Alternation ``(a|b|c)`` over literal values, or over patterns with ``escape=False``."""
    return "(" + "|".join(escape_regex(v) if escape else v for v in values) + ")"


def matches_any(col: Column | str, values: Iterable[str], escape: bool = True) -> Column:
    return as_col(col).rlike(any_of_pattern(values, escape))


def startswith_any(col: Column | str, prefixes: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (as_col(col).startswith(p) for p in prefixes))


def endswith_any(col: Column | str, suffixes: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (as_col(col).endswith(s) for s in suffixes))


def strip_space(col: Column | str) -> Column:
    """Trim every kind of white space on both sides."""
    return F.btrim(as_col(col), F.lit(SPACE_CHARS))


def lines_of(col: Column | str) -> Column:
    return F.split(as_col(col), LINE_BREAK)


def words_of(col: Column | str) -> Column:
    """Words between runs of white space."""
    # The look-ahead rules out visible ASCII before the long class is tried.
    return F.array_remove(F.split(as_col(col), rf"(?![\x21-\x7E])[{SPACE}]+"), "")


def is_blank(col: Column | str) -> Column:
    return ~as_col(col).rlike(rf"[^{SPACE}]")


def is_alnum(col: Column | str) -> Column:
    return as_col(col).rlike(r"^[\p{L}\p{N}]+$")


def is_upper(col: Column | str) -> Column:
    """Holds a cased character and none in lower case."""
    c = as_col(col)
    return (c == F.upper(c)) & (c != F.lower(c))


def is_lower(col: Column | str) -> Column:
    """Holds a cased character and none in upper case."""
    c = as_col(col)
    return (c == F.lower(c)) & (c != F.upper(c))


def title_case(col: Column | str) -> Column:
    """Upper case after every character without case, lower case elsewhere."""
    runs = F.regexp_extract_all(as_col(col), F.lit(rf"[{CASED}]+|[^{CASED}]+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def is_title(col: Column | str) -> Column:
    c = as_col(col)
    return (c == title_case(c)) & c.rlike(rf"[{CASED}]")


def is_digit(col: Column | str) -> Column:
    return as_col(col).rlike(rf"^[{digit_class()}]+$")


def has_cjk(col: Column | str) -> Column:
    return as_col(col).rlike(rf"[{CJK}]")


def is_punct_char(col: Column | str) -> Column:
    return as_col(col).rlike(rf"^[{PUNCT}]$")


def remove_eol(col: Column | str) -> Column:
    return F.translate(as_col(col), "\n\r", "  ")


def replace_map(col: Column | str, replacements: Mapping[str, str], regex: bool = False) -> Column:
    """Apply the replacements in order, as literals unless ``regex`` is set."""
    out = as_col(col)
    for source, target in replacements.items():
        out = F.regexp_replace(out, source, target) if regex else F.replace(out, F.lit(source), F.lit(target))
    return out


def replace_each(col: Column | str, sources: Sequence[str], target: str) -> Column:
    """Replace every source literal by one target in a single pass."""
    return F.regexp_replace(as_col(col), any_of_pattern(sources), target.replace("\\", "\\\\").replace("$", "\\$"))


def rstrip_chars(col: Column | str, chars: str) -> Column:
    return F.rtrim(as_col(col), F.lit(chars))


def remove_punc(col: Column | str) -> Column:
    """Lower case without numeric and punctuation characters; spaces stay."""
    # The look-ahead rules out plain letters and blanks before the long class is tried.
    pattern = rf"(?![A-Za-z \n\x{{C0}}-\x{{24F}}])[{ASCII_PUNCT}{CJK_PUNCT}{numeric_class()}]"
    return F.lower(F.regexp_replace(as_col(col), pattern, ""))


def md5_hex(col: Column | str) -> Column:
    return F.md5(F.encode(as_col(col), "UTF-8"))


def decode_utf8(col: Column | str) -> Column:
    return F.decode(as_col(col), "UTF-8")


def encode_utf8(col: Column | str) -> Column:
    return F.encode(as_col(col), "UTF-8")


def cut_pos(col: Column | str) -> Column:
    """The word of ``word#POS``."""
    return F.substring_index(as_col(col), "#", 1)


def word_count(col: Column | str, collapse: bool = False) -> Column:
    """Words per value: split on one space (empties count) or on runs of white space."""
    return F.size(words_of(col)) if collapse else F.size(F.split(as_col(col), " "))


def format_pairs(pairs: Column, word: str = "word", value: str = "score", precision: int = 3) -> Column:
    """``w: v, w: v`` from an array of structs."""
    return F.array_join(
        F.transform(pairs, lambda p: F.concat(p[word], F.lit(": "), F.round(p[value], precision).cast("string"))), ", "
    )


def tokens_of(col: Column | str, pattern: str) -> Column:
    return F.regexp_extract_all(as_col(col), F.lit(pattern), F.lit(0))
