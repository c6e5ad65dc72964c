"""String and date functions against hand-made cases and Python's own behaviour."""

import datetime as dt
import hashlib

import pytest
from helpers import column
from pyspark.sql import functions as F

from tagloom.functions import text as fx
from tagloom.functions import times as tm

SAMPLES = [
    "o'neil-smith 3rd", "ÉCOLE été", "straße ßkeit", "abc123 X9", "Hé11o, W:一二 ²½ 你好。", "", "  a\tb ", "U.S.A", "x_y",
    "IV", "iv", "123", "²", "①", "A", "a", "Ab", "aB", "中文", "don't", "ALL CAPS!", "“quoted” ～tilde", "naïve café",
]
WORDS = ["héllo1", "一二", "a-b", "", "A", "Ab", "aB", "AB", "12", "²", "①", "x1", "X1", "éa", "Éa", "中A", "٣", "½", "Ab Cd"]


def test_title_case_is_pythons(spark):
    assert column(spark, SAMPLES, fx.title_case) == [s.title() for s in SAMPLES]


@pytest.mark.parametrize(
    ("ours", "python"),
    [(fx.is_upper, str.isupper), (fx.is_lower, str.islower), (fx.is_title, str.istitle), (fx.is_digit, str.isdigit),
     (fx.is_alnum, str.isalnum)],
)
def test_word_shapes_are_pythons(spark, ours, python):
    assert column(spark, WORDS, ours) == [python(w) for w in WORDS]


def test_remove_punc_drops_numerals_and_cjk_punctuation(spark):
    assert column(spark, ["Hé11o, W:一二 ²½ 你好。", "A-b «c»"], fx.remove_punc) == ["héo w  你好", "ab «c»"]


def test_strip_and_words_use_all_white_space(spark):
    text = "　 a b\t\nc  "
    assert column(spark, [text], fx.strip_space) == [text.strip()]
    assert column(spark, [text], lambda c: fx.words_of(c)) == [text.split()]


def test_replacements(spark):
    assert column(spark, ["a～b\n\tc"], lambda c: fx.replace_map(c, {"～": "~", "\n": " ", "\t": " "})) == ["a~b  c"]
    assert column(spark, ["a.b$c"], lambda c: fx.replace_each(c, [".", "$"], "$1\\")) == ["a$1\\b$1\\c"]
    assert column(spark, ["axx"], lambda c: fx.replace_map(c, {"x+": "y"}, regex=True)) == ["ay"]
    assert column(spark, ["a\nb\r"], fx.remove_eol) == ["a b "]
    assert column(spark, ["axyxy", "xyz"], lambda c: fx.rstrip_chars(c, "xy")) == ["a", "xyz"]


def test_patterns(spark):
    assert fx.any_of_pattern(["a.b", "c|d"]) == r"(a\.b|c\|d)"
    assert fx.any_of_pattern(["a.b", "c|d"], escape=False) == "(a.b|c|d)"
    assert column(spark, ["xa.b", "xaxb"], lambda c: fx.matches_any(c, ["a.b"])) == [True, False]
    assert column(spark, ["ab", "cb", "b"], lambda c: fx.startswith_any(c, ["a", "c"])) == [True, True, False]


def test_md5_utf8_and_pos(spark):
    assert column(spark, ["é"], fx.md5_hex) == [hashlib.md5("é".encode()).hexdigest()]
    assert column(spark, ["é一𝒳"], lambda c: fx.decode_utf8(fx.encode_utf8(c))) == ["é一𝒳"]
    assert column(spark, ["w#NN#x", "w"], fx.cut_pos) == ["w", "w"]


def test_word_counts(spark):
    assert column(spark, ["a b", "a  b", "a"], fx.word_count) == [2, 3, 1]
    assert column(spark, ["a b", " a  b ", ""], lambda c: fx.word_count(c, collapse=True)) == [2, 2, 0]


def test_format_pairs(spark):
    df = spark.sql("SELECT array(named_struct('word', 'a', 'score', 1.23456D), named_struct('word', 'b', 'score', 2D)) AS p")
    assert df.select(fx.format_pairs(F.col("p"))).first()[0] == "a: 1.235, b: 2.0"


def test_dates(spark):
    day = [dt.date(2017, 6, 14)]
    week = column(spark, day, tm.trailing_week, "date")[0]
    assert week == [f"2017-06-{d:02d}" for d in range(8, 15)]
    month = column(spark, [dt.date(2017, 3, 15)], tm.last_month_days, "date")[0]
    assert (month[0], month[-1], len(month)) == ("2017-02-01", "2017-02-28", 28)
    assert column(spark, day, tm.month_start, "date") == [dt.date(2017, 6, 1)]
    assert column(spark, day, tm.format_time, "date") == ["2017-06"]


def test_times(spark):
    parsed = column(spark, ["2017-06-14 01:02:03.000456"], tm.parse_time)[0]
    assert parsed == dt.datetime(2017, 6, 14, 1, 2, 3, 456)
    steps = column(spark, [dt.datetime(2017, 1, 1)], lambda c: tm.time_range(c, 3, "min"), "timestamp_ntz")[0]
    assert steps == [dt.datetime(2017, 1, 1, 0, m) for m in range(3)]
    assert len(column(spark, [dt.datetime(2017, 1, 1)], tm.time_range, "timestamp_ntz")[0]) == 300
    assert len(spark.range(1).select(tm.now("%Y")).first()[0]) == 4
    assert tm.spark_pattern("%Y at %H") == "yyyy 'a''t' HH"
