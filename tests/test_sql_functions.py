"""Functions under SQL names give what the column functions give, without Python in the plan."""

import pandas as pd
import pytest
from helpers import rows

from tagloom.functions import sql
from tagloom.functions import text as fx
from tagloom.operators import tokens as tk

TEXTS = ["o'neil-smith 3rd", "Hello, World!  It's 5 o'clock。 研究 生命", "a\r\nb\n\n  c\td", "", "   ", None, "\\N", "ÉCOLE straße ǅ", "x#NOUN", "！", "ab1", "one. Two? three"]
COLUMNS = {
    "title_case": fx.title_case, "is_title": fx.is_title, "remove_punc": fx.remove_punc, "remove_eol": fx.remove_eol, "words_of": fx.words_of,
    "lines_of": fx.lines_of, "is_alnum": fx.is_alnum, "has_cjk": fx.has_cjk, "is_punct_char": fx.is_punct_char, "cut_pos": fx.cut_pos,
    "tokens_of": lambda c: fx.tokens_of(c, tk.TOKEN_PATTERN),
}


@pytest.fixture(scope="module")
def docs(spark):
    names = sql.register(spark, "t_")
    assert set(names) == {f"t_{n}" for n in [*COLUMNS, "document_lines", "sentence_tokens"]}
    table = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    table.createOrReplaceTempView("sql_docs")
    return table


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_scalar(spark, docs, name):
    got = spark.sql(f"SELECT doc_id, t_{name}(text) AS v FROM sql_docs")
    assert rows(got, order=lambda r: r[0]) == rows(docs.select("doc_id", COLUMNS[name]("text").alias("v")), order=lambda r: r[0])
    assert "EvalPython" not in got._jdf.queryExecution().executedPlan().toString()


def test_row_functions(spark, docs):
    got = spark.sql("SELECT doc_id, inline(r) FROM (SELECT doc_id, t_sentence_tokens(text) AS r FROM sql_docs)")
    assert rows(got) == rows(tk.sentence_tokens(docs)) and len(rows(got)) > 15
    lines = spark.sql("SELECT doc_id, inline(r) FROM (SELECT doc_id, t_document_lines(text) AS r FROM sql_docs)")
    assert rows(lines) == rows(tk.document_lines(docs))
    for found in (got, lines):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Generate" in plan and not any(x in plan for x in ("EvalPython", "Exchange", "Join"))


def test_column_function(spark, docs):
    def shout(s: pd.Series) -> pd.Series:
        return s.str.upper() + "!"

    sql.register_column_function(spark, "t_shout", shout, "string")
    got = {r[0]: r[1] for r in rows(spark.sql("SELECT doc_id, t_shout(text) FROM sql_docs WHERE text IS NOT NULL"))}
    assert got[0] == "O'NEIL-SMITH 3RD!"
