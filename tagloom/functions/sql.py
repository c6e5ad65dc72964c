"""Text functions, and functions from a text to rows, under names that SQL can use.

Every function is an SQL expression over Spark's own functions, so a query that calls one is planned as if the expression
stood there: nothing runs in Python, and filters and columns are pushed through. Row functions give an array of structs, which
SQL opens without a join (a table function with a text for argument would be planned as a join on that text)::

    register(spark)
    spark.sql('''SELECT * FROM (SELECT doc_id, inline(rows) FROM (SELECT doc_id, sentence_tokens(text) AS rows FROM docs))
                 WHERE is_title(token)''')

Defined cases: null gives null, and no rows; a text without words gives none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql.types import DataType

from tagloom.constants import ASCII_PUNCT, CASED, CJK, CJK_PUNCT, LINE_BREAK, NULL_TEXT, PUNCT, SPACE, TOKEN_PATTERN, numeric_class
from tagloom.operators.tokens import SENTENCE_BREAK


def _raw(pattern: str) -> str:
    """A pattern as a literal of SQL, in which a backslash stands for itself."""
    return "r'" + pattern.replace("'", r"\x27").replace("\n", r"\n").replace("\r", r"\r") + "'"


def scalar_functions() -> dict[str, str]:
    """Name to parameters, type and expression."""
    runs = _raw(rf"[{CASED}]+|[^{CASED}]+")
    punctuation = _raw(rf"(?![A-Za-z \n\x{{C0}}-\x{{24F}}])[{ASCII_PUNCT}{CJK_PUNCT}{numeric_class()}]")
    title = f"array_join(transform(regexp_extract_all(s, {runs}, 0), r -> initcap(r)), '')"
    return {
        "title_case": f"(s STRING) RETURNS STRING RETURN {title}",
        "is_title": f"(s STRING) RETURNS BOOLEAN RETURN s = {title} AND rlike(s, {_raw(f'[{CASED}]')})",
        "remove_punc": f"(s STRING) RETURNS STRING RETURN lower(regexp_replace(s, {punctuation}, ''))",
        "remove_eol": r"(s STRING) RETURNS STRING RETURN translate(s, '\n\r', '  ')",
        "words_of": f"(s STRING) RETURNS ARRAY<STRING> RETURN array_remove(split(s, {_raw(f'[{SPACE}]+')}), '')",
        "lines_of": f"(s STRING) RETURNS ARRAY<STRING> RETURN split(s, {_raw(LINE_BREAK)})",
        "is_alnum": r"(s STRING) RETURNS BOOLEAN RETURN rlike(s, r'^[\p{L}\p{N}]+$')",
        "has_cjk": f"(s STRING) RETURNS BOOLEAN RETURN rlike(s, {_raw(f'[{CJK}]')})",
        "is_punct_char": f"(s STRING) RETURNS BOOLEAN RETURN rlike(s, {_raw(f'^[{PUNCT}]$')})",
        "cut_pos": "(s STRING) RETURNS STRING RETURN substring_index(s, '#', 1)",
        "tokens_of": f"(s STRING) RETURNS ARRAY<STRING> RETURN regexp_extract_all(s, {_raw(TOKEN_PATTERN)}, 0)",
    }


def row_functions() -> dict[str, str]:
    """Name to parameters, type and expression, of an array with a struct for each row."""
    blank = _raw(f"[^{SPACE}]")
    null_text = "'" + NULL_TEXT.replace("\\", "\\\\") + "'"
    return {
        "document_lines": f"""(s STRING) RETURNS ARRAY<STRUCT<line_no: INT, value: STRING>> RETURN
            filter(transform(split(s, {_raw(LINE_BREAK)}), (x, i) -> named_struct('line_no', i, 'value', x)), r -> rlike(r.value, {blank}))""",
        "sentence_tokens": f"""(s STRING) RETURNS ARRAY<STRUCT<sent_id: INT, tok_id: INT, token: STRING>> RETURN
            flatten(transform(split(CASE WHEN s <> {null_text} THEN s END, {_raw(SENTENCE_BREAK)}), (x, i) ->
              transform(regexp_extract_all(x, {_raw(TOKEN_PATTERN)}, 0), (t, j) -> named_struct('sent_id', i, 'tok_id', j, 'token', t))))""",
    }


def register(spark: SparkSession, prefix: str = "") -> list[str]:
    """Make the functions known to a session, under their names behind ``prefix``; the names."""
    found = {**scalar_functions(), **row_functions()}
    for name, body in found.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}{body}")
    return [f"{prefix}{name}" for name in found]


def register_column_function(spark: SparkSession, name: str, function: Callable[..., Column], result: DataType | str) -> None:
    """Make a vectorised Python function, as ``pandas_udf`` takes it, known to SQL: for what no expression says."""
    from pyspark.sql.functions import pandas_udf

    spark.udf.register(name, pandas_udf(function, result))
