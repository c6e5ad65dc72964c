"""Small helpers for tests."""

from __future__ import annotations

import pandas as pd


def rows(df, *cols, order=None):
    """Collected rows as tuples, in the given or natural order."""
    picked = df.select(*cols) if cols else df
    out = [tuple(r) for r in picked.collect()]
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r)) if order is None else sorted(out, key=order)


def column(spark, values, expression, type_="string"):
    """Apply a column function to values, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {type_}")
    return [r[0] for r in df.select("i", expression("v").alias("o")).orderBy("i").select("o").collect()]


def tokens(spark, sentences, tag="ner"):
    """Token table from lists of (token, tag) pairs."""
    data = [
        (1, s, t, word, label) for s, sentence in enumerate(sentences) for t, (word, label) in enumerate(sentence)
    ]
    return spark.createDataFrame(data, f"doc_id long, sent_id int, tok_id int, token string, {tag} string")


def canon(df: pd.DataFrame) -> pd.DataFrame:
    """Rows and columns in one order, values as text."""
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(
            lambda v: "null" if v is None or v is pd.NA or v != v else repr(v.item() if hasattr(v, "item") else v)
        )
    return df.sort_values(list(df.columns)).reset_index(drop=True)
