"""Readers and writers round trip through files."""

import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tagloom.operators.tokens import conll_import
from tagloom.sources import lexicons as lx
from tagloom.sources import readers as rd
from tagloom.sources import writers as wr


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_columns_and_quotes(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'id,name,x\n1,"a, b",z\n')
    assert rows(rd.read_columns(spark, path, ["name"])) == [("a, b",)]
    path = write(tmp_path / "b.tsv", 'id\tname\n1\t"q"\n')
    assert rows(rd.read_columns(spark, path, ["name"], sep="\t", quoted=False)) == [('"q"',)]


def test_lines_keep_their_numbers_over_splits(spark, tmp_path):
    wanted = []
    for name, count in (("one.txt", 400), ("two.txt", 3)):
        text = [("" if i % 7 == 3 else f"{name} line {i}") for i in range(count)]
        path = write(tmp_path / "in" / name, "\n".join(text) + "\n")
        wanted += [(path, i, t) for i, t in enumerate(text) if t]
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}
    for n, v in zip(names, ["700", "0"], strict=True):
        spark.conf.set(n, v)
    try:
        got = rd.read_lines(spark, str(tmp_path / "in"))
        found = [("/" + r["path"].removeprefix("file:").lstrip("/"), r["line_no"], r["value"]) for r in got.collect()]
        assert spark.read.text(str(tmp_path / "in")).rdd.getNumPartitions() > 5
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    assert sorted(found) == sorted(wanted)


def test_tagged_tables(spark, tmp_path):
    write(tmp_path / "t" / "my_train_1.csv", "a,O\n,O\nb,U-w\n")
    write(tmp_path / "t" / "my_test_1.csv", "c,O\n")
    train, test = rd.read_split_folder(spark, str(tmp_path / "t"))
    assert rows(train, "tok_id", "token", "ner") == [(0, "a", "O"), (2, "b", "U-w")]
    assert rows(test, "token", "ner") == [("c", "O")]


def test_json(spark, tmp_path):
    write(tmp_path / "j" / "a.json", '{"a": 1, "b": {"c": "x"}}\n')
    write(tmp_path / "j" / "b.json", '{"a": 2}\n')
    got = rd.read_json_folder(spark, str(tmp_path / "j"), "a INT, b STRUCT<c: STRING>", ["a", "b.c"])
    assert rows(got) == [(1, "x"), (2, None)]


def test_lexicon_files(spark, tmp_path):
    path = write(tmp_path / "set.txt", "a\nb\na\n")
    assert rows(rd.read_lexicon_lines(spark, path)) == [("a",), ("b",)]
    path = write(tmp_path / "map.txt", "a,1\nb,2\na,3\n")
    assert rows(rd.read_lexicon_pairs(spark, path)) == [("a", "3"), ("b", "2")]


def test_lexicon_store_prunes_partitions(spark, tmp_path):
    store = str(tmp_path / "store")
    lx.write_lexicons({"s": spark.createDataFrame([("a",)], "token string")}, store)
    lx.write_lexicons({"m": spark.createDataFrame([("a", "1")], "token string, value string")}, store)
    assert rows(lx.read_lexicons(spark, store), "lexicon", "token", "value") == [("m", "a", "1"), ("s", "a", "True")]
    one = lx.read_lexicons(spark, store, ["m"])
    assert rows(one, "lexicon", "value") == [("m", "1")]
    assert len(one.inputFiles()) >= 1 and "PartitionFilters: [isnotnull(lexicon" in one._jdf.queryExecution().toString()


CONLL = """-DOCSTART- -X- O O

EU NNP I-NP B-ORG
rejects VBZ I-VP O
Peter NNP I-NP B-PER
Blackburn NNP I-NP I-PER

-DOCSTART- -X- O O

Bonn ODD I-NP B-LOC
"""


def test_conll(spark, tmp_path):
    path = write(tmp_path / "c.txt", CONLL)
    got = conll_import(rd.read_conll(spark, path)).orderBy("line_no").collect()
    assert [(r["token"], r["ner"], r["pos"]) for r in got] == [
        ("EU", "U-COM", "PROPN"), ("rejects", "O", "VERB"), ("Peter", "B-PPL", "PROPN"), ("Blackburn", "L-PPL", "PROPN"),
        ("##END", "O", "###"), ("##END", "O", "###"), ("Bonn", "U-GPE", "###"),
    ]
    assert [r["line_no"] for r in got] == list(range(7))


def test_writers(spark, tmp_path):
    df = spark.range(25).select("id", F.lit("x").alias("t"))
    wr.write_chunked(df.coalesce(1), str(tmp_path / "chunks"), rows=10)
    files = list((tmp_path / "chunks").glob("*.csv"))
    assert sorted(len(f.read_text().splitlines()) - 1 for f in files) == [5, 10, 10]
    wr.write_jsonl(df.limit(1), str(tmp_path / "json"))
    line = next((tmp_path / "json").glob("*.json")).read_text().strip()
    assert json.loads(line)["t"] == "x"
    wr.write_csv(df, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv")).count() == 25
    wr.write_text(df, str(tmp_path / "text"), "t")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        wr.write_csv(df, str(tmp_path / "csv"))


def test_frames_from_python(spark):
    assert rows(rd.frame_from_rows(spark, [[1, "a"]], ["n", "t"])) == [(1, "a")]
    assert rows(rd.frame_from_items(spark, {"a": 1}, ["k", "v"])) == [("a", 1)]
    assert rows(rd.frame_from_dicts(spark, [{"x": 1, "y": 2}, {"x": 3}], ["one", "two"])) == [("x", 1, 3), ("y", 2, None)]


@pytest.mark.parametrize("ordered", [True, False])
def test_files_of_exactly_so_many_rows(spark, tmp_path, monkeypatch, ordered):
    for writers in (10_000, 3):
        monkeypatch.setattr(wr, "WRITERS", writers)
        df = spark.range(0, 1003, 1, 13).select("id", (F.col("id") * 7919 % 1003).alias("key"))
        out = tmp_path / f"{writers}"
        wr.write_chunked(df, str(out), rows=60, order=["key"] if ordered else None)
        files = [f.read_text().splitlines() for f in sorted(out.glob("*.csv"))]
        assert [len(f) - 1 for f in files] == [60] * 16 + [43] and {f[0] for f in files} == {"id,key"}
        lines = [tuple(map(int, line.split(","))) for f in files for line in f[1:]]
        assert lines == sorted(lines, key=lambda r: r[1] if ordered else r[0])
    wr.write_chunked(df.limit(0), str(tmp_path / "none"), rows=60)
    assert spark.read.option("header", True).csv(str(tmp_path / "none")).count() == 0
