"""The stream gives what the batch job gives."""

import json

import numpy as np
import pytest
from helpers import rows, tokens

from tagloom.operators.features import FeatureConfig
from tagloom.plans import training as tr
from tagloom.streaming import annotate as sa

SCHEMA = "id LONG, content STRING, DETAIL STRUCT<content: STRING, lang: STRING>"


@pytest.fixture(scope="module")
def tagger(spark):
    people = [[("Ann", "U-PPL"), ("met", "O"), ("Acme", "O"), (".", "O")], [("Bob", "U-PPL"), ("ran", "O"), (".", "O")]]
    firms = [[("Ann", "O"), ("met", "O"), ("Acme", "U-COM"), (".", "O")], [("Bob", "O"), ("ran", "O"), (".", "O")]]
    models = {}
    for name, sentences in (("PPL", people), ("COM", firms)):
        models |= tr.train(tokens(spark, sentences * 10), FeatureConfig(), name=name, buckets=1 << 10, max_iter=20).models
    return tr.Tagger(models, FeatureConfig())


def messages(folder):
    folder.mkdir()
    texts = ["Ann met Acme.", "Bob ran.\nAnn met Acme.", "", "Ann met Acme."]
    for n, part in enumerate((texts[:2], texts[2:])):
        lines = [json.dumps({"id": 10 * n + i, "content": t, "DETAIL": {"content": t, "lang": "en"}}) for i, t in enumerate(part)]
        (folder / f"{n}.json").write_text("\n".join(lines) + "\n")


def test_stream_equals_batch(spark, tagger, tmp_path):
    messages(tmp_path / "in")
    remap = spark.createDataFrame([("Bob##PPL", "Bob##COM")], "wrong string, correct string")
    source = sa.read_messages(spark, SCHEMA, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    for _ in range(2):  # the second run finds nothing new
        query = sa.annotate_stream(
            source, tagger, sa.folder_sink(out), str(tmp_path / "state"), remap=remap, available_now=True
        )
        query.awaitTermination()
    streamed = rows(spark.read.text(out + "/*"))
    batch = rows(sa.annotate_file(spark, str(tmp_path / "in"), SCHEMA, tagger, remap=remap))
    assert streamed == batch
    records = {r["id"]: r for r in (json.loads(line) for (line,) in batch)}
    assert len(records) == 4
    assert records[0]["DETAIL"]["ner_phrase"] == {"Acme##COM##1": [], "Ann##PPL##1": []} == records[11]["DETAIL"]["ner_phrase"]
    assert records[1]["DETAIL"]["ner_phrase"] == {"Acme##COM##1": [], "Ann##PPL##1": [], "Bob##COM##1": []}
    assert records[10]["DETAIL"]["ner_phrase"] == {}
    assert "content" not in records[0] and records[0]["DETAIL"]["content"] == "Ann met Acme."


def test_batch_annotation_of_texts(spark, tagger):
    docs = spark.createDataFrame([(1, "Ann met Acme."), (2, "Bob ran.")], "doc_id long, text string")
    got = rows(tr.annotate_texts(docs, tagger), "doc_id", "tok_id", "token", "ner")
    assert got[:5] == [(1, 0, "Ann", "U-PPL"), (1, 1, "met", "O"), (1, 2, "Acme", "U-COM"), (1, 3, ".", "O"), (1, 4, "##END", "O")]
    assert tr.annotate_texts(docs, tagger, sample=1).select("doc_id").distinct().count() == 1
    assert np.all([m.labels for m in tagger.models.values()])
