"""Token, tag, sequence and metric operators on hand-made cases."""

import pytest
from helpers import rows, tokens
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom.operators import metrics as mt
from tagloom.operators import sequences as sq
from tagloom.operators import tags as tg
from tagloom.operators import tokens as tk


def lines(spark, *values):
    return spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "doc_id long, line_no int, value string")


def test_char_tags(spark):
    got = tk.char_bilou(lines(spark, "研究 生命 。 a bcd")).orderBy("tok_id")
    assert [(r["token"], r["ner"]) for r in got.collect()] == [
        ("研", "B-w"), ("究", "L-w"), ("生", "B-w"), ("命", "L-w"), ("。", "O"), ("a", "U-w"),
        ("b", "B-w"), ("c", "I-w"), ("d", "L-w"),
    ]


def test_char_tags_edges(spark):
    got = tk.char_bilou(lines(spark, "  a  𝒳b\tc ")).orderBy("tok_id").collect()
    assert [(r["token"], r["ner"]) for r in got] == [("a", "U-w"), ("𝒳", "B-w"), ("b", "I-w"), ("\t", "I-w"), ("c", "L-w")]
    got = tk.char_bilou(lines(spark, "a b\tcd"), mode="test").orderBy("tok_id").collect()
    assert [(r["token"], r["ner"]) for r in got] == [("a", "U-w"), ("b", "U-w"), ("c", "B-w"), ("d", "L-w")]
    got = tk.char_bilou(lines(spark, "!! !")).orderBy("tok_id").collect()
    assert [r["ner"] for r in got] == ["B-w", "L-w", "O"]


WORD = st.text(alphabet="abé中。!,", min_size=1, max_size=5)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(WORD, min_size=1, max_size=6), min_size=1, max_size=20))
def test_tagging_then_rebuilding_returns_the_words(spark, sentences):
    table = lines(spark, *[" ".join(s) for s in sentences])
    chars = tk.char_bilou(table)
    back = sq.words_to_lines(sq.rebuild_words(chars)).orderBy("sent_id")
    assert [r["value"] for r in back.collect()] == [" ".join(s) for s in sentences]
    counts = {r["ner"]: r["count"] for r in chars.groupBy("ner").count().collect()}
    assert counts.get("B-w") == counts.get("L-w")


def test_rebuild_drops_an_open_tail(spark):
    df = tokens(spark, [[("a", "B-w"), ("b", "L-w"), ("c", "U-w"), ("d", "B-w")]])
    assert rows(sq.rebuild_words(df), "word_id", "word") == [(0, "ab"), (1, "c")]


def test_iob_to_bilou(spark):
    tags = ["B-PER", "O", "B-ORG", "I-ORG", "O", "B-LOC", "B-PER"]
    df = tokens(spark, [[(str(i), t) for i, t in enumerate(tags)]])
    assert [r[0] for r in sq.iob_to_bilou(df).orderBy("tok_id").select("ner").collect()] == [
        "U-PER", "O", "B-ORG", "L-ORG", "O", "B-LOC", "U-PER"
    ]
    strict = sq.iob_to_bilou(df, strict=True, block_rows=2).orderBy("tok_id").select("ner").collect()
    assert [r[0] for r in strict] == ["U-PER", "O", "B-ORG", "L-ORG", "O", "U-LOC", "U-PER"]


def test_sentences(spark):
    docs = spark.createDataFrame([(1, "Né a. Two!  Three\n\n四。 五"), (2, "\\N")], "doc_id long, text string")
    got = tk.document_sentences(docs).orderBy("sent_id").collect()
    assert [r["sentence"] for r in got] == ["Né a.", "Two!", "Three", "四。", "五"]
    words = tk.sentence_tokens(docs).where("sent_id = 0").orderBy("tok_id").collect()
    assert [r["token"] for r in words] == ["Né", "a", "."]


def test_end_rows_split_again(spark):
    docs = spark.createDataFrame([(1, "A b. C"), (2, "D")], "doc_id long, text string")
    flat = tk.tokens_with_ends(docs)
    assert [r["token"] for r in flat.where("doc_id = 1").orderBy("tok_id").collect()] == ["A", "b", ".", "##END", "C", "##END"]
    for block in (None, 2):
        cut = sq.sentence_ids(flat, block_rows=block)
        assert rows(cut, "doc_id", "sent_id", "tok_id", "token") == [
            (1, 0, 0, "A"), (1, 0, 1, "b"), (1, 0, 2, "."), (1, 1, 4, "C"), (2, 0, 0, "D")
        ]
    assert rows(sq.delimiter_rows(flat)) == [(1, 3), (1, 5), (2, 1)]


def test_end_rows_of_a_token_table(spark):
    df = tokens(spark, [[("a", "O"), ("b", "O")], [("c", "O")]]).withColumn("pos", F.lit("X"))
    got = rows(tk.with_end_rows(df), "sent_id", "tok_id", "token", "ner", "pos")
    assert (0, 2, "##END", "O", "###") in got and (1, 1, "##END", "O", "###") in got and len(got) == 5


def test_markup(spark):
    df = spark.createDataFrame(
        [(1, 0, "||Ann Lee||person||| met ||Acme||company|||"), (1, 1, "no markup"), (1, 2, "||Big New Co||company|||, x")],
        "doc_id long, sent_id int, sentence string",
    )
    got = tk.markup_to_bilou(df).orderBy("sent_id", "tok_id").collect()
    assert [(r["token"], r["ner"]) for r in got] == [
        ("Ann", "B-PPL"), ("Lee", "L-PPL"), ("met", "O"), ("Acme", "U-COM"),
        ("Big", "B-COM"), ("New", "I-COM"), ("Co,", "L-COM"), ("x", "O"),
    ]


def test_candidates(spark):
    df = spark.createDataFrame([("A B c 1",), ("A b c d",), ("A B-C D e",)], "sentence string")
    assert rows(tk.ner_candidates(df)) == [("A B c 1",)]


def test_context(spark):
    df = tokens(spark, [[("a", "O"), ("b", "O"), ("c", "O")]])
    got = sq.context_features(df).orderBy("tok_id").collect()
    assert [r["previous1cur"] for r in got] == [None, "ab", "bc"]
    assert [r["previous2cur"] for r in got] == [None, None, "abc"]
    assert [r["cur_next1"] for r in got] == ["ab", "bc", None]
    assert [r["cur_next2"] for r in got] == ["abc", None, None]
    assert [(r["BOS"], r["EOS"]) for r in got] == [(True, None), (None, None), (None, True)]


def test_votes(spark):
    df = spark.createDataFrame(
        [("B-COM", "B-COM", "O", "O"), ("O", "U-PPL", "U-GPE", "O"), ("U-PPL", "O", "O", "U-COM"), ("O", "O", "O", "U-ACA")],
        "c string, p string, g string, gen string",
    )
    two = [r[0] for r in df.select(tg.vote({"COM": "c", "PPL": "p"})).collect()]
    assert two == ["B-COM", "U-PPL", "O", "O"]
    assert [r[0] for r in df.select(tg.vote({"PPL": "p", "COM": "p"})).collect()] == [r[0] for r in df.select("p").collect()]
    many = [r[0] for r in df.select(tg.vote({"COM": "c", "PPL": "p", "GPE": "g", "GEN": "gen"})).collect()]
    assert many == ["B-COM", "U-GPE", "O", "U-ACA"]


def test_entities_and_corrections(spark):
    df = tokens(spark, [[("Ola", "U-PPL"), ("x", "O"), ("Ola", "U-PPL"), ("New", "B-GPE"), ("York", "L-GPE"), ("q", "B-COM")]])
    found = tg.entity_phrases(df)
    assert rows(found) == [(1, "New York", "GPE", 1), (1, "Ola", "PPL", 2)]
    remap = spark.createDataFrame([("Ola##PPL", "Ola##COM")], "wrong string, correct string")
    fixed = tg.remap_entities(found, remap)
    assert rows(fixed) == [(1, "New York", "GPE", 1), (1, "Ola", "COM", 2)]
    assert tg.phrase_map(fixed).first()["ner_phrase"] == {"New York##GPE##1": [], "Ola##COM##2": []}
    kept = sq.typed_segments(df, keep_open=True)
    assert ("q", "COM") in rows(kept, "entity", "ner")


def test_tag_filters(spark):
    df = spark.createDataFrame([("B-COM",), ("U-GPE",), ("O",), ("X-ZZZ",)], "t string")
    assert [r[0] for r in df.select(tg.keep_tag_types("t", ["COM", "PPL"])).collect()] == ["B-COM", "O", "O", "O"]
    assert [r[0] for r in df.select(tg.collapse_tags("t")).collect()] == ["B-COM", "O", "O", None]


def predictions(spark, sentences):
    data = [(1, s, t, "w", a, b) for s, sent in enumerate(sentences) for t, (a, b) in enumerate(sent)]
    return spark.createDataFrame(data, "doc_id long, sent_id int, tok_id int, token string, truth string, pred string")


def test_markup_splits_each_sentence_once(spark):
    """A type of a closing word beats the order of pairs, and the words are not split anew for a filter or a pair."""
    texts = ["||a b||company||| ||c||person|||", "||a ||b x||person||| y||company||| z", "||a b||company|||person||| c", "x || y", "x"]
    df = spark.createDataFrame([(1, i, s) for i, s in enumerate(texts)], "doc_id long, sent_id int, sentence string")
    marked = tk.markup_to_bilou(df)
    got = [" ".join(r["ner"] for r in sorted(marked.where(f"sent_id = {i}").collect(), key=lambda r: r["tok_id"])) for i in range(5)]
    assert got == ["B-COM L-COM U-PPL", "B-PPL B-COM I-COM L-COM O", "B-COM L-COM O", "O O O", ""]
    assert marked._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_entity_metrics(spark):
    df = predictions(spark, [[("U-COM", "U-COM"), ("O", "O"), ("B-PPL", "B-PPL"), ("L-PPL", "O")]])
    got = {r["label"]: tuple(r)[1:] for r in mt.entity_metrics(df).collect()}
    assert got == {"COM": (1.0, 1.0, 1.0, 1), "PPL": (0.0, 0.0, 0.0, 1), "Total": (0.5, 0.5, 0.5, 2)}


def test_entity_metrics_swap_and_extra_types(spark):
    df = predictions(spark, [[("U-COM", "U-COM"), ("O", "U-PPL"), ("O", "U-PPL")]])
    got = {r["label"]: tuple(r)[1:] for r in mt.entity_metrics(df).collect()}
    assert got == {"COM": (1.0, 1.0, 1.0, 1), "Total": (0.3333, 1.0, 0.5, 1)}
    swapped = {r["label"]: tuple(r)[1:3] for r in mt.entity_metrics(df, compat=True).collect()}
    assert swapped["Total"] == (1.0, 0.3333)


@pytest.mark.parametrize("mode", ["spc", "bin"])
def test_perfect_predictions_score_one(spark, mode):
    df = predictions(spark, [[("U-COM", "U-COM"), ("O", "O"), ("B-PPL", "B-PPL"), ("L-PPL", "L-PPL")]])
    assert {r["f1"] for r in mt.label_report(df, mode).collect()} == {1.0}
    assert {r["f1"] for r in mt.entity_metrics(df).collect()} == {1.0}
    assert mt.weighted_f1(df).first()[0] == 1.0
    assert mt.token_accuracy(df).first()[0] == 1.0
    assert mt.mismatches(df).count() == 0


def test_positional_zip(spark):
    a = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "line_no long, value string")
    b = spark.createDataFrame([(0, "x"), (1, "y")], "line_no long, value string")
    assert rows(sq.zip_lines(a, b)) == [(0, "a\tx"), (1, "b\ty")]
    assert sq.positional_zip(a, b.withColumnRenamed("value", "v"), ["line_no"], pad=True).count() == 3


def test_head_and_tail(spark):
    data = [(1, w, float(s)) for w, s in zip("abcdefghij", range(10), strict=True)] + [(2, "x", 1.0)]
    df = spark.createDataFrame(data, "doc_id long, word string, score double")
    got = {r["doc_id"]: (r["head"], r["tail"]) for r in sq.head_tail_words(df).collect()}
    assert got[1][0] == "j: 9.0, i: 8.0" and got[1][1].startswith("h: 7.0") and got[2] == ("x: 1.0", None)


def test_outside_tagger(spark):
    df = tokens(spark, [[("a", "O"), ("bb", "O")]]).select("doc_id", "sent_id", "tok_id", "token")

    def load():
        return lambda pdf: pdf.assign(pos=pdf["token"].str.len().astype(str), dep="d")

    got = tk.annotate_with(df, load, "doc_id long, sent_id int, tok_id int, token string, pos string, dep string")
    assert rows(tk.annotation_output(got, "crf"), "token", "ner", "pos") == [("a", "O", "1"), ("bb", "O", "2")]
    assert rows(tk.annotation_output(got, "pos+dep"), "token", "pos", "ner", "dep") == [("a", "1", "O", "d"), ("bb", "2", "O", "d")]
