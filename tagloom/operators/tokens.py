"""From text to token tables.

All of these work inside one row of text and explode once, so none of them
shuffles. Ordinals come from positions in the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.constants import (
    CONLL_TYPES,
    END_POS,
    END_TOKEN,
    NULL_TEXT,
    OUTSIDE,
    PENN_TO_UNIVERSAL,
    SENTENCE_END,
    SPACE,
    TOKEN_PATTERN,
)
from tagloom.functions.text import (
    is_alnum,
    is_blank,
    is_lower,
    is_punct_char,
    lines_of,
    strip_space,
    tokens_of,
    words_of,
)
from tagloom.operators.columns import map_or_null, map_tag_type
from tagloom.operators.sequences import BLOCK_ROWS, SENTENCE, iob_to_bilou, pack_texts

# The look-ahead rules out visible ASCII before the look-behind and the long class are tried.
SENTENCE_BREAK = rf"(?![\x21-\x7E])(?:(?<=[{SENTENCE_END}])[{SPACE}]+|\n)"


def document_lines(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, line_no, value): lines that are not blank, numbered in the text."""
    return docs.select(F.col(key).alias("doc_id"), F.posexplode(lines_of(text)).alias("line_no", "value")).where(
        ~is_blank("value")
    )


def char_bilou(lines: DataFrame, mode: str = "train", packed: bool = False) -> DataFrame:
    """(doc_id, sent_id, tok_id, token, ner): one row per character of a segmented line.

    A word of one character is ``U-w``, or ``O`` if it is punctuation; longer
    words run ``B-w``, ``I-w``…, ``L-w``. ``train`` splits words at single
    spaces, ``test`` at any white space. ``tok_id`` is the place in the stripped
    line. ``packed`` gives a sentence table.
    """
    def gap(char: Column) -> Column:
        return char == " " if mode == "train" else char.rlike(rf"^[{SPACE}]$")

    def tag_of(chars: Column, at: Column, char: Column) -> Column:
        first = F.coalesce(gap(F.get(chars, at - 1)), F.lit(True))
        last = F.coalesce(gap(F.get(chars, at + 1)), F.lit(True))
        return (
            F.when(first & last, F.when(is_punct_char(char), OUTSIDE).otherwise("U-w"))
            .when(first, "B-w").when(last, "L-w").otherwise("I-w")
        )

    def spell(texts: DataFrame, kept: Sequence[str]) -> DataFrame:
        spelt = texts.select(*kept, F.split(strip_space("value"), "").alias("_chars"))
        # No array is empty or null; a plain explode would be given a filter that splits each line again.
        chars = spelt.select(*kept, "_chars", F.posexplode_outer("_chars").alias("tok_id", "token"))
        tag = tag_of(F.col("_chars"), F.col("tok_id"), F.col("token"))
        return chars.where(~gap(F.col("token"))).select(*kept, "tok_id", "token", tag.alias("ner"))

    values = lines.select("doc_id", F.col("line_no").alias("sent_id"), "value")
    return pack_texts(values, "value", spell) if packed else spell(values, SENTENCE)


def document_sentences(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, sent_id, sentence): ``sent_id`` is the place among the pieces of the text."""
    return (
        docs.where(F.col(text) != NULL_TEXT)
        .select(F.col(key).alias("doc_id"), F.posexplode(F.split(text, SENTENCE_BREAK)).alias("sent_id", "sentence"))
        .where(~is_blank("sentence"))
    )


def sentence_tokens(docs: DataFrame, text: str = "text", key: str = "doc_id", packed: bool = False) -> DataFrame:
    """(doc_id, sent_id, tok_id, token): words and single punctuation marks of each sentence.

    ``packed`` gives a sentence table.
    """
    def spell(sentences: DataFrame, kept: Sequence[str]) -> DataFrame:
        # A plain explode would be given a filter that finds the tokens of each sentence again.
        words = F.posexplode_outer(tokens_of("sentence", TOKEN_PATTERN)).alias("tok_id", "token")
        return sentences.select(*kept, words).where(F.col("tok_id").isNotNull())

    sentences = document_sentences(docs, text, key)
    return pack_texts(sentences, "sentence", spell) if packed else spell(sentences, SENTENCE)


def tokens_with_ends(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, tok_id, token, ner, pos): tokens of the whole text with an end row after each sentence.

    ``tok_id`` numbers the rows of a document without gaps.
    """
    sentences = F.filter(
        F.transform(F.split(text, SENTENCE_BREAK), lambda s: tokens_of(s, TOKEN_PATTERN)), lambda t: F.size(t) > 0
    )
    rows = F.flatten(F.transform(sentences, lambda t: F.concat(t, F.array(F.lit(END_TOKEN)))))
    return (
        docs.where(F.col(text) != NULL_TEXT)
        .select(F.col(key).alias("doc_id"), F.posexplode(rows).alias("tok_id", "token"))
        .withColumn("ner", F.lit(OUTSIDE))
        .withColumn("pos", F.when(F.col("token") == END_TOKEN, END_POS))
    )


def with_end_rows(tokens: DataFrame) -> DataFrame:
    """Append an end row to every (doc_id, sent_id) of a token table.

    The end row is made beside the last token of the sentence, found by a
    partial aggregate, so tokens are not shuffled again.
    """
    ends = tokens.groupBy("doc_id", "sent_id").agg((F.max("tok_id") + 1).alias("tok_id")).select(
        "doc_id", "sent_id", "tok_id",
        F.lit(END_TOKEN).alias("token"), F.lit(OUTSIDE).alias("ner"), F.lit(END_POS).alias("pos"),
    )
    return tokens.unionByName(ends, allowMissingColumns=True)


def ner_candidates(sentences: DataFrame, sentence: str = "sentence", more_than: int = 2) -> DataFrame:
    """Sentences with more than two alphanumeric words that are not in lower case."""
    hits = F.filter(F.split(sentence, " "), lambda w: is_alnum(w) & ~is_lower(w))
    return sentences.where(F.size(hits) > more_than)


MARKS = {"person": "PPL", "company": "COM"}


def markup_to_bilou(sentences: DataFrame, sentence: str = "sentence") -> DataFrame:
    """Inline ``||Name||person|||`` markup to (doc_id, sent_id, tok_id, token, ner).

    Only sentences with markup are kept. The k-th opening token pairs with the
    k-th closing one, and the mark on the closing token gives the type. Where
    pairs overlap the later pair wins, and a company wins over a person.
    """
    at = F.transform("_words", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    begins = F.filter(at, lambda t: t["w"].startswith("||"))
    ends = F.filter(at, lambda t: t["w"].contains("|||"))
    n = F.least(F.size("_b"), F.size("_e"))
    kind = lambda w: F.when(w.contains("company|||"), "COM").when(w.contains("person|||"), "PPL")
    pairs = F.transform(
        F.arrays_zip(F.slice("_b", F.lit(1), n).alias("b"), F.slice("_e", F.lit(1), n).alias("e")),
        lambda p: F.struct(p["b"]["i"].alias("b"), p["e"]["i"].alias("e"), kind(p["e"]["w"]).alias("kind")),
    )
    # In the order of precedence, so that the last pair around a word gives its tag.
    of_kind = lambda k: F.filter("_pairs", lambda p: p["kind"] == k)
    marks = F.concat(*[of_kind(k) for k in MARKS.values()])
    i = F.col("tok_id")
    rows = (
        sentences.where(F.col(sentence).contains("||"))
        .select("doc_id", "sent_id", words_of(sentence).alias("_words"))
        .select("doc_id", "sent_id", "_words", begins.alias("_b"), ends.alias("_e"))
        .select("doc_id", "sent_id", "_words", pairs.alias("_pairs"))
        .select("doc_id", "sent_id", "_words", marks.alias("_marks"))
        # No such sentence is without words; a plain explode would be given a filter that splits each sentence again.
        .select("doc_id", "sent_id", "_marks", F.posexplode_outer("_words").alias("tok_id", "_raw"))
        .withColumn("_p", F.try_element_at(F.filter("_marks", lambda p: (p["b"] <= i) & (p["e"] >= i)), F.lit(-1)))
    )
    first, last = F.col("_p.b") == i, F.col("_p.e") == i
    place = F.when(first & last, "U-").when(first, "B-").when(last, "L-").otherwise("I-")
    token = F.col("_raw")
    for mark in MARKS:
        token = F.replace(token, F.lit("||" + mark), F.lit(""))
    return rows.select(
        "doc_id", "sent_id", "tok_id",
        F.replace(token, F.lit("|"), F.lit("")).alias("token"),
        F.coalesce(F.concat(place, "_p.kind"), F.lit(OUTSIDE)).alias("ner"),
    )


def conll_import(rows: DataFrame) -> DataFrame:
    """(path, line_no, token, ner, pos) with BILOU tags from rows of the CoNLL reader."""
    filled = rows.select(
        "path", "line_no",
        F.coalesce("token", F.lit(END_TOKEN)).alias("token"),
        F.coalesce("ner", F.lit(OUTSIDE)).alias("ner"),
        F.coalesce(map_or_null(F.coalesce("pos", F.lit("NIL")), PENN_TO_UNIVERSAL), F.lit(END_POS)).alias("pos"),
    )
    bilou = iob_to_bilou(filled, keys=["path"], order="line_no", block_rows=BLOCK_ROWS)
    return bilou.withColumn("ner", map_tag_type("ner", CONLL_TYPES))


def annotate_with(
    df: DataFrame, load: Callable[[], Callable[[Any], Any]], schema: str
) -> DataFrame:
    """Map a corpus through an outside tagger in pandas batches.

    ``load`` runs once per task and returns a function from a pandas frame to a
    pandas frame of ``schema``; part-of-speech tags, dependencies or vectors
    come from there.
    """

    def run(batches: Iterator[Any]) -> Iterator[Any]:
        annotate = load()
        for batch in batches:
            yield annotate(batch)

    return df.mapInPandas(run, schema)


# ---- fixed values: outputs an outside tagger can be asked for --------------
ANNOTATION_OUTPUTS = {
    "txt": ["token"],
    "pos": ["pos"],
    "dep": ["token", "dep"],
    "vec": ["vec"],
    "txt+pos": ["token", "pos"],
    "pos+dep": ["token", "pos", "ner", "dep"],
    "crf": ["token", "ner", "pos"],
}


def annotation_output(annotated: DataFrame, switch: str) -> DataFrame:
    """Columns of one output kind, behind the ordinals."""
    df = annotated if "ner" in annotated.columns else annotated.withColumn("ner", F.lit(OUTSIDE))
    ids = [c for c in ("doc_id", "sent_id", "tok_id") if c in df.columns]
    return df.select(*ids, *ANNOTATION_OUTPUTS[switch])


