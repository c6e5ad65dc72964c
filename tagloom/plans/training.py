"""Train, validate and apply taggers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.constants import C1, C2, CONTENT_COLUMN, CV_FOLDS, MAX_ITERATIONS, OUTSIDE, SEARCH_DRAWS
from tagloom.operators import crf, crf_search
from tagloom.operators.features import FeatureConfig
from tagloom.operators.metrics import entity_metrics
from tagloom.operators.ranking import sample_rows
from tagloom.operators.sequences import keep_fields, rebuild_words, sentence_ids, with_fields, words_to_lines
from tagloom.operators.tags import entity_phrases, keep_tag_types, phrase_map, remap_entities
from tagloom.operators.tokens import char_bilou, sentence_tokens
from tagloom.plans.recipes import enrich_records
from tagloom.sources.readers import read_lines, read_split_folder
from tagloom.sources.writers import write_lines


@dataclass
class Tagger:
    """One or several models with the features and lexicons they read."""

    models: Mapping[str, crf.CrfModel]
    config: FeatureConfig
    lexicons: DataFrame | None = None

    def tag(self, tokens: DataFrame, label: str | None = None) -> DataFrame:
        return crf.predict_tags(tokens, self.models, self.config, self.lexicons, label)


def train(
    tokens: DataFrame,
    config: FeatureConfig,
    lexicons: DataFrame | None = None,
    name: str = "model",
    buckets: int = crf.BUCKETS,
    c1: float = C1,
    c2: float = C2,
    max_iter: int = MAX_ITERATIONS,
) -> Tagger:
    rows = crf.sequence_rows(tokens, config, lexicons, buckets)
    return Tagger({name: crf.crf_fit(rows, buckets, c1, c2, max_iter)}, config, lexicons)


def train_with_search(
    tokens: DataFrame,
    config: FeatureConfig,
    lexicons: DataFrame | None = None,
    name: str = "model",
    folds: int = CV_FOLDS,
    draws: int = SEARCH_DRAWS,
    max_iter: int = MAX_ITERATIONS,
    buckets: int = crf.BUCKETS,
    seed: int = 0,
    halve: bool = False,
) -> tuple[Tagger, list[tuple[float, float, float]]]:
    """The tagger of the best random draw, and all draws as (c1, c2, score)."""
    rows = crf.sequence_rows(tokens, config, lexicons, buckets)
    found = crf_search.random_search(rows, folds, draws, max_iter, buckets, seed, halve)
    return Tagger({name: found.best}, config, lexicons), found.draws


def validate(tokens: DataFrame, tagger: Tagger, compat: bool = False) -> DataFrame:
    """Entity metrics of a tagger on a table with known tags."""
    return entity_metrics(tagger.tag(tokens, label="ner"), compat=compat)


def file_tokens(tagged: DataFrame) -> DataFrame:
    """Token rows of read files as (doc_id, sent_id, tok_id, …), cut at their end rows."""
    named = tagged.withColumnRenamed("path", "doc_id")
    return sentence_ids(named)


def train_folder(
    spark: SparkSession,
    folder: str,
    config: FeatureConfig,
    lexicons: DataFrame | None = None,
    types: Sequence[str] = (),
    columns: Sequence[str] = ("token", "ner"),
    **options,
) -> tuple[Tagger, DataFrame]:
    """Train on the ``train`` files of a folder and score on its ``test`` files."""
    train_rows, test_rows = (file_tokens(t) for t in read_split_folder(spark, folder, columns))
    if types:
        train_rows, test_rows = (t.withColumn("ner", keep_tag_types("ner", types)) for t in (train_rows, test_rows))
    tagger = train(train_rows, config, lexicons, **options)
    return tagger, validate(test_rows, tagger)


def segment_lines(lines: DataFrame, tagger: Tagger, mode: str = "train") -> DataFrame:
    """(doc_id, sent_id, value): each line cut into words by the tagger."""
    tagged = tagger.tag(char_bilou(lines, mode, packed=True))
    return words_to_lines(rebuild_words(tagged, "pred", packed=True))


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, line_no, value) of text files; a file is a document."""
    return read_lines(spark, path).withColumnRenamed("path", "doc_id")


def segment_file(spark: SparkSession, path: str, tagger: Tagger, out: str, mode: str = "train") -> None:
    """Cut the lines of text files into words and write them in order."""
    write_lines(segment_lines(file_lines(spark, path), tagger, mode), out)


def train_files(
    spark: SparkSession,
    train_path: str,
    test_path: str,
    config: FeatureConfig,
    lexicons: DataFrame | None = None,
    model_path: str | None = None,
    out: str | None = None,
    **options,
) -> tuple[Tagger, DataFrame]:
    """Train on segmented text files and score on others; optionally save the model and the segmented test lines."""
    tagger = train(char_bilou(file_lines(spark, train_path)), config, lexicons, **options)
    if model_path:
        crf.save_model(spark, next(iter(tagger.models.values())), model_path)
    if out:
        segment_file(spark, test_path, tagger, out)
    return tagger, validate(char_bilou(file_lines(spark, test_path)), tagger)


def annotate_texts(docs: DataFrame, tagger: Tagger, sample: int | None = None, seed: int = 0) -> DataFrame:
    """(doc_id, sent_id, tok_id, token, ner, pos) with end rows; ``sample`` annotates that many texts only."""
    picked = docs if sample is None else sample_rows(docs, "doc_id", sample, seed)
    no_pos = F.lit(None).cast("string")
    tokens = with_fields(sentence_tokens(picked, packed=True), {"pos": lambda get: no_pos})
    tagged = with_fields(tagger.tag(tokens), {"ner": lambda get: get("pred"), "pos": lambda get: no_pos})
    return crf.restore_ends(keep_fields(tagged, ["tok_id", "token", "ner", "pos"]))


def record_phrases(
    docs: DataFrame, tagger: Tagger, remap: DataFrame | None = None, sep: str = " "
) -> DataFrame:
    """(doc_id, ner_phrase): the entity map of each text, types corrected by ``remap``."""
    tokens = with_fields(
        sentence_tokens(docs, packed=True), {"ner": lambda get: F.lit(OUTSIDE), "pos": lambda get: F.lit(None).cast("string")}
    )
    phrases = entity_phrases(tagger.tag(tokens), "pred", sep)
    if remap is not None:
        fixed = remap_entities(phrases, remap)
        phrases = fixed.groupBy("doc_id", "entity", "ner").agg(F.sum("cnt").alias("cnt"))
    return phrase_map(phrases)


def annotate_records(
    records: DataFrame,
    tagger: Tagger,
    col: str = CONTENT_COLUMN,
    remap: DataFrame | None = None,
    sep: str = " ",
    keep: Sequence[str] = (),
) -> DataFrame:
    """(keep…, value): every record as a JSON line with the entities of its nested ``content``.

    Records are known by a hash of their text: copies are tagged once, and each
    still gets its own line.
    """
    text = F.col(f"{col}.content")
    known = records.withColumn("_id", F.sha2(text, 256))
    docs = known.select(F.col("_id").alias("doc_id"), text.alias("text")).dropDuplicates(["doc_id"])
    phrases = record_phrases(docs, tagger, remap, sep)
    return enrich_records(known, phrases, col, "_id", keep)
