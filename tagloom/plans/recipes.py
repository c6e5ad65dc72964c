"""Corpus recipes: compositions of operators."""

from __future__ import annotations

from collections.abc import Sequence

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.constants import COMPANY_TYPES
from tagloom.functions.text import remove_punc, replace_map, title_case
from tagloom.operators import aggregates as ag
from tagloom.operators import columns as co
from tagloom.operators.joins import join_inner
from tagloom.operators.ranking import sample_rows
from tagloom.operators.tokens import sentence_tokens


def titled_names(raw: DataFrame) -> DataFrame:
    """(entity_types, entity_names) from (category, nname_en), names in title case."""
    df = co.rename(co.rename(raw, "category", "entity_types"), "nname_en", "entity_names")
    return df.withColumn("entity_names", title_case("entity_names"))


def typed_titles(
    raw: DataFrame,
    language: tuple[str, str] = ("Language", "en"),
    title: str = "Title",
    kind: str = "Type",
    cases: Sequence[tuple[str, str]] = (("Personal", "PERSON"), ("Location", "GPE"), ("Organisation", "ORG")),
) -> DataFrame:
    """(entity_name, entity_type) of the titles in one language whose type names a known class."""
    kept = co.filter_regex(co.filter_eq(raw, *language), kind, "|".join(text for text, _ in cases))
    typed = kept.withColumn("entity_type", co.case_contains(kind, cases, "MISC"))
    return co.rename(typed, title, "entity_name").drop(language[0], kind)


def short_names(
    types: DataFrame,
    names: DataFrame,
    on: str,
    labels: Sequence[str] = COMPANY_TYPES,
    keep: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """One-word and many-word (new_entity_type, short_name) from entity types and short names."""
    joined = join_inner(types, names, on)
    mapped = joined.withColumn("new_entity_type", co.remap_labels("entity_type", labels, "ORG"))
    out = mapped.select(*keep, "new_entity_type", "short_name")
    return co.filter_words(out, "short_name", multi=False), co.filter_words(out, "short_name", multi=True)


def institute_acronyms(
    institutes: DataFrame, dropped: Sequence[str] = ("redirected", "obsolete")
) -> DataFrame:
    """Distinct one-word acronyms of live institutes, in order."""
    rows = institutes.select(F.explode("institutes").alias("i"))
    return co.nested_words(co.filter_not_in(rows, "i.status", dropped), "i.acronyms", is_array=True)


def company_names(companies: DataFrame) -> DataFrame:
    return co.nested_words(companies, "company_info.company_details.name", is_array=False)


def term_table(docs: DataFrame, text: Column | str = "text") -> DataFrame:
    """(word, tf, df) of cleaned texts."""
    return ag.term_frequencies(docs, remove_punc(text))


def titled_lines(lines: DataFrame) -> DataFrame:
    return co.filter_min_length(lines, "value").withColumn("value", title_case("value"))


def news_tokens(docs: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """Tokens of ``k`` sampled texts without nulls and line breaks."""
    cleaned = docs.dropna().withColumn("text", replace_map("text", {"\n": " ", "\t": " "}))
    return sentence_tokens(sample_rows(cleaned, "doc_id", k, seed))


def enrich_records(
    records: DataFrame, phrases: DataFrame, col: str, id_col: str = "doc_id", keep: Sequence[str] = ()
) -> DataFrame:
    """(keep…, value): each record as a JSON line with ``ner_phrase`` inside its nested column.

    ``phrases`` is (doc_id, ner_phrase). A top-level ``content`` copy is left out;
    the nested one stays, and so do all columns but a helper id that starts with
    an underscore. A record without entities gets an empty map.
    """
    empty = F.create_map().cast("map<string, array<string>>")
    found = phrases.select(F.col("doc_id").alias("_found"), "ner_phrase")
    joined = records.join(found, F.col(id_col) == F.col("_found"), "left")
    nested = F.col(col).withField("ner_phrase", F.coalesce("ner_phrase", empty))
    names = [c for c in records.columns if c != "content" and not c.startswith("_")]
    return joined.withColumn(col, nested).select(*keep, F.to_json(F.struct(*names)).alias("value"))
