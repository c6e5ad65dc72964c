"""The near-copy stage of the pipeline against brute force."""

import random
import re

from llm_cases import SPACE, fold, rows_of, sentence

import corpus_pipeline
from tagloom.llm import minmax_dedup


def kept_by_force(rows, percent):
    """The ids of ``doc_id, text`` that stay when each group of near copies keeps its smallest id."""
    sets = {}
    for i, t in rows:
        words = re.findall(SPACE, fold(t))
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    return {i for i, r in root.items() if i == r}


def near_texts():
    """Pairs whose second text has one to nine words changed: similarities from 0.63 to 0.95."""
    rng = random.Random(12)
    rows = []
    for n in range(45):
        words = sentence(rng, 200).split()
        other = words.copy()
        for k in range(1 + n % 9):
            other[20 * k + 9] = f"c{n}x{k}"
        rows += [(2 * n, " ".join(words)), (2 * n + 1, " ".join(other))]
    return rows


def test_near_stage_drops_from_80_percent(spark):
    rows = near_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = kept_by_force(rows, 80)
    assert len(want) < len(kept_by_force(rows, 85)) < len(rows)
    assert rows_of(corpus_pipeline.remove_near_copies(spark, docs, "")) == sorted(((i, t) for i, t in rows if i in want), key=str)


def test_near_groups_take_85_percent_unless_told(spark):
    rows = near_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in minmax_dedup.near_groups(docs).collect() if r.kept} == kept_by_force(rows, 85)


def test_bands_follow_the_similarity():
    assert minmax_dedup.band_count(85) == 20
    for percent in (50, 80, 85, 95):
        assert (1 - (percent / 100) ** minmax_dedup.BAND) ** minmax_dedup.band_count(percent) <= minmax_dedup.MISSED
