"""Quoted hits on lines of any length, held against the rule on whole lines."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tagloom.llm import toxicity

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cited_hits(texts):
    """The numbers of plain and of quoted hits that the features of each text tell."""
    found = toxicity._features(toxicity.Matcher(toxicity.Model(["horrid"], [])), pa.array(texts, pa.string()))
    return [tuple(int(x) for x in np.rint(np.expm1(row[[0, 2]]))) for row in found]


def by_rule(text):
    hits = [m for m in WORD.finditer(text or "") if m.group().strip(toxicity.MARKS) == "horrid"]
    cited = sum(toxicity.quoted(text[: m.start()], text[m.end() :]) for m in hits)
    return len(hits) - cited, cited


FILL = "so many words between " * 30


@pytest.mark.parametrize(
    "text, want",
    [
        (f'they wrote "{FILL}horrid {FILL}" there', (0, 1)),
        (f"> {FILL}horrid", (0, 1)),
        (f"they wrote “ {FILL}horrid {FILL}” there", (0, 1)),
        (f'"{FILL}" and horrid and "{FILL}"', (1, 0)),
        (f'"{FILL}\n{FILL}horrid\n{FILL}"', (1, 0)),
        (f"{FILL} > horrid", (1, 0)),
        (" \t> horrid", (0, 1)),
    ],
)
def test_quotation_on_long_lines(text, want):
    assert cited_hits([text]) == [want] == [by_rule(text)]


def test_every_hit_is_judged_on_its_whole_line():
    rng = random.Random(2)
    pieces = ["horrid", "plain words", '"', "“ ", " ”", "„", "«", " » ", "‘ ", "’", ">", "\n", "\n", " é日本 ", " ", "x " * 150]
    texts = [" ".join(rng.choice(pieces) if rng.random() < 0.7 else "horrid" for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += [None, "", "horrid", "\n> horrid\n", '"horrid', 'horrid"']
    assert cited_hits(texts) == [by_rule(t) for t in texts]
    assert sum(x[1] for x in cited_hits(texts)) > 500
