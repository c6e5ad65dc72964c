"""Unseen identifiers of each kind, in shapes that only the patterns of known ones give away."""

import random

import pytest
from llm_cases import sentence

from tagloom.llm import pii


def with_luhn(digits):
    """``digits`` and the digit that makes the sum right."""
    doubled = [int(c) * (2 - k % 2) for k, c in enumerate(reversed(digits))]
    return digits + str(-sum(d - 9 * (d > 9) for d in doubled) % 10)


def card(k, mark):
    digits = with_luhn(f"41111111111{k:04d}")
    return mark.join(digits[i : i + 4] for i in range(0, 16, 4))


CASES = {
    "email": ([f"user{k}@mail{k}.example.org" for k in range(8)], "bob.smith [at] corp [dot] example", None),
    "ip": ([f"10.20.30.{k}" for k in range(8)], "2001:db8:0:0:8a2e:0:370:7334", "2001:db8:0:0:8a2e:0:370:7334:1"),
    "card": ([card(k, " ") for k in range(8)], card(77, "."), card(77, ".")[:-1] + str((int(card(77, ".")[-1]) + 1) % 10)),
    "phone": ([f"+1 988 555 24{k}0" for k in range(10, 18)], "(988) 555-2999", None),
}


@pytest.mark.parametrize("kind", CASES)
def test_patterns_find_each_kind(spark, kind):
    seeds, unseen, wrong = CASES[kind]
    rng = random.Random(7)
    texts = [f"{sentence(rng, 6)} my own {x} {sentence(rng, 3)}" for x in seeds]
    texts += [f"{sentence(rng, 6)} my own {unseen} thanks", f"{sentence(rng, 6)} my own {wrong or 'none'} thanks"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    assert all(got[k][f"n_{kind}"] == 1 and got[k].n_added == 0 for k in range(8))
    start = texts[8].index(unseen)
    assert got[8].spans == f"{kind}:{start}:{start + len(unseen)}" and got[8].n_added == 1 and got[8][f"n_{kind}"] == 0
    assert got[9].n_added == 0 and got[9].spans == ""
