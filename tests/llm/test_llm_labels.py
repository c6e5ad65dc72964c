"""Toxicity by held-out accuracy and plain edit distances; personal data against plain patterns and planted contexts."""

import random
import re
import zlib

import pytest
from llm_cases import no_docs, odd_docs, odd_texts, sentence, sha

from tagloom.llm import pii, toxicity

LABELS = "doc_id long, quality int, toxic int"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(8)
    terms = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(4, 7))) for _ in range(12)})
    machine = toxicity.Automaton(terms, [])
    for _ in range(4000):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 9)))
        near = [(d, t) for t in terms if (d := distance(word, t)) <= (len(t) >= toxicity.FUZZY_FROM)]
        found = machine.match(word)
        assert (found and (found[1], found[0])) == (min(near) if near else None)


def test_automaton_stems():
    machine = toxicity.Automaton(["horrid"], ["stemm"])
    assert machine.match("stemmings") == ("stemm", 0) and machine.match("stem") is None
    assert machine.match("horid") == ("horrid", 1) and machine.match("horrids") == ("horrid", 1) and machine.match("hrrds") is None


def test_terms_and_stems():
    counts = {"nast": 50, "nasty": 50, "nasty$": 49, "grub": 40, "gruba": 12, "grubb": 20, "grubbe$": 9}
    assert toxicity.choose_terms(counts) == (["nasty"], ["grub"])


@pytest.mark.parametrize(
    "left, right, want",
    [('they wrote "you ', ' person" to me', True), ("you ", " person", False), ('"a" and ', ' "b"', False), ("“the ", "”", True), ("> the ", "", True), ('"\nthe ', '"', False), ("«la ", " »", True)],
)
def test_quotation(left, right, want):
    assert toxicity.quoted(left, right) is want


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(700):
        words = sentence(rng, 60).split()
        toxic = i % 4 == 0
        if toxic:
            for bad in rng.sample(["horrid", "dreadful", "vilest", "grubbig", "grubbem", "grubbung"], 3):
                words[rng.randrange(60)] = bad
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(labels, LABELS), {i: t for i, _, t in labels}


@pytest.fixture(scope="module")
def model(corpus):
    return toxicity.train(corpus[0], corpus[1])


def test_held_out_accuracy(corpus, model):
    got = toxicity.score(corpus[0], model).collect()
    assert len(got) == 700 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 80 and sum(r.predicted == corpus[2][r.doc_id] for r in held) >= 0.98 * len(held)
    assert {"horrid", "dreadful", "vilest"} <= set(model.terms) and any(s.startswith("grubb") for s in model.stems)


def test_held_out_labels_teach_nothing(spark, corpus, model):
    flipped = [(i, 1, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in corpus[2].items()]
    assert toxicity.train(corpus[0], spark.createDataFrame(flipped, LABELS)) == model


def test_misspelled_and_quoted(spark, model):
    plain = sentence(random.Random(5), 40)
    texts = [plain, f"{plain} horrid dreadful vilest", f"{plain} horrod dredful vilestt {plain} drexdful horrit", f'{plain} they wrote "horrid dreadful vilest" there']
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert got[0] < 0.5 < got[1] and got[2] > got[0] and got[3] < got[1]


def test_toxicity_edges(spark, model):
    docs = odd_docs(spark)
    got = toxicity.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    none = spark.createDataFrame([], LABELS)
    blank = toxicity.train(docs, none)
    assert all(r.score == 0 and r.predicted == 0 for r in toxicity.score(docs, blank).collect())
    assert toxicity.score(no_docs(spark), model).count() == 0
    labels = spark.createDataFrame([(None, 1, 1), (4, None, None), (7, 1, 1), (7, 1, 0)], LABELS)
    left = toxicity.drop_toxic(docs, labels)
    assert left.schema == docs.schema and left.count() == docs.count()


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in BASE.items() for m in re.finditer(p, text or "") if passes(k, m.group())]


def personal_texts():
    rng = random.Random(5)
    texts = [
        "a@b.c._d@e.f x@y z@@q.r", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4 000256.1.1.1", "+1 (988) 555-2485 +12 +123456789 +1234567890123456",
        "4111 1111 1111 1111 and 4111-1111-1111-1111 5 41111111111111112222 4111  1111", "é😀 a@b.co 1.1.1.1 é a@b.co",
        "1" * 20_000 + " " + "1." * 5000 + " " + "a" * 50_000 + "@b" + ".c" * 3000,
    ]
    return texts + ["".join(rng.choice("12345.@ab+- ()_é") for _ in range(rng.randint(0, 80))) for _ in range(800)]


def test_base_spans(spark):
    docs = odd_docs(spark, texts=odd_texts() + personal_texts())
    got = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    for row in docs.collect():
        want, found = plain_spans(row.text), got[row.doc_id]
        assert found.base_sha256 == sha(",".join(want))
        assert [found[f"n_{k}"] for k in BASE] == [sum(w.startswith(k) for w in want) for k in BASE]
        assert set(want) <= set(found.spans.split(",")) or not want
    assert pii.personal_data(no_docs(spark)).count() == 0


def test_patterns_find_unseen_identifiers(spark):
    rng = random.Random(3)
    texts = [f"{sentence(rng, 8)} Reach me at user{k}@mail{k}.example.org {sentence(rng, 5)}" for k in range(8)]
    hidden = f"{sentence(rng, 6)} reach me at bob.smith [at] corp [dot] example thanks"
    other = f"{sentence(rng, 6)} nothing here bob.miller [at] corp [dot] example thanks"
    again = f"{sentence(rng, 3)} so then bob.smith [at] corp [dot] example it is"
    docs = spark.createDataFrame(list(enumerate([*texts, hidden, other, again])), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    start = hidden.index("bob.smith")
    assert got[8].spans == f"email:{start}:{start + len('bob.smith [at] corp [dot] example')}" and got[8].n_email == 0 and got[8].n_added == 1
    assert got[9].n_added == 0 and got[9].spans == ""
    assert got[10].n_added == 1  # the same identifier where no pattern stands
    assert all(got[k].n_email == 1 and got[k].n_added == 0 for k in range(8))


def test_personal_data_runs_no_python(spark):
    plan = pii.personal_data(odd_docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_a_lexicon_of_thousands_of_terms(spark):
    """No bound but the sample: rare terms, and those of three letters, are learned too."""
    rng = random.Random(21)
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    terms = sorted({"".join(rng.choice(alphabet) for _ in range(9)) for _ in range(5000)}) + ["zqx", "xzj"]
    rows = []
    for i in range(3000):
        words = [f"word{rng.randint(0, 300)}" for _ in range(40)]
        if i % 2:
            words += rng.sample(terms, 140) + [rng.choice(["zqx", "xzj"])]
            rng.shuffle(words)
        rows.append((i, " ".join(words), 1, i % 2))
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int").repartition(8)
    model = toxicity.train(table.select("doc_id", "text"), table.drop("text"))
    machine = toxicity.Automaton(model.terms, model.stems)
    missed = [t for t in terms if not machine.match(t)]
    assert len(missed) <= 0.02 * len(terms) and not {"zqx", "xzj"} & set(missed)
    assert machine.match("word17") is None
