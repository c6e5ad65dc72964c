"""Spelling variants against brute force, and the gram index by its own promises."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import no_docs, odd_docs, rows_of

from tagloom.llm import spelling as sp
from tagloom.llm.words import text_bytes


def fold(word):
    return re.sub("[A-Z]", lambda m: m[0].lower(), word)


def plain_counts(rows, letters=6, occurrences=5, planted=199):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = fold(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % planted == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= letters and n >= occurrences}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(out, key=str)


def varied(rng, word, letters="abcdefghé"):
    for _ in range(rng.randint(0, 2)):
        i, kind = rng.randint(0, len(word)), rng.randint(0, 2)
        word = word[:i] + (rng.choice(letters) if kind < 2 else "") + word[i + (kind > 0) :]
    return word


def vocabulary(seed, stems=25, copies=8, letters="abcdefghé"):
    rng = random.Random(seed)
    words = set()
    for _ in range(stems):
        stem = "".join(rng.choice(letters) for _ in range(rng.randint(5, 12)))
        stem = rng.choice(["", "inter", "aaaaa"]) + stem + rng.choice(["", "ation", "aaaa"])
        words |= {varied(rng, stem, letters) for _ in range(copies)}
    return sorted(w for w in words if len(w) >= sp.LETTERS)


@pytest.mark.parametrize(("seed", "planted"), [(1, 199), (2, 3), (3, 1)])
def test_counts(spark, seed, planted):
    rng = random.Random(seed)
    words = [*vocabulary(seed), "Hello", "ÀÉÎ×÷ÿ", "ĀbcdefgĀ", "x" * 70, "É" * 40, "naïveté", "STRASSE", "straße", "a1bcdefg"]
    texts = [" ".join(rng.choice([w, w.upper(), w + ",", "(" + w]) for w in rng.choices(words, k=rng.randint(0, 300))) for _ in range(40)]
    rows = [(i * 7 - 9, t) for i, t in enumerate(texts)] + [(None, texts[5]), (3, None), (4, ""), (5, "日本語" + words[0] * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.word: r.n for r in sp.word_counts(df, planted=planted).collect()}
    assert got == plain_counts(rows, planted=planted) and len(got) > 20


def test_runs_at_row_ends():
    texts = ["abc", None, "def", "", "é", "é", " x ", "Ðð", "ab日cd", "x×y÷z", "¿qĀr"]
    data, bounds = text_bytes(pa.array(texts))
    starts, ends = sp.letter_runs(data, bounds)
    found = [bytes(data[a:b]).decode() for a, b in zip(starts, ends)]
    assert found == [r for t in texts for r in re.findall("[A-Za-zÀ-ÿ]+", t or "")]
    assert [a.size for a in sp.letter_runs(*text_bytes(pa.array([], pa.string())))] == [0, 0]


def test_an_edit_leaves_what_the_bound_says():
    rng = random.Random(4)
    words = vocabulary(5, 40)
    grams = Counter(f"^{w}$"[p : p + q] for w in words for q in range(2, 5) for p in range(len(w) + 2 - q + 1))
    for least in (1, 3, 10, 10**9):
        known = {g for g, n in grams.items() if n > least}
        for _ in range(3000):
            a, b = rng.choice(words), None
            while b is None or not one_edit(a, b):
                b = varied(rng, a)
            if len(a) > len(b):
                a, b = b, a
            (ga, na), (gb, nb) = sp.decompose(a, known), sp.decompose(b, known)
            shifts = (0, 1) if len(b) > len(a) else (0,)
            kept_a = sum(any(p + d < len(gb) and gb[p + d] == g for d in shifts) for p, g in enumerate(ga))
            kept_b = sum(any(p >= d and p - d < len(ga) and ga[p - d] == g for d in shifts) for p, g in enumerate(gb))
            assert kept_a >= len(ga) - na and kept_b >= len(gb) - nb
            assert len(a) < sp.LETTERS or len(ga) - na >= 1


@pytest.mark.parametrize(("seed", "grams", "merged"), [(1, 100_000, 2), (2, 30, 2), (3, 200, 1), (4, 5, 3)])
def test_pairs_equal_brute_force(spark, seed, grams, merged):
    words = vocabulary(seed, 40)
    df = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n long").repartition(5)
    got = sorted(tuple(sorted((r.word, r.other))) for r in sp.near_pairs(df, grams, merged).collect())
    want = sorted((a, b) for i, a in enumerate(words) for b in words[i + 1 :] if one_edit(a, b))
    assert got == want and len(want) > 30


def test_variants(spark):
    rng = random.Random(8)
    words = vocabulary(9, 20)
    use = {w: rng.choice([1, 4, 5, 6, 25, 26, 130, 700]) for w in words}
    use |= {"wonderful": 700, "wonderfull": 140, "wonderfulll": 28, "wondrful": 5, "lonelyword": 9, "tiesone": 5, "tiestwo": 30, "bottler": 6, "bottles": 40, "bottled": 40}
    texts = [" ".join([w] * n) for w, n in use.items()]
    rows = list(enumerate(texts))
    got = rows_of(sp.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    assert got == plain_variants(plain_counts(rows))
    by_word = {g[0]: g for g in got}
    assert by_word["bottler"][1] == "bottled"
    assert any(g[1] and g[1] != g[2] for g in got)  # a chain


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert rows_of(sp.spelling_variants(docs)) == plain_variants(plain_counts(rows))
    none = sp.spelling_variants(no_docs(spark))
    assert none.columns == ["word", "form", "root", "n", "n_near", "form_n"] and none.count() == 0


def test_long_word(spark):
    long = "x" * 30_000
    rows = [(1, " ".join([long] * 6 + [long + "y"] * 30)), (2, "ab" * 15_000 + " short " * 9)]
    got = rows_of(sp.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")))
    want = plain_counts(rows)
    assert {g[0]: g[3] for g in got} == want
    assert [g[1] for g in got if g[0] == long] == ([long + "y"] if long in want and long + "y" in want else [])


def test_checksum_shift():
    for word in (b"", b"a", b"word", "é".encode()):
        for head in (b"1:", b":", b"-99:"):
            value = np.array([zlib.crc32(head)], np.uint32)
            for _ in word:
                value = sp._STEPS[value & np.uint32(255)] ^ (value >> np.uint32(8))
            assert int(value[0]) ^ zlib.crc32(word) == zlib.crc32(head + word)
