"""Spelling variants: words one edit apart, found through an index of variable-length grams.

*Words.* Runs of letters are counted over all texts, after a rule that plants misspellings by the checksum of document and
run. A checksum of joined strings is the shifted checksum of the first xor that of the second, so NumPy takes it for all runs
of a slice of texts at once, from one value for each document and length and one for each distinct run.

*Dictionary.* It holds the grams of SHORTEST letters, and each longer gram, up to LONGEST, whose beginning, a letter less, occurs
more than once in GRAMS of all occurrences; so there are fewer than GRAMS grams to lengthen. Frequent grams become
longer and rarer, and no list of words grows with a common gram.

*Decomposition.* At each place of a word, between marks of its two ends, stands the longest gram of the dictionary. Whether a
gram is lengthened depends on itself alone, so one edit can only affect the grams that cover its place. The largest number of
these over all places is the word's affected-gram bound, and all other grams of the word also stand in any word one edit away,
as far from the start or one place further.

*Merging.* Each word is listed under its rarest grams, MERGED more than its bound, with place and length; so two words one edit
apart share MERGED lists at least (or as many as the shorter bound leaves). Lists of equal gram, place and length are merged by a
join and counted by pair, and pairs that share enough are verified by edit distance.

Defined cases: null and empty texts have no words; rows that repeat count each; a null id counts as an empty one in the
checksum; of 64 bytes on, runs are checked one by one; an empty table, or one without words that are long and frequent enough,
gives no rows; columns beyond the two named ones are not looked at. Words without near words have no form and are their own root.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.shared import hot_join, row_slices, stored, text_batches
from tagloom.llm.words import byte_codes, span_hashes, text_bytes

#: Words have at least so many letters and occurrences; a form occurs at least FORM_TIMES as often.
LETTERS, OCCURRENCES, FORM_TIMES = 6, 5, 5
#: One in so many runs is misspelt.
PLANTED = 199
#: Gram lengths. A word of LETTERS letters has one gram more than an edit can affect if LONGEST is not above LETTERS.
SHORTEST, LONGEST = 2, 5
#: Fewer grams than this are lengthened; their set goes to every task.
GRAMS = 100_000
#: Lists that two words have to share.
MERGED = 2
START, END = "^", "$"
SLICE_BYTES, RUNS_AT_ONCE, SHORT_BYTES = 4 << 20, 1 << 20, 64
_CODES = byte_codes(fold_case=True)


# ---- words ------------------------------------------------------------------------


def letter_runs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the maximal runs of A-Z, a-z and U+00C0 to U+00FF, which are C3 and one more byte."""
    lower = data | np.uint8(32)
    inside = (lower >= 97) & (lower <= 122) & (data < 128) | (data == 0xC3)
    inside[1:] |= data[:-1] == 0xC3
    filled = bounds[:-1] < bounds[1:]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[bounds[:-1][filled]] = False
    after[bounds[1:][filled] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def _checksum_steps() -> np.ndarray:
    """The checksum's table: what one more zero byte makes of each low byte."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, value >> np.uint32(1) ^ np.uint32(0xEDB88320), value >> np.uint32(1))
    return value


_STEPS = _checksum_steps()


def _without(word: str, place: int) -> str:
    return word[:place] + word[place + 1 :]


def _count_runs(ids: list, data: np.ndarray, bounds: np.ndarray, counts: Counter, least: int, planted: int) -> None:
    """Add the words of at least ``least`` letters to ``counts``."""
    starts, ends = letter_runs(data, bounds)
    letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    keep = letters[ends] - letters[starts] >= least  # a shorter run stays too short
    starts, ends = starts[keep], ends[keep]
    # checksum of each id and colon, followed by 0, 1, 2, … zero bytes
    shifted = np.empty((SHORT_BYTES, len(ids)), np.uint32)
    heads = [f"{'' if i is None else i}:".encode() for i in ids]
    shifted[0] = [zlib.crc32(h) for h in heads]
    for k in range(1, SHORT_BYTES):
        shifted[k] = _STEPS[shifted[k - 1] & np.uint32(255)] ^ (shifted[k - 1] >> np.uint32(8))
    for first in range(0, len(starts), RUNS_AT_ONCE):
        a, b = starts[first : first + RUNS_AT_ONCE], ends[first : first + RUNS_AT_ONCE]
        size, row = b - a, np.searchsorted(bounds, a, side="right") - 1
        _, where, kind = np.unique(span_hashes(data, a, b, _CODES), return_index=True, return_inverse=True)
        words = [bytes(data[a[i] : b[i]]).lower() for i in where]  # of bytes, this is A to Z alone
        own = np.array([zlib.crc32(w) for w in words], np.uint32)
        short = size < SHORT_BYTES
        value = np.zeros(len(a), np.uint32)
        value[short] = shifted[size[short], row[short]] ^ own[kind[short]]
        for i in np.flatnonzero(~short):
            value[i] = zlib.crc32(words[kind[i]], zlib.crc32(heads[row[i]]))
        hit = value % np.uint32(planted) == 0
        names = [w.decode() for w in words]
        for k, n in enumerate(np.bincount(kind[~hit], minlength=len(names)).tolist()):
            if n:
                counts[names[k]] += n
        for i in np.flatnonzero(hit):
            word = names[kind[i]]
            if len(word) > least:
                counts[_without(word, int(value[i]) % len(word))] += 1


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = LETTERS, occurrences: int = OCCURRENCES, planted: int = PLANTED
) -> DataFrame:
    """``word, n`` of all words with at least so many letters and occurrences; see the module's text for what a word is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for part in row_slices(batch, "text", SLICE_BYTES):
                data, bounds = text_bytes(part.column("text"))
                _count_runs(part.column("doc_id").to_pylist(), data, bounds, counts, letters, planted)
                if len(counts) > 200_000:
                    yield flush()
        yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = text_batches(rows).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


# ---- grams ------------------------------------------------------------------------


def frequent_grams(words: DataFrame, grams: int = GRAMS) -> list[str]:
    """The grams of the dictionary that are lengthened: fewer than ``grams``, whatever the number of words."""
    marked = F.concat(F.lit(START), "word", F.lit(END))

    def of_length(q: int):
        return F.transform(F.sequence(F.lit(1), F.length(marked) - q + 1), lambda i: F.substr(marked, i, F.lit(q)))

    found = words.select(F.explode(F.concat(*[of_length(q) for q in range(SHORTEST, LONGEST)])).alias("gram"))
    counted = stored(found.groupBy("gram").agg(F.count("*").alias("f")), "grams")
    total = counted.agg(F.sum("f")).first()[0] or 0
    return [r.gram for r in counted.where(F.col("f") * grams > total).collect()]


def decompose(word: str, lengthened: frozenset[str] | set[str]) -> tuple[list[str], int]:
    """The gram at each place of the marked word, and how many of them one edit can affect."""
    marked = f"{START}{word}{END}"
    end = len(marked)
    grams = []
    change = [0] * (end + 1)
    for p in range(end - SHORTEST + 1):
        q = SHORTEST
        while q < LONGEST and p + q < end and marked[p : p + q] in lengthened:
            q += 1
        grams.append(marked[p : p + q])
        change[p] += 1
        change[p + q] -= 1
    most = covering = change[0]
    for p in range(1, end):  # an edit is behind the first mark and not behind the last
        covering += change[p]
        most = max(most, covering)
    return grams, most


_ENTRY = "word string, n long, len int, gram string, place int, listed int, shared int"


def gram_entries(words: DataFrame, lengthened: list[str], merged: int = MERGED) -> DataFrame:
    """A row for each gram of each word: ``listed`` of a word's rows are to be indexed, and ``shared`` lists are asked of a partner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frozenset(lengthened)
        for batch in batches:
            for part in row_slices(batch, "word", 1 << 16):
                rows = []
                for word, n in zip(part.column("word").to_pylist(), part.column("n").to_pylist()):
                    grams, affected = decompose(word, known)
                    shared = min(merged, len(grams) - affected)
                    rows += [(word, n, len(word), g, p, affected + shared, shared) for p, g in enumerate(grams)]
                kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32()]
                columns = zip(*rows) if rows else [[]] * 7
                names = ["word", "n", "len", "gram", "place", "listed", "shared"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return words.select("word", "n").mapInArrow(run, _ENTRY)


def near_pairs(words: DataFrame, grams: int = GRAMS, merged: int = MERGED) -> DataFrame:
    """``word, n, other, other_n``, each pair of ``word, n`` that is one edit apart once; words have LETTERS letters at least."""
    entries = stored(gram_entries(words, frequent_grams(words, grams), merged), "entries")
    frequency = stored(entries.groupBy("gram").agg(F.count("*").alias("f")), "frequency")
    ranked = hot_join(entries, frequency, "gram", "f")
    rank = F.row_number().over(Window.partitionBy("word").orderBy("f", "gram", "place"))  # as many rows as the word has letters
    index = stored(ranked.withColumn("rank", rank).where("rank <= listed").select("word", "n", "len", "gram", "place", "shared"), "index")

    # a partner as long has the gram at the same place, one a letter longer there or one place further on
    step = [F.struct(F.lit(longer).alias("longer"), F.lit(further).alias("further")) for longer, further in ((0, 0), (1, 0), (1, 1))]
    probes = index.withColumn("step", F.explode(F.array(*step))).select(
        "word", "n", "gram", (F.col("len") + F.col("step.longer")).alias("len"), (F.col("place") + F.col("step.further")).alias("place"),
        F.col("step.longer").alias("longer"), F.col("shared").alias("asked"),
    )
    lists = index.select(F.col("word").alias("other"), F.col("n").alias("other_n"), "gram", "len", "place", "shared")
    met = probes.join(lists.hint("merge"), ["gram", "len", "place"]).where((F.col("longer") == 1) | (F.col("word") < F.col("other")))
    counted = met.groupBy("word", "other").agg(
        F.count("*").alias("lists"), F.min(F.least("asked", "shared")).alias("enough"), F.first("n").alias("n"), F.first("other_n").alias("other_n")
    )
    near = counted.where(F.col("lists") >= F.col("enough")).where(F.levenshtein("word", "other", 1) == 1)
    return near.select("word", "n", "other", "other_n")


# ---- forms ------------------------------------------------------------------------


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form``: the end of each chain. A step doubles the way that is known."""
    known = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = known.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = stored(known.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        known = new.select("word", "root")
        if new.where("moved").isEmpty():
            return known


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", times: int = FORM_TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of all words of ``docs``."""
    words = stored(word_counts(docs, id_col, text_col), "words")
    pairs = stored(near_pairs(words), "pairs")
    both = pairs.union(pairs.select("other", "other_n", "word", "n"))
    best = F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("other").alias("form"), F.col("other_n").alias("form_n")))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"), F.first("n").alias("own"))
    taken = F.col("best.form_n") >= times * F.col("own")
    near = near.select("word", "n_near", F.when(taken, F.col("best.form")).alias("form"), F.when(taken, F.col("best.form_n")).alias("form_n"))
    near = stored(near, "near")
    roots = _roots(near.where(F.col("form").isNotNull()))
    return words.join(near, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"
    )
