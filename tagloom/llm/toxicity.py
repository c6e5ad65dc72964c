"""Toxicity of texts: a lexicon trie met with Levenshtein automata, and scores over context windows.

**Lexicon.** Labelled documents give words and word stems that toxic documents hold and others don't. Spark counts
documents by prefix; the driver gets the few prefixes that pass and keeps the longest of each chain.

**Matching.** Words are deduplicated by hash inside a slice of texts; each new word runs through one automaton: the
intersection of the trie with the Levenshtein automata of the word, determinised as far as words need it. Terms match
with one edit (from five letters on), stems exactly. Misspelled forms that clean labelled documents hold are left out.

**Score.** A hit inside quotation marks, or on a line quoted with ``>``, counts a quarter; its whole line is judged. The weights of hits are summed
over the document and over windows of 50 words; a logistic regression on these sums gives the score. The
lexicon comes from seven tenths of the labelled sample and the regression from the rest.

Labels are learned from a sample of at most ``SAMPLE`` labelled rows, chosen by a hash; of texts that share the
least value of one of three shingle permutations, near copies as a rule, one is an example, so copies lend no support. Rows whose
crc32(id) mod 5 is 0 are held out and never learned from. Nothing but the text goes into a score.

Defined cases: null and empty texts have no hits and get the score of a text without hits; without labels of both kinds
every score is 0; a label that repeats counts as toxic if any of its rows does; null labels are left out; rows that repeat
are scored each; the texts of a repeated id are examples each; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.shared import hashed_sample, row_slices, stored, text_batches
from tagloom.llm.words import byte_codes, rolling, span_hashes, text_bytes, word_spans

#: Bound of the labelled rows that are learned from.
SAMPLE = 20_000
#: Letters of a term or stem, and of those that may be misspelled. A prefix counts if it is in so many toxic examples and has
#: such log odds for them; the lexicon holds all that do, and the sample bounds it.
SHORTEST, LONGEST, FUZZY_FROM = 3, 24, 5
LEAST_DOCS, LEAST_ODDS, CHAIN = 4, 3.0, 0.7
WINDOW = 50
SHINGLE = 5
FUZZY_WEIGHT, QUOTED_WEIGHT = 0.5, 0.25
HELD_PREFIXES = 200_000
#: Marks beyond ASCII that stick to words.
MARKS = "“”«»„‘’…–—¿¡"
CACHE_WORDS = 2_000_000
SLICE_BYTES = 4 << 20
STATES = 100_000
_CODES = byte_codes(bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)), fold_case=True)
_PAIRS = {"“": "”", "«": "»", "„": "“", "‘": "’"}
FEATURES = 5


class Automaton:
    """Trie of terms and stems, run on words with at most one edit for the terms that are long enough."""

    def __init__(self, terms: list[str], stems: list[str]) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.stem: list[str | None] = [None]
        self.fuzzy: list[bool] = [False]  # a node on the way to a term that may be misspelled
        for word, ends in [(t, self.term) for t in terms] + [(s, self.stem) for s in stems]:
            node = 0
            for c in word:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(None), self.stem.append(None), self.fuzzy.append(False)
                node = self.children[node][c]
                self.fuzzy[node] |= ends is self.term and len(word) >= FUZZY_FROM
            ends[node] = word
        self.start = ((0, 0),)
        self.steps: dict[tuple, dict[str, tuple]] = {}
        self.made = 0

    def _step(self, state: tuple, c: str) -> tuple:
        to: dict[int, int] = {}

        def put(node: int, edits: int) -> None:
            if not edits or self.fuzzy[node] or node == 0:
                to[node] = min(edits, to.get(node, edits))

        for node, edits in state:
            nexts = self.children[node]
            if c in nexts:
                put(nexts[c], edits)
            if not edits:
                put(node, 1)  # a letter too many
                for child in nexts.values():
                    put(child, 1)  # another letter
                    if c in self.children[child]:
                        put(self.children[child][c], 1)  # a letter left out
        return tuple(sorted(to.items()))

    def match(self, word: str) -> tuple[str, int] | None:
        """The term or stem and the number of edits, the fewest there are."""
        if self.made > STATES:
            self.steps.clear()
            self.made = 0
        state = self.start
        for c in word:
            nexts = self.steps.setdefault(state, {})
            to = nexts.get(c)
            if to is None:
                to = nexts[c] = self._step(state, c)
                self.made += 1
            state = to
            if not state:
                return None
            for node, edits in state:
                if not edits and self.stem[node]:
                    return self.stem[node], 0
        best = None
        for node, edits in state:
            if self.term[node] and (not edits or len(self.term[node]) >= FUZZY_FROM):
                best = min(best or (9, ""), (edits, self.term[node]))
            elif not edits:  # the last letter left out
                for child in self.children[node].values():
                    if self.term[child] and len(self.term[child]) >= FUZZY_FROM:
                        best = min(best or (9, ""), (1, self.term[child]))
        return (best[1], best[0]) if best else None


@dataclass
class Model:
    terms: list[str]
    stems: list[str]
    harmless: frozenset[str] = frozenset()
    weights: list[float] = field(default_factory=lambda: [0.0] * FEATURES)
    bias: float = -math.inf


class Matcher:
    """The kind of each word of a text: 0 none, 1 a term or stem, 2 a misspelled term."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.automaton = Automaton(model.terms, model.stems)
        self.keys, self.kinds = np.empty(0, np.uint64), np.empty(0, np.int8)

    def kind(self, word: str) -> int:
        word = word.lower().strip(MARKS)
        found = self.automaton.match(word) if len(word) >= SHORTEST else None
        if found is None or (found[1] and word in self.model.harmless):
            return 0
        return 1 + (found[1] > 0)

    def of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        hashes = span_hashes(data, starts, ends, _CODES)
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > CACHE_WORDS:
            self.keys, self.kinds = np.empty(0, np.uint64), np.empty(0, np.int8)
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            kinds = [self.kind(bytes(data[starts[i] : ends[i]]).decode("utf-8", "replace")) for i in first[new]]
            self.keys, self.kinds = np.insert(self.keys, at[new], keys[new]), np.insert(self.kinds, at[new], np.array(kinds, np.int8))
            at = np.searchsorted(self.keys, keys)
        return self.kinds[at][inverse]


def quoted(left: str, right: str) -> bool:
    """Whether the place between the two strings, a line at most, stands in quotation marks or on a quoted line."""
    left, right = left.rpartition("\n")[2], right.partition("\n")[0]
    if left.lstrip().startswith(">"):
        return True
    if left.count('"') % 2 and '"' in right:
        return True
    return any(left.rfind(a) > left.rfind(b) and b in right for a, b in _PAIRS.items())


def _places(data: np.ndarray, mark: str) -> np.ndarray:
    """Where ``mark`` starts in UTF-8 bytes."""
    code = mark.encode()
    at = np.flatnonzero(data[: len(data) - len(code) + 1] == code[0])
    for k in range(1, len(code)):
        at = at[data[at + k] == code[k]]
    return at


def _cited(data: np.ndarray, low: np.ndarray, high: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """:func:`quoted` for the places ``starts`` to ``ends`` of the rows ``low`` to ``high``, each on its whole line.

    Marks are located once for all places and looked up by bisection, so a long line costs no more than its bytes.
    """
    breaks = _places(data, "\n")
    edges = np.concatenate([[-1], breaks, [len(data)]])
    first = np.maximum(low, edges[np.searchsorted(breaks, starts)] + 1)
    last = np.minimum(high, edges[np.searchsorted(breaks, ends) + 1])

    def between(marks: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.searchsorted(marks, b) - np.searchsorted(marks, a)

    def latest(marks: np.ndarray) -> np.ndarray:
        """The last mark on the line before each place, or -1."""
        at = np.append(-1, marks)[np.searchsorted(marks, starts)]
        return np.where(at >= first, at, -1)

    marks = _places(data, '"')
    cited = (between(marks, first, starts) % 2 == 1) & (between(marks, ends, last) > 0)
    for a, b in _PAIRS.items():
        closing = _places(data, b)
        cited |= (latest(_places(data, a)) > latest(closing)) & (between(closing, ends, last) > 0)
    marks = _places(data, ">")
    lines, line = np.unique(first, return_inverse=True)
    sign = np.append(marks, len(data))[np.searchsorted(marks, lines)]  # the first '>' behind each line's start
    inside = sign[line] < starts
    for k in np.unique(line[inside]):
        if data[lines[k] : sign[k]].tobytes().decode("utf-8", "ignore").strip():
            sign[k] = len(data)
    return cited | (sign[line] < starts)


def _features(matcher: Matcher, column: pa.Array) -> np.ndarray:
    """FEATURES columns for each row: hits, misspelled hits, quoted ones, the best window, the share of words."""
    data, bounds = text_bytes(column)
    starts, ends, words = word_spans(data, bounds, _CODES)
    rows = len(bounds) - 1
    out = np.zeros((rows, FEATURES))
    kinds = matcher.of(data, starts, ends)
    hits = np.flatnonzero(kinds)
    if not len(hits):
        return out
    row = np.searchsorted(words, hits, side="right") - 1
    cited = _cited(data, bounds[row], bounds[row + 1], starts[hits], ends[hits])
    loose = kinds[hits] == 2
    weight = np.where(loose, FUZZY_WEIGHT, 1.0) * np.where(cited, QUOTED_WEIGHT, 1.0)
    np.add.at(out[:, 0], row[~loose & ~cited], 1)
    np.add.at(out[:, 1], row[loose & ~cited], 1)
    np.add.at(out[:, 2], row[cited], 1)
    # windows that end at a hit: the hits of the same row that are less than WINDOW words before it
    low = np.searchsorted(hits, np.maximum(hits - WINDOW + 1, words[row]))
    sums = np.append(0, np.cumsum(weight))
    np.maximum.at(out[:, 3], row, sums[np.arange(len(hits)) + 1] - sums[low])
    np.add.at(out[:, 4], row, weight)
    out[:, 4] /= np.maximum(1, np.diff(words))
    out[:, :4] = np.log1p(out[:, :4])
    out[:, 4] = np.minimum(1, 20 * out[:, 4])
    return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sample(labels: DataFrame, size: int) -> DataFrame:
    """At most ``size`` labelled rows that are not held out."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    rows = rows.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return hashed_sample(rows, size)


def _least_shingles(examples: DataFrame) -> DataFrame:
    """``key`` and the least values of three permutations of each text's shingles."""
    factors = np.random.default_rng(13).integers(0, 1 << 63, 3, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = np.zeros((batch.num_rows, 3), np.int64)
            for i in range(batch.num_rows):
                data, bounds = text_bytes(batch.column("text").slice(i, 1))
                starts, ends, _ = word_spans(data, bounds, _CODES)
                hashes = span_hashes(data, starts, ends, _CODES)
                runs = rolling(hashes, SHINGLE) if len(hashes) >= SHINGLE else hashes
                if len(runs):
                    least[i] = [(runs * f).min().astype(np.int64) for f in factors]
            columns = [batch.column("key"), *(pa.array(least[:, k]) for k in range(3))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "a", "b", "c"])

    return examples.select("key", "text").mapInArrow(run, "key long, a long, b long, c long")


def _examples(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """``text, toxic, use`` of the sample, one of each group of near copies; use 0: lexicon, 1: regression."""
    found = text_batches(docs).join(F.broadcast(_sample(labels, sample)), "doc_id")  # at most ``sample`` rows are broadcast
    found = stored(found.withColumn("key", F.monotonically_increasing_id()), "examples")
    seen: set[tuple[str, int]] = set()
    kept = []
    for row in sorted(_least_shingles(found).collect()):  # at most a row for each labelled text
        marks = {("a", row.a), ("b", row.b), ("c", row.c)}
        if not marks & seen:
            kept.append((row.key,))
        seen |= marks
    kept = docs.sparkSession.createDataFrame(kept, "key long")
    use = F.when(F.pmod(F.xxhash64("doc_id", "text"), F.lit(10)) < 7, 0).otherwise(1)
    return found.join(F.broadcast(kept), "key").select("text", "toxic", use.alias("use"))


def _prefix_counts(examples: DataFrame) -> DataFrame:
    """Documents by prefix, toxic and clean; a whole word ends in ``$``."""

    def table(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
        keys = sorted(counts[0].keys() | counts[1].keys())
        columns = [pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in (counts[1], counts[0]))]
        return pa.RecordBatch.from_arrays(columns, names=["prefix", "toxic", "clean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for i, toxic in enumerate(batch.column("toxic").to_pylist()):
                data, bounds = text_bytes(batch.column("text").slice(i, 1))
                starts, ends, _ = word_spans(data, bounds, _CODES)
                words = {data[a:b].tobytes().decode("utf-8", "replace").lower().strip(MARKS) for a, b in zip(starts, ends)}
                found = set()
                for word in words:
                    found.update(word[:k] for k in range(SHORTEST, min(len(word), LONGEST) + 1))
                    if SHORTEST <= len(word) <= LONGEST:
                        found.add(word + "$")
                counts[toxic].update(found)
                if len(counts[0]) + len(counts[1]) > HELD_PREFIXES:
                    yield table(counts)
                    counts = (Counter(), Counter())
        yield table(counts)

    parts = examples.select("text", "toxic").mapInArrow(run, "prefix string, toxic long, clean long")
    return parts.groupBy("prefix").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose_terms(counts: dict[str, int]) -> tuple[list[str], list[str]]:
    """Terms and stems out of the prefixes that passed, with their number of toxic documents.

    From each shortest prefix on, the longest continuation that keeps most of the documents at each letter is taken.
    """
    terms, stems = set(), set()
    follow: dict[str, list[str]] = {}
    for p in counts:
        follow.setdefault(p[:-1], []).append(p)
    for p in sorted(counts, key=len):
        if p.endswith("$"):
            continue
        if len(p) > SHORTEST and p[:-1] in counts:
            continue
        while True:
            longer = [q for q in follow.get(p, []) if counts[q] >= CHAIN * counts[p]]
            if not longer:
                stems.add(p)
                break
            p = max(longer, key=lambda q: (q.endswith("$"), counts[q], q))
            if p.endswith("$"):
                terms.add(p[:-1])
                break
    for p in counts:  # whole words whose beginning is no sign
        if p.endswith("$") and not any(p[:k] in counts for k in range(SHORTEST, len(p))):
            terms.add(p[:-1])
    return sorted(terms), sorted(stems)


def fit_regression(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> tuple[list[float], float]:
    """Newton's method for a logistic regression; weights and bias."""
    design = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(design.shape[1])
    penalty = np.append(np.full(x.shape[1], ridge), 1e-6)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (p - y) + penalty * w
        curve = (design * (p * (1 - p))[:, None]).T @ design + np.diag(penalty)
        move = np.linalg.solve(curve, slope)
        w -= move
        if np.abs(move).max() < 1e-6:
            break
    return w[:-1].tolist(), float(w[-1])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    examples = _examples(rows, labels, sample)
    first, second = examples.where("use = 0"), examples.where("use = 1")
    size = {r["toxic"]: r["n"] for r in first.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not toxic or not clean:
        return Model([], [])
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    passed = _prefix_counts(first).where((F.col("toxic") >= LEAST_DOCS) & (odds >= LEAST_ODDS)).collect()
    terms, stems = choose_terms({r["prefix"]: r["toxic"] for r in passed})
    model = Model(terms, stems)

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            starts, ends, _ = word_spans(data, bounds, _CODES)
            near = np.flatnonzero(matcher.of(data, starts, ends) == 2)
            found = {data[starts[i] : ends[i]].tobytes().decode("utf-8", "replace").lower().strip(MARKS) for i in near}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], names=["form"])

    # forms at one edit from a term, in clean rows of the sample: bounded by the sample
    harmless = first.where("toxic = 0").select("text").mapInArrow(forms, "form string").distinct().collect()
    model.harmless = frozenset(r["form"] for r in harmless)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for batch in batches:
            for part in row_slices(batch, "text", SLICE_BYTES):
                x = _features(matcher, part.column("text"))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), FEATURES).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("toxic"), lists], names=["toxic", "x"])

    held = second.select("toxic", "text").mapInArrow(measure, "toxic int, x array<double>").collect()
    y = np.array([r["toxic"] for r in held], float)
    if 0 < y.sum() < len(y):
        model.weights, model.bias = fit_regression(np.array([r["x"] for r in held]), y)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _scored(rows, model, ["doc_id"], lambda part: part.column("text")).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


def _scored(rows: DataFrame, model: Model, keep: list[str], text_of: Callable[[pa.RecordBatch], pa.Array]) -> DataFrame:
    """The columns ``keep`` of ``rows`` and ``score``; ``text_of`` takes the texts out of a batch."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        matcher, weights = Matcher(model), np.array(model.weights)
        for part in (part for whole in batches for part in row_slices(whole, text_of(whole), SLICE_BYTES)):
            found = _features(matcher, text_of(part))
            if math.isinf(model.bias):  # nothing was learned
                scores = np.zeros(part.num_rows)
            else:
                scores = 1 / (1 + np.exp(-np.clip(found @ weights + model.bias, -700, 700)))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(scores)], names=[*keep, "score"])

    schema = rows.select(*keep).schema.add("score", "double")
    return text_batches(rows).mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score under 0.5, with their columns."""
    model = train(docs, labels)
    whole = docs.select(F.struct(*docs.columns).alias("row"))
    return _scored(whole, model, ["row"], lambda part: part.column("row").field("text")).where("score < 0.5").select("row.*")
