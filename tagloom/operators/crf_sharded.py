"""CRF training with exact features and weights that stay in Spark.

:mod:`tagloom.operators.crf` hashes features into buckets and keeps all weights on the driver. Here each seen feature has its
own number (see :mod:`tagloom.operators.feature_index`), and weights, gradients and the memory of L-BFGS are columns of a table
with a row for each block of features with numbers in a row. The tasks that find the features of tokens cut whole sentences
into parts of about TOKENS tokens; a row holds a part: its distinct features, and which of them each token has. In a step each
block sends each part the weights of its features that occur there, in one row; the part runs forward-backward, and answers with
one row a block, which are summed. A feature of every token, as the bias, is thus sent once a part and not once a token, and no
row for a single token or feature is shuffled or sorted in a step. Matrices are sent as the bytes of their rows.

The direction of L-BFGS is a sum of the vectors in memory, whose factors follow from their scalar products alone (Chen et al.
2014), so the driver holds those, the loss, and what belongs to pairs of labels: nothing whose size grows with the features.
Steps, line search and penalties are those of :class:`tagloom.operators.crf.Descent`, and so are the losses.

Defined cases: weights exist for every (feature, label) pair seen in training and every pair of labels; unseen features
count nothing; a table without rows gives a model without labels, which tags nothing.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.constants import C1, C2, MAX_ITERATIONS
from tagloom.operators import crf_kernels, feature_index
from tagloom.operators.crf import MEMORY
from tagloom.operators.feature_index import FeatureIndex, build_index
from tagloom.operators.features import FeatureConfig, feature_columns, feature_texts
from tagloom.operators.sequences import SENTENCE
from tagloom.session import freeze

# Tasks get these modules by value, so executors need not have this package.
for module in (crf_kernels, feature_index, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(module)

TOKENS = 100_000  # of a part, in whole sentences
WEIGHTS = 1 << 17  # of a block of features, all labels together
ENTRIES = 1 << 20  # features of parts that belong to a block, about
VECTOR = "array<double>"


@dataclass
class ShardedModel:
    """``weights`` (id, w) by feature number, an array with a place for each label, and ``trans`` by pairs of labels."""

    labels: list[str]
    index: FeatureIndex
    weights: DataFrame
    trans: np.ndarray
    losses: list[float] = field(default_factory=list)


# ---- rows in parts -------------------------------------------------------------------


def sequence_texts(tokens: DataFrame, config: FeatureConfig, lexicons: DataFrame | None = None, label: str | None = "ner") -> DataFrame:
    """(doc_id, sent_id, tok_id, token, label, starts, t0, t1, …): the texts of a token's features, null where absent."""
    features = feature_columns(tokens, config, lexicons)
    texts = feature_texts(features, config)
    return features.select(
        *SENTENCE, "tok_id", "token", (F.col(label) if label else F.lit(None).cast("string")).alias("label"),
        F.coalesce("BOS", F.lit(False)).alias("starts"), *[t.alias(f"t{i}") for i, t in enumerate(texts)],
    )


def _slots(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c[:1] == prefix and c[1:].isdigit()]


def _in_parts(texts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(part, size, features, names, label, lengths, slots[, kept]): whole sentences, in rows of about TOKENS tokens.

    ``features`` are the ``size`` distinct texts of a part and ``names`` its labels; ``slots`` and ``label`` are places in these,
    -1 for an absent feature. ``kept`` are the columns ``keep`` of its tokens.
    """
    slots, limit = _slots(texts, "t"), TOKENS
    kinds = {f.name: f.dataType.simpleString() for f in texts.schema}
    schema = "part long, size int, features array<string>, names array<string>, label binary, lengths binary, slots binary"
    if keep:
        schema += f", kept array<struct<{', '.join(f'{c}: {kinds[c]}' for c in keep)}>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for k, (table, lengths) in enumerate(crf_kernels.whole_sentences(batches, limit)):
            features, places = crf_kernels.places([table[t] for t in slots])
            labels = table["label"].combine_chunks().dictionary_encode(null_encoding="encode")
            whole = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            codes = labels.indices.to_numpy().astype(np.int32)
            columns = {
                "part": pa.array([(task << 32) + k]), "size": pa.array([len(features)], pa.int32()),
                "features": whole(features), "names": whole(labels.dictionary), "label": pa.array([codes.tobytes()]),
                "lengths": pa.array([lengths.astype(np.int32).tobytes()]), "slots": pa.array([places.tobytes()]),
            }
            if keep:
                columns["kept"] = whole(pa.StructArray.from_arrays([table[c].combine_chunks() for c in keep], list(keep)))
            yield pa.RecordBatch.from_pydict(columns)

    ordered = texts.sortWithinPartitions(*SENTENCE, "tok_id").select("label", "starts", *slots, *[c for c in keep if c != "label"])
    return freeze(ordered.mapInArrow(run, schema))


def _numbered(parts: DataFrame, index: FeatureIndex) -> DataFrame:
    """(part, place, id): the numbers of the features of each part that the index knows."""
    pairs = parts.select("part", F.posexplode("features").alias("place", "feature"))
    return index.number(pairs.select("part", "place", index.hashed(F.col("feature")).alias("h"))).where("id >= 0").select("part", "place", "id")


def _read(row: pa.Table, name: str, kind: type = np.int32) -> np.ndarray:
    """The values of all rows of a binary column, one after another."""
    return np.frombuffer(b"".join(row[name].to_pylist()), kind)


def _cut(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column with the bytes of the rows of ``values`` up to each of ``ends``."""
    wide = values.itemsize * (values.shape[1] if values.ndim == 2 else 1)
    offsets = (np.append(0, ends) * wide).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _tokens(row: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The lengths of a part's sentences and the places of its tokens' features, slot by slot."""
    lengths = _read(row, "lengths")
    return lengths, _read(row, "slots").reshape(-1, int(lengths.sum()))


@dataclass
class _Parts:
    """``rows`` by part, and ``need`` (block, size, parts, ends, places, ids): which features of a block occur in which parts.

    A block has ``width`` features. ``ids`` count from the first of them; those up to the first of ``ends`` occur in the first
    of ``parts``, and so on, at its ``places``.
    """

    rows: DataFrame
    need: DataFrame
    width: int

    def unpersist(self) -> None:
        self.rows.unpersist(), self.need.unpersist()


def _with_blocks(parts: DataFrame, index: FeatureIndex, n: int) -> _Parts:
    """Number the features of the parts, and look from the features to the parts."""
    pairs = parts.agg(F.sum("size")).first()[0]
    width = max(1, min(WEIGHTS // n, ENTRIES * index.size // pairs))
    total = index.size

    def pack(table: pa.Table) -> pa.Table:
        part, ids, places, block = (table[c].to_numpy() for c in ("part", "id", "place", "block"))
        order = np.lexsort((ids, part))
        owners, first = np.unique(part[order], return_index=True)
        start = int(block[0]) * width
        found = {
            "parts": owners, "ends": np.append(first[1:], len(part)),
            "places": places[order].astype(np.int32), "ids": (ids[order] - start).astype(np.int32),
        }
        size = pa.array([min(width, total - start)], pa.int32())
        return pa.table({"block": table["block"].slice(0, 1), "size": size, **{c: pa.array([v.tobytes()]) for c, v in found.items()}})

    blocks = _numbered(parts, index).withColumn("block", F.expr(f"id div {width}").cast("int"))
    need = blocks.groupBy("block").applyInArrow(pack, "block int, size int, parts binary, ends binary, places binary, ids binary")
    shuffles = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = parts.drop("features").repartition(shuffles, "part")
    held = StorageLevel.MEMORY_AND_DISK
    return _Parts(rows.persist(held), freeze(need).repartition(shuffles, "block").persist(held), width)


def _by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1)


# ---- the loss and its gradient --------------------------------------------------------


class _Problem:
    """The smooth part of the loss, over tables."""

    def __init__(self, parts: _Parts, labels: Sequence[str]) -> None:
        self.parts, self.labels, self.n = parts, list(labels), len(labels)

    def _sent(self, weights: DataFrame | None) -> DataFrame:
        """(part, block, places, w): the weights (block, w) that each part needs, null without ``weights``."""
        n, first = self.n, weights is None
        need = self.parts.need if first else self.parts.need.join(weights.hint("merge"), "block")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _by_one(batches):
                parts, ends = _read(row, "parts", np.int64), _read(row, "ends", np.int64)
                blocks = pa.array(np.full(len(parts), row["block"][0].as_py(), np.int32))
                if first:
                    w = pa.nulls(len(parts), pa.binary())
                else:
                    w = _cut(_read(row, "w", np.float64).reshape(-1, n)[_read(row, "ids")], ends)
                yield pa.RecordBatch.from_arrays([pa.array(parts), blocks, _cut(_read(row, "places"), ends), w], ["part", "block", "places", "w"])

        return need.mapInArrow(run, "part long, block int, places binary, w binary")

    def expected(self, weights: DataFrame | None, trans: np.ndarray) -> tuple[float, DataFrame, np.ndarray, np.ndarray]:
        """The partition sum, expected counts by block, and those of pairs of labels, under (block, w) and ``trans``.

        Without ``weights`` these are zero, and the known labels are counted as well: the table then has them in ``c`` and zeros
        in ``w`` beside the expected counts in ``e``, and the last array has the counts of their pairs.
        """
        names, n, first = self.labels, self.n, weights is None

        def run(row: pa.Table, known: pa.Table) -> pa.Table:
            lengths, slots = _tokens(row)
            size, places = row["size"][0].as_py(), _read(known, "places")
            local = np.zeros((size + 1, n))  # absent features read the zero row at the end
            if not first:
                local[places] = _read(known, "w", np.float64).reshape(-1, n)
            log_z, values, pairs = crf_kernels.expectations(crf_kernels.emissions(slots, local), trans, lengths)
            tail = [pairs.ravel(), [log_z]]
            if first:
                own = pc.index_in(row["names"].combine_chunks().flatten(), value_set=pa.array(names)).to_numpy()
                hot, moves = crf_kernels.observed(own[_read(row, "label")], lengths, n)
                values, tail = np.hstack([values, hot]), [*tail, moves.ravel()]
            total = np.zeros((size, values.shape[1]))
            crf_kernels.add_by_slot(total, slots, values)
            ends = np.cumsum([len(x) // 4 for x in known["places"].to_pylist()], dtype=np.int64)
            last = pa.array([np.concatenate(tail).tobytes()], pa.binary())
            return pa.table({
                "block": pa.chunked_array([known["block"].combine_chunks(), pa.array([-1], pa.int32())]),
                "part": pa.array(np.append(known["part"].to_numpy(), row["part"].to_numpy())),
                "g": pa.chunked_array([_cut(total[places], ends), last]),
            })

        def add(answers: pa.Table, need: pa.Table) -> pa.Table:
            block = pa.array([answers["block"][0].as_py()], pa.int32())
            if not len(need):
                total = np.sum([np.frombuffer(g) for g in answers["g"].to_pylist()], axis=0)
                return pa.table({"block": block, **{c: pa.array([total.tobytes()]) for c in columns}})
            total, ids = np.zeros((need["size"][0].as_py(), n * (1 + first))), _read(need, "ids")
            ends = _read(need, "ends", np.int64)
            spans = dict(zip(_read(need, "parts", np.int64).tolist(), zip(np.append(0, ends[:-1]), ends)))
            for part, g in zip(answers["part"].to_pylist(), answers["g"].to_pylist()):
                start, end = spans[part]
                total[ids[start:end]] += np.frombuffer(g).reshape(end - start, -1)  # a part has a feature once
            found = [total[:, :n], total[:, n:], np.zeros((len(total), n))]
            return pa.table({"block": block, **{c: pa.array([v.tobytes()]) for c, v in zip(columns, found)}})

        columns = ["e", "c", "w"] if first else ["e"]
        rows = self.parts.rows.groupBy("part").cogroup(self._sent(weights).groupBy("part"))
        answers = rows.applyInArrow(run, "block int, part long, g binary")
        both = answers.groupBy("block").cogroup(self.parts.need.groupBy("block"))
        sums = freeze(both.applyInArrow(add, "block int" + "".join(f", {c} binary" for c in columns)))
        tail = np.frombuffer(bytes(sums.where("block < 0").first()["e"]))
        pairs, moves = tail[: n * n].reshape(n, n), tail[n * n + 1 :].reshape(-1, n)
        return float(tail[n * n]), sums.where("block >= 0"), pairs, moves


# ---- descent on a table of vectors --------------------------------------------------------


def _matrix(row: pa.RecordBatch, name: str, n: int) -> np.ndarray:
    return _read(row, name, np.float64).reshape(-1, n)


def _bytes(values: np.ndarray) -> pa.Array:
    return pa.array([values.tobytes()], pa.binary())


@dataclass
class _Vectors:
    """A vector's table part in column ``name`` of the state, and its part for pairs of labels here."""

    trans: dict[str, np.ndarray]
    state: DataFrame
    memory: int = 0  # pairs s0 y0 (oldest) to s{memory-1} y{memory-1}

    @property
    def names(self) -> list[str]:
        return [f"{kind}{k}" for kind in "sy" for k in range(self.memory)]


class ShardedDescent:
    """Orthant-wise L-BFGS whose vectors are columns of a table by block: c (observed counts), w, e (expected counts), and the memory."""

    def __init__(self, problem: _Problem, c1: float, c2: float) -> None:
        self.problem, self.c1, self.c2, self.n = problem, c1, c2, problem.n
        n = self.n
        log_z, state, expected, pairs = problem.expected(None, np.zeros((n, n)))
        self.vectors = _Vectors({"c": pairs, "w": np.zeros((n, n)), "g": expected - pairs}, state.select("block", "c", "w", "e"))
        self.losses = [log_z]

    def _evaluate(self, weights: DataFrame, trans: np.ndarray, sums: tuple[float, float]) -> tuple[float, DataFrame, np.ndarray]:
        """The smooth loss, (block, e) expected counts, and the gradient of the pairs; ``sums`` are w·c and w·w of the table's part."""
        log_z, expected, pairs, _ = self.problem.expected(weights, trans)
        dot_c = sums[0] + float((trans * self.vectors.trans["c"]).sum())
        square = sums[1] + float((trans**2).sum())
        value = log_z - dot_c + self.c2 * square
        gradient = pairs - self.vectors.trans["c"] + 2 * self.c2 * trans
        return value, expected, gradient

    def _products(self) -> tuple[list[str], np.ndarray]:
        """Scalar products of the memory's vectors and the pseudo-gradient, and w·w in the last place."""
        names, n, gradients = [*self.vectors.names, "p", "w"], self.n, self._gradients_of()

        def run(batches):
            total = np.zeros((len(names), len(names)))
            for batch in _by_one(batches):
                _, w, _, p = gradients(batch)
                held = [_matrix(batch, name, n).ravel() for name in names[:-2]] + [p.ravel(), w.ravel()]
                total += np.array(held) @ np.array(held).T
            k = len(names)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(k), k)), pa.array(np.tile(np.arange(k), k)), pa.array(total.ravel())], ["i", "j", "x"])

        rows = self.vectors.state.mapInArrow(run, "i long, j long, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).collect()
        gram = np.zeros((len(names), len(names)))
        for r in rows:
            gram[r.i, r.j] = r.x
        t = self.vectors.trans
        pseudo = crf_kernels.pseudo_gradient(t["w"], t["g"], self.c1)
        held = np.array([(pseudo if name == "p" else t[name]).ravel() for name in names])
        return names, gram + held @ held.T

    def _gradients_of(self):
        """For tasks: seen weights, w, the smooth gradient and the pseudo-gradient of a block, 0 where no weight is."""
        n, c1, c2 = self.n, self.c1, self.c2

        def gradients(batch):
            c, w, e = (_matrix(batch, name, n) for name in ("c", "w", "e"))
            seen = c > 0
            g = np.where(seen, e - c + 2 * c2 * w, 0.0)
            return seen, w, g, np.where(seen, crf_kernels.pseudo_gradient(w, g, c1), 0.0)

        return gradients

    def _factors(self, names: list[str], gram: np.ndarray) -> np.ndarray:
        """The quasi-Newton direction as a sum of the vectors in ``names``: the two-loop recursion on scalar products."""
        at = {name: i for i, name in enumerate(names)}
        factor = np.zeros(len(names))
        factor[at["p"]] = 1.0
        used = []
        for k in reversed(range(self.vectors.memory)):
            s, y = at[f"s{k}"], at[f"y{k}"]
            a = (factor @ gram[:, s]) / gram[s, y]
            used.append(a)
            factor[y] -= a
        if self.vectors.memory:
            s, y = at[f"s{self.vectors.memory - 1}"], at[f"y{self.vectors.memory - 1}"]
            factor *= gram[s, y] / gram[y, y]
        for k, a in zip(range(self.vectors.memory), reversed(used)):
            s, y = at[f"s{k}"], at[f"y{k}"]
            factor[s] += a - (factor @ gram[:, y]) / gram[s, y]
        return -factor[:-1]

    def _moved(self, names: list[str], factor: np.ndarray, rate: float) -> tuple[DataFrame, np.ndarray, np.ndarray]:
        """(block, v) weights a step of ``rate`` away, those of the pairs, and sums: Σ|d|, p·(v-w), Σ|v|, v·c, v·v."""
        n, c1, gradients = self.n, self.c1, self._gradients_of()
        vectors = names[:-2]

        def towards(w, p, held):
            d = sum((f * h for f, h in zip(factor, [*held, p])), np.zeros_like(w))
            d = np.where(d * p >= 0, 0.0, d)
            v = w + rate * d
            if c1 > 0:
                v = np.where(v * np.where(w != 0, np.sign(w), -np.sign(p)) < 0, 0.0, v)
            return d, v

        def run(batches):
            for batch in _by_one(batches):
                seen, w, _, p = gradients(batch)
                d, v = towards(w, p, [_matrix(batch, name, n) for name in vectors])
                v = np.where(seen, v, 0.0)
                c = _matrix(batch, "c", n)
                sums = [np.abs(d), p * (v - w), np.abs(v), v * c, v * v]
                columns = [batch.column("block"), _bytes(v), *[pa.array([x.sum()]) for x in sums]]
                yield pa.RecordBatch.from_arrays(columns, ["block", "v", *[f"q{i}" for i in range(5)]])

        schema = "block int, v binary" + "".join(f", q{i} double" for i in range(5))
        moved = freeze(self.vectors.state.mapInArrow(run, schema))
        sums = np.array([x or 0.0 for x in moved.agg(*[F.sum(f"q{i}") for i in range(5)]).first()])
        t = self.vectors.trans
        p = crf_kernels.pseudo_gradient(t["w"], t["g"], self.c1)
        d, v = towards(t["w"], p, [t[name] for name in vectors])
        return moved.select("block", "v"), v, sums + [np.abs(d).sum(), (p * (v - t["w"])).sum(), np.abs(v).sum(), 0.0, 0.0]

    def step(self, tolerance: float = 1e-5) -> bool:
        """One iteration; False at the end."""
        names, gram = self._products()
        p, w = len(names) - 2, len(names) - 1
        norm = np.sqrt(gram[p, p])
        if norm <= tolerance * max(1.0, np.sqrt(gram[w, w])):
            return False
        factor = self._factors(names, gram)
        steepest = np.zeros(len(names) - 1)
        steepest[p] = -1.0
        rate = 1.0 if self.vectors.memory else 1.0 / norm
        for _ in range(20):
            moved, trans, sums = self._moved(names, factor, rate)
            if not sums[0]:
                factor = steepest
                moved, trans, sums = self._moved(names, factor, rate)
            value, expected, gradient = self._evaluate(moved.select("block", F.col("v").alias("w")), trans, (sums[3], sums[4]))
            loss = value + self.c1 * sums[2]
            if loss <= self.losses[-1] + 1e-4 * sums[1]:
                break
            rate *= 0.5
        else:
            return False
        self._accept(moved, expected, trans, gradient)
        self.losses.append(loss)
        return True

    def _accept(self, moved: DataFrame, expected: DataFrame, trans: np.ndarray, gradient: np.ndarray) -> None:
        """Go to the new weights and remember the step, unless the loss curves the wrong way along it."""
        n, c2, vectors, t = self.n, self.c2, self.vectors, self.vectors.trans
        new_s, new_y = trans - t["w"], gradient - t["g"]
        joined = vectors.state.join(moved.hint("merge"), "block").join(expected.withColumnRenamed("e", "f").hint("merge"), "block")
        names = vectors.names

        def run(batches):
            for batch in _by_one(batches):
                c, w, e, v, f = (_matrix(batch, name, n) for name in ("c", "w", "e", "v", "f"))
                s = v - w
                y = np.where(c > 0, f - e + 2 * c2 * s, 0.0)
                columns = [batch.column(name) for name in ("block", "c", "v", "f", *names)]
                yield pa.RecordBatch.from_arrays([*columns, _bytes(s), _bytes(y), pa.array([(s * y).sum()])], ["block", "c", "w", "e", *names, "s", "y", "sy"])

        kept = "".join(f", {name} binary" for name in ("c", "w", "e", *names, "s", "y"))
        after = freeze(joined.mapInArrow(run, f"block int{kept}, sy double"))
        curve = (after.agg(F.sum("sy")).first()[0] or 0.0) + float((new_s * new_y).sum())
        order = list(range(vectors.memory))
        held = {k: (t.get(f"s{k}"), t.get(f"y{k}")) for k in order}
        fresh = curve > 1e-10
        if fresh and vectors.memory == MEMORY:
            order = order[1:]
        columns = [F.col(f"{kind}{k}").alias(f"{kind}{i}") for i, k in enumerate(order) for kind in "sy"]
        pairs = {"c": t["c"], "w": trans, "g": gradient}
        for i, k in enumerate(order):
            pairs[f"s{i}"], pairs[f"y{i}"] = held[k]
        memory = len(order)
        if fresh:
            columns += [F.col(kind).alias(f"{kind}{memory}") for kind in "sy"]
            pairs[f"s{memory}"], pairs[f"y{memory}"] = new_s, new_y
            memory += 1
        self.vectors = _Vectors(pairs, after.select("block", "c", "w", "e", *columns), memory)


def _by_feature(blocks: DataFrame, n: int, width: int) -> DataFrame:
    """(id, w) of (block, w)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _by_one(batches):
            w = _read(row, "w", np.float64)
            count = len(w) // n
            lists = pa.ListArray.from_arrays(pa.array(np.arange(count + 1, dtype=np.int32) * n), pa.array(w))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(count) + row["block"][0].as_py() * width), lists], ["id", "w"])

    return blocks.select("block", "w").mapInArrow(run, f"id long, w {VECTOR}")


# ---- training and tagging ------------------------------------------------------------------


def fit(
    tokens: DataFrame,
    config: FeatureConfig,
    lexicons: DataFrame | None = None,
    c1: float = C1,
    c2: float = C2,
    max_iter: int = MAX_ITERATIONS,
) -> ShardedModel:
    """Train on a token table with tags in ``ner``."""
    rows = _in_parts(sequence_texts(tokens, config, lexicons))
    index = build_index(rows.select(F.explode("features").alias("feature")))
    labels = sorted(r[0] for r in rows.select(F.explode("names").alias("label")).distinct().collect())
    if not labels:
        return ShardedModel([], index, tokens.sparkSession.createDataFrame([], f"id long, w {VECTOR}"), np.zeros((0, 0)))
    n = len(labels)
    parts = _with_blocks(rows, index, n)
    try:
        descent = ShardedDescent(_Problem(parts, labels), c1, c2)
        for _ in range(max_iter):
            if not descent.step():
                break
        weights = _by_feature(descent.vectors.state, n, parts.width)
        return ShardedModel(labels, index, weights, descent.vectors.trans["w"], descent.losses)
    finally:
        parts.unpersist()


def predict(tokens: DataFrame, model: ShardedModel, config: FeatureConfig, lexicons: DataFrame | None = None, label: str | None = None) -> DataFrame:
    """(doc_id, sent_id, tok_id, token, truth, pred): the best tags of each sentence."""
    texts = sequence_texts(tokens, config, lexicons, label)
    kinds = {f.name: f.dataType.simpleString() for f in texts.schema}
    keys = [*SENTENCE, "tok_id", "token"]
    schema = ", ".join(f"{c} {kinds[c]}" for c in keys) + ", truth string, pred string"
    if not model.labels:
        return tokens.sparkSession.createDataFrame([], schema)
    names, trans, n = list(model.labels), model.trans, len(model.labels)
    parts = _in_parts(texts, [*keys, "label"])

    def run(row: pa.Table, known: pa.Table) -> pa.Table:
        lengths, slots = _tokens(row)
        local = np.zeros((row["size"][0].as_py() + 1, n))
        local[known["place"].to_numpy()] = known["w"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
        best = crf_kernels.best_paths(crf_kernels.emissions(slots, local), trans, lengths)
        kept = pa.Table.from_struct_array(row["kept"].combine_chunks().flatten())
        return kept.append_column("pred", pa.array(names).take(pa.array(best))).rename_columns([*keys, "truth", "pred"])

    down = _numbered(parts, model.index).join(model.weights.hint("merge"), "id")
    rows = parts.drop("features").groupBy("part").cogroup(down.groupBy("part"))
    return rows.applyInArrow(run, schema)


def save(spark: SparkSession, model: ShardedModel, path: str, mode: str = "errorifexists") -> None:
    """Write the tables of a model; ``meta`` has one row a pair of labels."""
    n = len(model.labels)
    meta = [(model.labels[i], model.labels[j], float(model.trans[i, j])) for i in range(n) for j in range(n)]
    spark.createDataFrame(meta, "from_label string, to_label string, weight double").write.mode(mode).parquet(f"{path}/trans")
    model.weights.write.mode(mode).parquet(f"{path}/weights")
    model.index.buckets.write.mode(mode).parquet(f"{path}/index")
    size = [(model.index.count, model.index.size, model.index.seed)]
    spark.createDataFrame(size, "count long, size long, seed long").write.mode(mode).parquet(f"{path}/meta")


def load(spark: SparkSession, path: str) -> ShardedModel:
    meta = spark.read.parquet(f"{path}/meta").first()
    trans = spark.read.parquet(f"{path}/trans").collect()  # labels² rows
    labels = sorted({r.from_label for r in trans})
    matrix = np.zeros((len(labels), len(labels)))
    for r in trans:
        matrix[labels.index(r.from_label), labels.index(r.to_label)] = r.weight
    index = FeatureIndex(spark.read.parquet(f"{path}/index"), meta["count"], meta["size"], meta["seed"])
    return ShardedModel(labels, index, spark.read.parquet(f"{path}/weights"), matrix)
