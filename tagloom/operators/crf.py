"""Training and decoding of a linear-chain CRF as Spark jobs.

Features of a token are hashed ids in integer columns. One shuffle brings the
tokens of a sentence together and in order, and the tasks read them from Arrow
batches, cut at sentence starts; in a sentence table the tasks also join and hash
the neighbours of a token. Training turns the rows into blocks of some 500,000
tokens once, in the order in which a step goes through them, and keeps these. A
training step broadcasts the weights (at most ``buckets`` × labels numbers), runs
forward-backward and sums the expected counts by feature in Spark. The driver
holds the weight vector and a few copies of it, never data. Observed counts do
not change and are taken once.

Objective: negative log-likelihood + c2·‖w‖² + c1·‖w‖₁, minimised with the
orthant-wise limited-memory quasi-Newton method (Andrew & Gao 2007).
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, MutableMapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.constants import C1, C2, END_POS, END_TOKEN, MAX_ITERATIONS, OUTSIDE
from tagloom.operators import crf_kernels, sentence_kernels
from tagloom.operators.features import BIAS, FeatureConfig, feature_columns, hashed_slots, own_slots
from tagloom.operators.sequences import (
    BATCH_BYTES, NO_LIMIT, SENTENCE, SEQ, by_sentence, is_packed, keep_fields, kinds, unpack, with_fields,
)
from tagloom.operators.tags import vote

# Tasks get the kernels by value, so executors need not have this package.
cloudpickle.register_pickle_by_value(crf_kernels)

BUCKETS = 1 << 18
MEMORY = 6
PARTITIONS = "spark.sql.shuffle.partitions"
BATCH_ROWS, BLOCKS_AT_ONCE = "spark.sql.execution.arrow.maxRecordsPerBatch", "4"
TOKENS_AT_ONCE = 500_000  # tokens whose marginals a task holds at a time, in whole sentences; long lines leave few tokens to a step


@dataclass
class CrfModel:
    """Weights by (feature bucket, label) and by (label, label)."""

    labels: list[str]
    state: np.ndarray
    trans: np.ndarray
    losses: list[float] = field(default_factory=list)

    @property
    def buckets(self) -> int:
        return len(self.state)

    def tables(self, spark: SparkSession, name: str = "model") -> tuple[DataFrame, DataFrame]:
        """(state, trans) tables; labels without a weight keep a row in ``trans``."""
        at, lab = np.nonzero(self.state)
        names = np.array(self.labels, dtype=object)
        state = pd.DataFrame({"bucket": at.astype(np.int64), "label": names[lab], "weight": self.state[at, lab]})
        n = len(self.labels)
        trans = pd.DataFrame(
            {"from_label": np.repeat(names, n), "to_label": np.tile(names, n), "weight": self.trans.ravel()}
        )
        return (
            spark.createDataFrame(state, "bucket long, label string, weight double")
            .select(F.lit(name).alias("model"), F.lit(self.buckets).alias("buckets"), "*"),
            spark.createDataFrame(trans, "from_label string, to_label string, weight double")
            .select(F.lit(name).alias("model"), F.lit(self.buckets).alias("buckets"), "*"),
        )


def model_name(path: str) -> str:
    """``x_y_NAME.ext`` names the model ``NAME``."""
    return path.rstrip("/").split("/")[-1].split(".")[0].split("_")[-1]


def save_model(spark: SparkSession, model: CrfModel, path: str, mode: str = "errorifexists") -> None:
    for part, table in zip(("state", "trans"), model.tables(spark, model_name(path)), strict=True):
        table.write.mode(mode).parquet(f"{path}/{part}")


def load_model(spark: SparkSession, path: str) -> CrfModel:
    """Read the weight tables; their size is bound by buckets × labels."""
    trans = spark.read.parquet(f"{path}/trans").toPandas()
    labels = sorted(trans["from_label"].unique())
    place = {label: i for i, label in enumerate(labels)}
    matrix = np.zeros((len(labels), len(labels)))
    matrix[trans["from_label"].map(place), trans["to_label"].map(place)] = trans["weight"]
    rows = spark.read.parquet(f"{path}/state").toPandas()
    state = np.zeros((int(trans["buckets"].iloc[0]), len(labels)))
    state[rows["bucket"], rows["label"].map(place)] = rows["weight"]
    return CrfModel(labels, state, matrix)


def load_models(spark: SparkSession, paths: Sequence[str]) -> dict[str, CrfModel]:
    return {model_name(p): load_model(spark, p) for p in paths}


def sequence_rows(
    tokens: DataFrame,
    config: FeatureConfig,
    lexicons: DataFrame | None = None,
    buckets: int = BUCKETS,
    label: str | None = "ner",
) -> DataFrame:
    """(doc_id, sent_id, tok_id, token, label, starts, f0, f1, …), sentences whole and in order inside partitions.

    The features already need this order, so it costs no second shuffle or sort. A sentence table has it already, and tasks
    add the features of neighbours; configurations with lexicons or shapes of neighbours take its token rows.
    """
    if _in_tasks(tokens, config):
        rows, slots_of = _own_rows(tokens, config, buckets, label)
        keep = [*SENTENCE, "tok_id", "token", "label"]
        count = 3 + 2 * config.window + len(_own_names(rows))

        def task(table: pa.Table, starts: np.ndarray) -> pa.Table:
            begins = np.zeros(table.num_rows, bool)
            begins[starts] = True
            out = table.select(keep).append_column("starts", pa.array(begins))
            for i, ids in enumerate(slots_of(table, starts)):
                out = out.append_column(f"f{i}", pa.array(ids))
            return out

        schema = f"{kinds(rows, keep)}, starts boolean, " + ", ".join(f"f{i} int" for i in range(count))
        return by_sentence(rows, ORDER, task, schema)
    slots = hashed_slots(features := feature_columns(unpack(tokens), config, lexicons), config, buckets)
    rows = features.select(
        *SENTENCE, "tok_id", "token",
        (F.col(label) if label else F.lit(OUTSIDE)).alias("label"),
        F.coalesce("BOS", F.lit(False)).alias("starts"),
        *[slot.alias(f"f{i}") for i, slot in enumerate(slots)],
    )
    return rows.sortWithinPartitions(*SENTENCE, "tok_id")


ORDER = ("tok_id", "token", "label")  # of the rows of a sentence made of several texts


def _in_tasks(tokens: DataFrame, config: FeatureConfig) -> bool:
    """Whether tasks can make the features of neighbours."""
    return is_packed(tokens) and not config.lexicons and not config.reach


def _own_names(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if re.fullmatch(r"s[0-9]+", c)]


def _own_rows(tokens: DataFrame, config: FeatureConfig, buckets: int, label: str | None):
    """A sentence table with the ids of each token's own features, and what makes all ids of a table of it, bias first."""
    named = tokens.withColumn("label", F.col(label) if label else F.lit(OUTSIDE))
    rows = own_slots(named, config, buckets)
    own, window = _own_names(rows), config.window
    rows = rows.select(*SENTENCE, SEQ, "tok_id", "token", "label", *own)
    bias = BIAS

    def slots_of(table: pa.Table, starts: np.ndarray) -> list[np.ndarray]:
        first = np.full(table.num_rows, crf_kernels.constant_id(bias, buckets), np.int32)
        near = crf_kernels.near_slots(sentence_kernels.only(table["token"]), starts, window, buckets)
        return [first, *[table[c].to_numpy() for c in own], *near]

    return rows, slots_of


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def counted_batches(spark: SparkSession):
    """Cut Arrow batches by rows alone while a job runs.

    Spark would measure the bytes of a batch at each row, which takes longer than to write it. The rows of a training job are
    a few integers and a label, so their number bounds the bytes.
    """
    return _setting(spark, BATCH_BYTES, NO_LIMIT)


def few_blocks(spark: SparkSession):
    """Give tasks a few blocks at a time while a job runs."""
    return _setting(spark, BATCH_ROWS, BLOCKS_AT_ONCE)


def few_sums(spark: SparkSession):
    """Add up what tasks return in a partition per core at most while a job runs; it is bound by the weights."""
    wanted = min(int(spark.conf.get(PARTITIONS)), spark.sparkContext.defaultParallelism)
    return _setting(spark, PARTITIONS, str(wanted))


def _slot_names(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if re.fullmatch(r"f[0-9]+", c)]


BLOCK = "fold int, labels array<string>, known binary, block binary"


def training_blocks(rows: DataFrame) -> DataFrame:
    """(fold, labels, known, block): blocks of sequence rows, kept in memory or on disk.

    With a column ``_fold`` a block has the sentences of one fold. ``labels`` are the labels in the block, ``known`` their places by token.
    """
    names, folded = _slot_names(rows), "_fold" in rows.columns
    fields = [f.split()[0] for f in BLOCK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = None
        for table, lengths in crf_kernels.whole_sentences(batches, TOKENS_AT_ONCE):
            table = table.combine_chunks()
            slots = [table[c].to_numpy() for c in names]
            groups = groups or crf_kernels.joined_columns(slots)
            folds = table["_fold"].to_numpy()[np.cumsum(lengths) - lengths] if folded else np.zeros(len(lengths), np.int32)
            for fold in np.unique(folds):
                some = folds == fold
                inside = np.repeat(some, lengths)
                order, block = crf_kernels.make_block([s[inside] for s in slots], lengths[some], groups)
                labels, known = crf_kernels.coded(table["label"].filter(pa.array(inside)), order)
                columns = [pa.array([int(fold)], pa.int32()), pa.array([labels], pa.list_(pa.string())), pa.array([known], pa.binary()), pa.array([block], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, fields)

    # One partition per core: a task emits a row per feature it saw, so fewer tasks shuffle less.
    cores = rows.sparkSession.sparkContext.defaultParallelism
    few = rows.select("starts", "label", *(["_fold"] if folded else []), *names).coalesce(cores)
    return few.mapInArrow(run, BLOCK).persist(StorageLevel.MEMORY_AND_DISK)


def block_labels(blocks: DataFrame) -> list[str]:
    """The labels of all blocks, which this makes."""
    with counted_batches(blocks.sparkSession):
        return sorted(r[0] for r in blocks.select(F.explode("labels")).distinct().collect())


def _counts(
    rows: DataFrame, labels: Sequence[str], buckets: int, weights: tuple[np.ndarray, np.ndarray] | None
) -> tuple[float, np.ndarray, np.ndarray]:
    """Log partition sum, feature counts and transition counts over all sentences of sequence rows or their blocks.

    With ``weights`` these are expected counts, without them the counts of the
    known labels. Each task adds up its sentences and emits one row per touched
    feature; rows with negative ids hold transitions and, last, the partition
    sum. The result has at most buckets × labels numbers.
    """
    if "block" not in rows.columns:
        blocks = training_blocks(rows)
        try:
            block_labels(blocks)
            return _counts(blocks, labels, buckets, weights)
        finally:
            blocks.unpersist()
    n, names = len(labels), list(labels)
    columns = ["id", *[f"g{i}" for i in range(n)]]
    shared = None if weights is None else rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, pairs, log_z = np.zeros((buckets, n)), np.zeros((n, n)), 0.0
        for _, known, block in crf_kernels.read_blocks(batches, names if shared is None else ()):
            if shared is None:
                sums, steps = block.observed(known, n)
            else:
                state, trans = shared.value
                z, marginals, steps = crf_kernels.expectations_by_steps(block.scores(state[block.features]), trans, block.alive)
                sums = block.sums(marginals)
                log_z += z
            total[block.features] += sums
            pairs += steps
        ids = np.flatnonzero(total.any(axis=1))
        tail = np.zeros((1, n))
        tail[0, 0] = log_z
        values = np.vstack([total[ids], pairs, tail])
        ids = np.concatenate([ids, -np.arange(1, n + 2)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(ids), *[pa.array(values[:, i]) for i in range(n)]], columns)

    read = ["fold", "block"] if shared is not None else ["fold", "labels", "known", "block"]
    try:
        sums = rows.select(*read).mapInArrow(run, "id int, " + ", ".join(f"{c} double" for c in columns[1:]))
        with few_blocks(rows.sparkSession), few_sums(rows.sparkSession):
            sums = sums.groupBy("id").agg(*[F.sum(c).alias(c) for c in columns[1:]]).toArrow()
    finally:
        if shared is not None:
            shared.destroy()
    ids, values = sums["id"].to_numpy(), np.column_stack([sums[c].to_numpy() for c in columns[1:]])
    state, moves = np.zeros((buckets, n)), np.zeros((n + 1, n))
    state[ids[ids >= 0]] = values[ids >= 0]
    moves[-ids[ids < 0] - 1] = values[ids < 0]
    return float(moves[n, 0]), state, moves[:n]


def _direction(grad: np.ndarray, memory: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Two-loop recursion for the quasi-Newton direction."""
    q, used = grad.copy(), []
    for s, y in reversed(memory):
        a = (s @ q) / (s @ y)
        used.append(a)
        q -= a * y
    if memory:
        s, y = memory[-1]
        q *= (s @ y) / (y @ y)
    for (s, y), a in zip(memory, reversed(used), strict=True):
        q += (a - (y @ q) / (s @ y)) * s
    return -q


class Descent:
    """Orthant-wise L-BFGS that asks for values instead of computing them, so several can share one pass over the data.

    All its vectors lie in ``kept``, a dictionary or something like it that writes them to disk; between two values it
    holds none itself.
    """

    def __init__(self, w: np.ndarray, c1: float, max_iter: int, tolerance: float = 1e-5, kept: MutableMapping[str, np.ndarray] | None = None) -> None:
        self.kept = {} if kept is None else kept
        self.kept["w"] = self.kept["asked"] = w
        self.c1, self.max_iter, self.tolerance = c1, max_iter, tolerance
        self.losses: list[float] = []
        self.asking = True
        self._values = self._run()
        next(self._values)

    @property
    def w(self) -> np.ndarray:
        return self.kept["w"]

    @property
    def asked(self) -> np.ndarray | None:
        """Where the value and the gradient are wanted, None at the end."""
        return self.kept["asked"] if self.asking else None

    @property
    def steps(self) -> int:
        return max(0, len(self.losses) - 1)

    def tell(self, value: float, grad: np.ndarray) -> None:
        """The smooth part of the loss and its gradient at the place that was asked for."""
        try:
            self._values.send((value, grad))
        except StopIteration:
            self.asking = False

    def _pseudo(self) -> np.ndarray:
        return crf_kernels.pseudo_gradient(self.w, self.kept["grad"], self.c1)

    def _trial(self, pairs: list[int], rate: float) -> float:
        """Ask for the value a step away; returns the slope times that step."""
        w, pseudo = self.w, self._pseudo()
        d = _direction(pseudo, [(self.kept[f"s{k}"], self.kept[f"y{k}"]) for k in pairs])
        d[d * pseudo >= 0] = 0.0
        if not d.any():
            d = -pseudo
        new = w + rate * d
        if self.c1 > 0:
            new[new * np.where(w != 0, np.sign(w), -np.sign(pseudo)) < 0] = 0.0
        self.kept["asked"] = new
        return pseudo @ (new - w)

    def _accept(self, pairs: list[int], step: int, grad: np.ndarray) -> list[int]:
        """Go to the place that was asked for; returns the steps in memory."""
        new = self.kept["asked"]
        s, y = new - self.w, grad - self.kept["grad"]
        if s @ y > 1e-10:
            self.kept[f"s{step}"], self.kept[f"y{step}"] = s, y
            for old in pairs[: -(MEMORY - 1)]:
                self.kept.pop(f"s{old}"), self.kept.pop(f"y{old}")
            pairs = [*pairs[-(MEMORY - 1) :], step]
        self.kept["w"], self.kept["grad"] = new, grad
        return pairs

    def _run(self):
        value, self.kept["grad"] = yield
        self.losses.append(value + self.c1 * np.abs(self.w).sum())
        pairs: list[int] = []
        for step in range(self.max_iter):
            norm = np.linalg.norm(self._pseudo())
            if norm <= self.tolerance * max(1.0, np.linalg.norm(self.w)):
                return
            rate = 1.0 if pairs else 1.0 / norm
            for _ in range(20):
                slope = self._trial(pairs, rate)
                grad = None
                value, grad = yield
                loss = value + self.c1 * np.abs(self.kept["asked"]).sum()
                if loss <= self.losses[-1] + 1e-4 * slope:
                    break
                rate *= 0.5
            else:
                return
            pairs = self._accept(pairs, step, grad)
            self.losses.append(loss)


def minimise(smooth, w: np.ndarray, c1: float, max_iter: int, tolerance: float = 1e-5) -> tuple[np.ndarray, list[float]]:
    """Orthant-wise L-BFGS over ``smooth(w) -> (value, gradient)`` plus c1·‖w‖₁."""
    descent = Descent(w, c1, max_iter, tolerance)
    while descent.asking:
        descent.tell(*smooth(descent.asked))
    return descent.w, descent.losses


def crf_fit(
    rows: DataFrame, buckets: int = BUCKETS, c1: float = C1, c2: float = C2, max_iter: int = MAX_ITERATIONS
) -> CrfModel:
    """Train on sequence rows.

    Weights exist for every (feature, label) pair seen in training and for
    every pair of labels.
    """
    blocks = training_blocks(rows.drop("_fold"))
    try:
        labels = block_labels(blocks)
        _, counts, moves = _counts(blocks, labels, buckets, None)
        seen = np.flatnonzero(counts.ravel())
        observed = np.concatenate([counts.ravel()[seen], moves.ravel()])
        n_state, shape = len(seen), counts.shape

        def unpack(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            state = np.zeros(shape[0] * shape[1])
            state[seen] = w[:n_state]
            return state.reshape(shape), w[n_state:].reshape(len(labels), len(labels))

        def smooth(w: np.ndarray) -> tuple[float, np.ndarray]:
            log_z, grad, pairs = _counts(blocks, labels, buckets, unpack(w))
            expected = np.concatenate([grad.ravel()[seen], pairs.ravel()])
            return log_z - w @ observed + c2 * (w @ w), expected - observed + 2 * c2 * w

        w, losses = minimise(smooth, np.zeros(len(observed)), c1, max_iter)
        return CrfModel(labels, *unpack(w), losses)
    finally:
        blocks.unpersist()


def _paths(models: Mapping[str, CrfModel], spark: SparkSession):
    """The models in the order of their names, and what finds their best paths ``p0``, ``p1``, … from slots and sentence lengths."""
    names = sorted(models)
    shared = spark.sparkContext.broadcast(
        [(np.vstack([models[k].state, np.zeros(len(models[k].labels))]), models[k].trans) for k in names]
    )

    def paths_of(slots: Sequence[np.ndarray], lengths: np.ndarray) -> Iterator[tuple[str, np.ndarray]]:
        order, alive = crf_kernels.by_steps(lengths)
        for i, (state, trans) in enumerate(shared.value):
            scores = np.ascontiguousarray(crf_kernels.scores_of(slots, state)[order].T)
            best = np.empty(len(order), np.int32)
            best[order] = crf_kernels.best_paths_by_steps(scores, trans, alive)
            yield f"p{i}", best

    return names, paths_of


def _named_paths(tagged: DataFrame, models: Mapping[str, CrfModel], names: Sequence[str], *keys: str) -> DataFrame:
    def tag_of(name: str, path: str) -> Column:
        return F.element_at(F.array(*[F.lit(x) for x in models[name].labels]), F.col(path) + 1).alias(f"pred_{name}")

    return tagged.select(*keys, "tok_id", "token", F.col("label").alias("truth"), *[tag_of(k, f"p{i}") for i, k in enumerate(names)])


def crf_predict(rows: DataFrame, models: Mapping[str, CrfModel]) -> DataFrame:
    """(doc_id, sent_id, tok_id, token, truth, one tag column per model), in one pass over the rows."""
    slot_names, keep = _slot_names(rows), [*SENTENCE, "tok_id", "token", "label"]
    names, paths_of = _paths(models, rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, lengths in crf_kernels.whole_sentences(batches, TOKENS_AT_ONCE):
            out = table.select(keep)
            for p, best in paths_of([table[c].to_numpy() for c in slot_names], lengths):
                out = out.append_column(p, pa.array(best))
            yield from out.to_batches()

    schema = kinds(rows, keep) + "".join(f", p{i} int" for i in range(len(names)))
    return _named_paths(rows.select(*keep, "starts", *slot_names).mapInArrow(run, schema), models, names, *SENTENCE)


def _predict_packed(tokens: DataFrame, models: Mapping[str, CrfModel], config: FeatureConfig, buckets: int, label: str | None) -> DataFrame:
    """As :func:`crf_predict` from and to a sentence table, the features of neighbours made in the same tasks."""
    rows, slots_of = _own_rows(tokens, config, buckets, label)
    keep = [*SENTENCE, SEQ, "tok_id", "token", "label"]
    names, paths_of = _paths(models, tokens.sparkSession)

    def task(table: pa.Table, starts: np.ndarray) -> pa.Table:
        out = table.select(keep)
        for p, best in paths_of(slots_of(table, starts), np.diff(np.append(starts, table.num_rows))):
            out = out.append_column(p, pa.array(best))
        return out

    schema = kinds(rows, keep) + "".join(f", p{i} int" for i in range(len(names)))
    return _named_paths(by_sentence(rows, ORDER, task, schema, TOKENS_AT_ONCE), models, names, *SENTENCE, SEQ)


def predict_tags(
    tokens: DataFrame,
    models: Mapping[str, CrfModel],
    config: FeatureConfig,
    lexicons: DataFrame | None = None,
    label: str | None = None,
) -> DataFrame:
    """(doc_id, sent_id, tok_id, token, truth, pred): tag tokens with one model, or vote over several.

    Sentence tables give sentence tables, but with lexicons or shapes of neighbours.
    """
    buckets = next(iter(models.values())).buckets
    if _in_tasks(tokens, config):
        tagged = _predict_packed(tokens, models, config, buckets, label)
    else:
        tagged = crf_predict(sequence_rows(tokens, config, lexicons, buckets, label), models)
    voted = with_fields(tagged, {"pred": lambda get: vote({k: get(f"pred_{k}") for k in models})})
    return keep_fields(voted, ["tok_id", "token", "truth", "pred"])


def restore_ends(tagged: DataFrame) -> DataFrame:
    """Add the end row of each sentence to a table with (doc_id, sent_id, tok_id, token, ner, pos).

    In a sentence table it stands behind the last token, so the tags are neither shuffled nor made twice.
    """
    if is_packed(tagged):
        cols = [*SENTENCE, "tok_id", "token", "ner", "pos"]
        end = {"token": END_TOKEN, "ner": OUTSIDE, "pos": END_POS}
        return by_sentence(
            tagged.select(SEQ, *cols), ["tok_id", "token", "ner"],
            lambda table, starts: sentence_kernels.with_ends(table, starts, "tok_id", end, cols), kinds(tagged, cols),
        )
    ends = tagged.groupBy(*SENTENCE).agg((F.max("tok_id") + 1).alias("tok_id")).select(
        *SENTENCE, "tok_id", F.lit(END_TOKEN).alias("token"), F.lit(OUTSIDE).alias("ner"), F.lit(END_POS).alias("pos")
    )
    return tagged.unionByName(ends, allowMissingColumns=True)
