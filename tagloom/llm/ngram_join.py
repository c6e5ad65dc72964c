"""A Jaccard join on word n-grams by R-trees over count vectors.

A document's set holds its distinct three-word shingles. The tokens of a set are hashed into GROUPS groups; how many fall in
each is the document's *point*; a coordinate ends at 255, and what is beyond is one number, the *excess*. Two sets share at most
the sum of the coordinate minima of their points, the excess being one more coordinate, and a box of an R-tree bounds this for all
points inside by its upper corner. Pairs that survive the bound are verified on full sets.

In so many dimensions a ball of the join's radius reaches across the whole of every coordinate, so one tree cut over the cluster
would send each point to nearly every part. What shares a tree is therefore decided exactly and beforehand: linked
sets of up to U tokens differ in at most ``k = U * (100 - percent) / percent`` tokens; their tokens are dealt by hash to
``k + 1 + SPARE`` blocks, and as each differing token spoils one block, more than SPARE blocks hold the same tokens in both.
Sets with an equal block share a *bucket*, and each bucket is searched by itself:

1. *Classes.* Rows with equal sets are one class, whatever their number.
2. *First round.* In each bucket the smallest class is the pivot; the bound takes it with each other member, and verification
   with those that pass. Linked pairs give components, and a group of near copies costs one comparison a member.
3. *Second round.* Where the other members of a bucket still lie in several components, a tree over the points of the
   members finds partners in other components; subtrees that hold only the own component are passed over. Members without a
   partner that the bound leaves go, equal cells become one, and what is left is searched again with verification on texts.
   Large buckets are cut into cells: members of the bucket's commonest component stand in one cell each, if the other members
   fit in a cell, and only the latter are repeated. Squares of cells are formed only of members outside that component.

After that every linked pair was verified, or its ends lie in one component already.

Defined cases: null and empty texts, and those without words, have an empty set, link with nothing and stand alone; fewer
than three words are one shingle; rows that repeat an id are separate documents with a result each (the component of each is
the smallest id among the rows it reaches); rows with a null id stand alone, with a null component; an empty table gives no
rows; columns beyond the two named ones are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.minmax_dedup import components
from tagloom.llm.shared import hot_join, row_slices, stored, text_batches
from tagloom.llm.words import byte_codes, inside_rows, mix, rolling, span_hashes, text_bytes, word_spans

SHINGLE = 3
#: Linked: percent * union size <= 100 * intersection size.
PERCENT = 90
#: Dimensions of a point, a power of two, and the largest value of one.
GROUPS, MOST = 256, 255
#: Blocks beyond those that the bound needs, so that a document with few tokens need not be known by an empty block.
SPARE = 2
#: Sizes whose largest is at most this many times the smallest share one number of blocks.
RATIO = 1.25
#: A cell of the second round: members, and tokens of all of them. Members that share one pivot's text.
CELL_ROWS, CELL_TOKENS = 512, 1 << 20
PIVOT_ROWS = 1000
#: Children of a tree node.
FAN = 16
SLICE_BYTES = 1 << 20
_CODES = byte_codes(b"\x20\x09\x0a\x0b\x0c\x0d", fold_case=True)
_SEED = np.uint64(0xA0761D6478BD642F)
_SIGNED = pa.schema(
    {"doc_id": pa.int64(), "text_hash": pa.int64(), "n_shingles": pa.int64(), "set_hash": pa.binary(), "point": pa.binary(), "blocks": pa.list_(pa.int64())}
)


# ---- sets, points and blocks ---------------------------------------------------


def token_sets(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of all rows, rising inside a row, and the number of them before each row."""
    data, bounds = text_bytes(column)
    starts, ends, words = word_spans(data, bounds, _CODES)
    hashes = span_hashes(data, starts, ends, _CODES)
    counts = np.diff(words)
    at = np.flatnonzero(inside_rows(words, size))
    found, row = rolling(hashes, size)[at], np.searchsorted(words, at, side="right") - 1
    for few in range(1, size):  # a short document is one shingle
        short = np.flatnonzero(counts == few)
        if len(short):
            found = np.append(found, rolling(hashes, few, few)[words[short]])
            row = np.append(row, short)
    order = np.lexsort((found, row))
    found, row = found[order], row[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
    return found[new], np.searchsorted(row[new], np.arange(len(words)))


def points(tokens: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Tokens in each group, a row of bytes for each set."""
    rows = len(cuts) - 1
    cells = np.repeat(np.arange(rows) * GROUPS, np.diff(cuts)) + (tokens & np.uint64(GROUPS - 1)).astype(np.int64)
    return np.minimum(np.bincount(cells, minlength=rows * GROUPS), MOST).astype(np.uint8).reshape(rows, GROUPS)


def excess(grid: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return sizes - grid.sum(axis=-1, dtype=np.int64)


def most_shared(a: np.ndarray, a_excess: np.ndarray, b: np.ndarray, b_excess: np.ndarray) -> np.ndarray:
    """At most so many tokens are common to the sets of points ``a`` and ``b``, row by row."""
    return np.minimum(a, b).sum(axis=-1, dtype=np.int64) + np.minimum(a_excess, b_excess)


def size_edges(largest: int, ratio: float = RATIO) -> list[int]:
    """The smallest size of each size class, up to one beyond ``largest``."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, int(edges[-1] * ratio)))
    return edges


def _block_keys(tokens: np.ndarray, cuts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """``row, key`` of all blocks by which a set is known, for its own size class and those of smaller partners."""
    sizes = np.diff(cuts)
    filled = np.flatnonzero(sizes)
    if not len(filled):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    edges = np.array(size_edges(int(sizes.max())))
    own = np.searchsorted(edges, sizes, side="right") - 1
    least = np.searchsorted(edges, -(-sizes * percent // 100), side="right") - 1
    rows_out, keys_out = [], []
    for back in range(int((own - least)[filled].max()) + 1):
        kind = own - back
        some = filled[kind[filled] >= least[filled]]
        upper = edges[kind[some] + 1] - 1
        blocks = upper * (100 - percent) // percent + 1 + SPARE
        base = np.repeat(cuts[some] - np.cumsum(sizes[some]) + sizes[some], sizes[some])
        mine = tokens[base + np.arange(len(base))]
        owner = np.repeat(np.arange(len(some)), sizes[some])
        # tokens rise inside a row, and so do their blocks
        block = (mine >> np.uint64(32)) * blocks[owner].astype(np.uint64) >> np.uint64(32)
        new = np.ones(len(mine), bool)
        new[1:] = (block[1:] != block[:-1]) | (owner[1:] != owner[:-1])
        begin = np.flatnonzero(new)
        content = np.add.reduceat(mix(mine ^ _SEED), begin)
        held = owner[begin]
        place = block[begin] + (kind[some][held].astype(np.uint64) << np.uint64(32))
        rows_out.append(some[held])
        keys_out.append(mix(mix(place + np.uint64(1)) ^ content))
        empty = blocks - np.bincount(held, minlength=len(some))
        for r in np.flatnonzero(empty > SPARE):  # all blocks that agree may be empty ones
            missing = np.setdiff1d(np.arange(blocks[r], dtype=np.uint64), block[begin[held == r]])
            rows_out.append(np.full(len(missing), some[r]))
            keys_out.append(mix(missing + (np.uint64(kind[some[r]]) << np.uint64(32)) + np.uint64(1)))
    rows, keys = np.concatenate(rows_out), np.concatenate(keys_out)
    order = np.argsort(rows, kind="stable")
    return rows[order], keys[order]


def _sign(part: pa.RecordBatch, percent: int) -> pa.RecordBatch:
    tokens, cuts = token_sets(part.column("text"))
    rows = len(cuts) - 1
    grid = points(tokens, cuts)
    owner, keys = _block_keys(tokens, cuts, percent)
    bounds = np.searchsorted(owner, np.arange(rows + 1))
    sizes = np.diff(cuts)
    hashes = [hashlib.blake2b(tokens[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(cuts[:-1], cuts[1:])]
    lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(keys.view(np.int64)))
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), part.column("text_hash"), pa.array(sizes.astype(np.int64)), pa.array(hashes, pa.binary()), pa.array([g.tobytes() for g in grid], pa.binary()), lists],
        schema=_SIGNED,
    )


def signed(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Size, hash, point and block keys of the set of every ``doc_id, text_hash, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "text", SLICE_BYTES):
                yield _sign(part, percent)

    schema = "doc_id long, text_hash long, n_shingles long, set_hash binary, point binary, blocks array<long>"
    return text_batches(rows).mapInArrow(run, schema)


# ---- the bound, the tree and verification -----------------------------------------


def may_link(shared: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether ``shared`` common tokens are enough for two sets of ``sizes`` tokens together."""
    return (shared > 0) & ((100 + percent) * shared >= percent * sizes)


class CountTree:
    """An R-tree over points, packed by halving along the widest coordinate, searched for what may link with a point."""

    def __init__(self, grid: np.ndarray, sizes: np.ndarray) -> None:
        self.grid, self.sizes, self.over = grid, sizes, excess(grid, sizes)
        self.order = self._packed(np.arange(len(grid)))
        self.levels = []  # from the leaves up: upper corners with the largest excess, least sizes
        upper, over, least = grid[self.order], self.over[self.order], sizes[self.order]
        while len(upper) > 1:
            first = np.arange(0, len(upper), FAN)
            upper, over, least = np.maximum.reduceat(upper, first), np.maximum.reduceat(over, first), np.minimum.reduceat(least, first)
            self.levels.append((upper, over, least))

    def _packed(self, rows: np.ndarray) -> np.ndarray:
        if len(rows) <= FAN:
            return rows
        grid = self.grid[rows]
        rows = rows[np.argsort(grid[:, np.argmax(grid.max(axis=0) - grid.min(axis=0))], kind="stable")]
        half = FAN * max(1, len(rows) // (2 * FAN))  # whole leaves to the left
        return np.concatenate([self._packed(rows[:half]), self._packed(rows[half:])])

    def search(self, i: int, wanted: np.ndarray, percent: int) -> np.ndarray:
        """Points with ``wanted`` set that the bound cannot tell from partners of point ``i``, the likeliest first."""
        point, size, over = self.grid[i], self.sizes[i], self.over[i]
        if len(self.levels) > 1:
            use, marks = wanted[self.order], []
            for _ in self.levels:  # subtrees without a wanted point are passed over
                use = np.logical_or.reduceat(use, np.arange(0, len(use), FAN))
                marks.append(use)
            nodes = np.arange(len(self.levels[-1][0]))
            for depth in range(len(self.levels) - 1, -1, -1):
                upper, most, least = self.levels[depth]
                nodes = nodes[marks[depth][nodes]]
                nodes = nodes[may_link(most_shared(upper[nodes], most[nodes], point, over), least[nodes] + size, percent)]
                nodes = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
                nodes = nodes[nodes < (len(self.levels[depth - 1][0]) if depth else len(self.order))]
            rows = self.order[nodes]
            rows = rows[wanted[rows]]
        else:
            rows = np.flatnonzero(wanted)
        bound = most_shared(self.grid[rows], self.over[rows], point, over)
        kept = may_link(bound, self.sizes[rows] + size, percent)
        return rows[kept][np.argsort(-bound[kept], kind="stable")]


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and (100 + percent) * both >= percent * (len(a) + len(b))


def _grid(column: pa.Array) -> np.ndarray:
    joined = b"".join(x.as_py() for x in column)
    return np.frombuffer(joined, np.uint8).reshape(len(column), GROUPS)


def _dealt(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``pairs`` with a ``salt``, and ``u, salt`` to repeat what belongs to ``u``: once for each PIVOT_ROWS pairs of it."""
    parts = F.ceil(F.col("n") / PIVOT_ROWS).cast("int").alias("parts")
    salts = stored(pairs.groupBy("u").agg(F.count("*").alias("n")).select("u", parts), "pivots")
    dealt = pairs.join(salts.hint("merge"), "u").withColumn("salt", F.pmod(F.xxhash64("v"), "parts").cast("int"))
    return dealt.select("u", "v", "salt"), salts.select("u", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"))


def bounded(pairs: DataFrame, nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs ``u, v`` that the bound leaves; ``nodes`` has ``node, point, n_shingles``."""
    dealt, copies = _dealt(pairs)
    u, v = ([F.col("node").alias(x), F.col("point").alias(f"point_{x}"), F.col("n_shingles").alias(f"size_{x}")] for x in "uv")
    left = copies.join(nodes.select(*u).hint("merge"), "u")
    right = nodes.select(*v)
    both = dealt.join(right.hint("merge"), "v").join(left.hint("merge"), ["u", "salt"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = _grid(batch.column("point_u")), _grid(batch.column("point_v"))
            m, n = batch.column("size_u").to_numpy(), batch.column("size_v").to_numpy()
            near = may_link(most_shared(a, excess(a, m), b, excess(b, n)), m + n, percent)
            yield batch.select(["u", "v"]).filter(pa.array(near))

    return both.select("u", "v", "point_u", "point_v", "size_u", "size_v").mapInArrow(run, "u long, v long")


def verified(pairs: DataFrame, bodies: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs ``u, v`` that link on full sets; ``bodies`` has ``node, text`` of all that occur."""
    dealt, copies = _dealt(pairs)
    left = copies.join(bodies.select(F.col("node").alias("u"), F.col("text").alias("text_u")).hint("merge"), "u")
    right = bodies.select(F.col("node").alias("v"), F.col("text").alias("text_v"))
    both = dealt.join(right.hint("merge"), "v").join(left.hint("merge"), ["u", "salt"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple = (None, None)
        for whole in batches:
            for batch in row_slices(whole, "text_v", SLICE_BYTES):
                tokens, cuts = token_sets(batch.column("text_v"))
                keep, texts = [], batch.column("text_u")
                for i, u in enumerate(batch.column("u").to_pylist()):
                    if u != known[0]:  # the join leaves the pairs of one node together
                        known = (u, token_sets(texts.slice(i, 1))[0])
                    keep.append(linked(known[1], tokens[cuts[i] : cuts[i + 1]], percent))
                yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return text_batches(both.select("u", "v", "text_u", "text_v")).mapInArrow(run, "u long, v long")


def _wanted(i: int, label: np.ndarray, outer: np.ndarray) -> np.ndarray:
    """What member ``i`` of a cell is to be held against: other components, of the main one if any, else each pair once."""
    return (label != label[i]) & (np.arange(len(label)) > i if outer.all() else ~outer)


def _kept(table: pa.Table, percent: int) -> pa.Table:
    """The members of a cell with a partner that the bound leaves, named by what they are together."""
    table = table.sort_by("node")
    label, outer = table["component"].to_numpy(), table["outer"].to_numpy(zero_copy_only=False)
    tree, kept = CountTree(_grid(table["point"]), table["n_shingles"].to_numpy()), np.zeros(len(label), bool)
    for i in np.flatnonzero(outer):
        wanted = _wanted(i, label, outer)
        found = tree.search(i, wanted, percent) if wanted.any() else []
        kept[found] = True
        kept[i] |= len(found) > 0
    left = table.select(["node", "component", "outer"]).filter(pa.array(kept))
    who = hashlib.blake2b(left["node"].to_numpy().tobytes() + left["outer"].to_numpy(zero_copy_only=False).tobytes(), digest_size=16).digest()
    return left.append_column("who", pa.array([who] * len(left), pa.binary()))


def _searched(table: pa.Table, percent: int) -> pa.Table:
    """Links between components inside one cell, enough to join all that are linked."""
    table = table.sort_by("node")
    nodes, label = table["node"].to_numpy(), table["component"].to_numpy().copy()
    outer = table["outer"].to_numpy(zero_copy_only=False)
    tokens, cuts = token_sets(table["text"])
    tree = CountTree(points(tokens, cuts), np.diff(cuts))
    u, v = [], []
    for i in np.flatnonzero(outer):
        wanted = _wanted(i, label, outer)
        for j in tree.search(i, wanted, percent) if wanted.any() else ():
            if label[j] != label[i] and linked(tokens[cuts[i] : cuts[i + 1]], tokens[cuts[j] : cuts[j + 1]], percent):
                u.append(int(nodes[i])), v.append(int(nodes[j]))
                label[label == label[j]] = label[i]
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _cells(members: DataFrame) -> DataFrame:
    """Deal ``key, node, component, n_shingles`` out to cells: ``key, a, b, node, component, outer``.

    A cell holds members of the commonest component of its bucket beside others, or two parts of the others.
    """
    by_part = members.groupBy("key", "component").agg(F.count("*").alias("rows"), F.sum("n_shingles").alias("bulk"))
    top = F.max(F.struct("rows", "bulk", "component"))
    bulk = by_part.groupBy("key").agg(top.alias("top"), F.sum("rows").alias("rows"), F.sum("bulk").alias("bulk"))

    def parts(rows: Column, tokens: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(rows / CELL_ROWS), F.ceil(tokens / CELL_TOKENS)).cast("int")

    plan = bulk.select(
        "key", F.col("top.component").alias("main"),
        parts(F.col("top.rows"), F.col("top.bulk")).alias("main_parts"),
        parts(F.col("rows") - F.col("top.rows"), F.col("bulk") - F.col("top.bulk")).alias("outer_parts"),
    )
    dealt = members.join(plan.hint("merge"), "key").withColumn("outer", F.col("component") != F.col("main"))
    place = F.xxhash64("node")
    own = F.when(F.col("outer"), F.pmod(place, "outer_parts")).otherwise(F.pmod(place, "main_parts")).cast("int")

    def up_to(name: str) -> Column:
        return F.sequence(F.lit(0), F.col(name) - 1)

    def cell(kind: int, a: Column, b: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), a.alias("a"), b.alias("b"))

    mine = F.col("own")
    beside = F.transform(up_to("main_parts"), lambda i: cell(0, mine, i))
    squares = F.transform(up_to("outer_parts"), lambda k: cell(1, F.least(mine, k), F.greatest(mine, k)))
    main = F.transform(up_to("outer_parts"), lambda j: cell(0, j, mine))
    cells = F.when(F.col("outer"), F.concat(beside, squares)).otherwise(main)
    return dealt.withColumn("own", own).select("key", F.explode(cells).alias("cell"), "node", "component", "outer").select(
        "key", "cell.*", "node", "component", "outer"
    )


def across(members: DataFrame, nodes: DataFrame, bodies: DataFrame, percent: int) -> DataFrame:
    """Links ``u, v`` between components inside buckets, of ``key, node, component, n_shingles``."""
    spark = members.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # named, as small rows here mean much work
    full = _cells(members).join(nodes.hint("merge"), "node").repartition(tasks, "key", "kind", "a", "b")
    kept = full.groupBy("key", "kind", "a", "b").applyInArrow(lambda t: _kept(t, percent), "node long, component long, outer boolean, who binary")
    kept = stored(kept, "kept").dropDuplicates(["who", "node"]).join(bodies.hint("merge"), "node").repartition(tasks, "who")
    return kept.groupBy("who").applyInArrow(lambda t: _searched(t, percent), "u long, v long").distinct()


# ---- the join ------------------------------------------------------------------------


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row: the smallest id that links lead to from a similarity of ``percent`` on."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    marked = stored(signed(rows, percent), "signatures")
    alone = F.col("doc_id").isNull() | F.col("set_hash").isNull()
    named = marked.where(~alone)
    one = F.min(F.struct("doc_id", "text_hash", "n_shingles", "point", "blocks"))
    grouped = named.groupBy("set_hash").agg(one.alias("one"), F.count("*").alias("n"))
    classes = stored(grouped.select("set_hash", "n", "one.*").withColumn("node", F.monotonically_increasing_id()), "classes")

    nodes = classes.select("node", "point", "n_shingles")

    keys = classes.select("node", F.explode("blocks").alias("key"))
    buckets = stored(keys.groupBy("key").agg(F.min("node").alias("pivot"), F.count("*").alias("n")).where("n > 1"), "buckets")
    members = stored(keys.join(buckets.hint("merge"), "key").where("node != pivot"), "members")  # key, node, pivot, n

    pairs = stored(members.select(F.col("pivot").alias("u"), F.col("node").alias("v")).distinct(), "pairs")
    involved = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    wanted = classes.join(involved, "node").select("node", "doc_id", "text_hash")
    found = rows.hint("merge").join(wanted, ["doc_id", "text_hash"])
    bodies = stored(found.dropDuplicates(["doc_id", "text_hash"]).select("node", "text"), "bodies")
    links = stored(verified(stored(bounded(pairs, nodes, percent), "near"), bodies, percent), "links")

    near = components(links).withColumnRenamed("id", "node")
    state = members.select("key", "node").join(near, "node", "left").withColumn("component", F.coalesce("component", "node"))
    state = stored(state, "state")
    mixed = state.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    rest = stored(state.join(mixed.hint("merge"), "key").join(nodes.select("node", "n_shingles").hint("merge"), "node"), "rest")
    links = stored(links.union(across(rest, nodes, bodies, percent)), "links")

    label = F.coalesce("component", "node")
    reached = classes.select("node", "set_hash", "n", "doc_id").join(components(links).withColumnRenamed("id", "node"), "node", "left").withColumn("component", label)
    reached = stored(reached, "reached")
    least = reached.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    labels = reached.drop("doc_id").join(least.hint("merge"), "component")
    result = hot_join(named.select("doc_id", "n_shingles", "set_hash"), stored(labels.select("set_hash", "n", "component_id"), "labels"), "set_hash", "n")
    single = marked.where(alone).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return result.select("doc_id", "n_shingles", "component_id").union(single)
