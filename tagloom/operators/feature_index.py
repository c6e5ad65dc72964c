"""Numbers for features without collisions: a minimal perfect hash, built and asked in parts.

The distinct features, as 64-bit hashes, are dealt to buckets of about KEYS. A task finds for its bucket a hash without
collisions: keys fall into groups of about four, and each group, the largest first, gets the first seed that sends all its keys
to places that are still free; groups of one size are tried together. So a bucket of n keys needs n places, a seed for each group and a check value for each key,
and a running sum over the buckets makes the places numbers from 0 up. A feature that was not seen falls on the place
of one that was, and the check value, 32 bits that do not depend on the place, tells them apart.

Different features must not share a 64-bit hash: this is counted, and the hash is drawn anew if two do.

Defined cases: null is no feature; an empty table gives an empty index, in which nothing is found.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.session import freeze

# Tasks get this module by value, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEYS = 2000
GROUP = 4
TRIES = 1 << 13  # places looked at together, of all groups of one size that wait for a seed
BUCKET_SCHEMA = "bucket int, n int, seeds binary, checks binary"


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _check(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)


def _group(keys: np.ndarray, groups: int) -> np.ndarray:
    return (mix(keys + np.uint64(0x2545F4914F6CDD1D)) % np.uint64(groups)).astype(np.int64)


def _place(keys: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    return (mix(keys ^ mix(seeds.astype(np.uint64) + np.uint64(1))) % np.uint64(n)).astype(np.int64)


def build_bucket(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds by group and check values by place, for distinct keys."""
    n = len(keys)
    groups = max(1, n // GROUP)
    owner = _group(keys, groups)
    order = np.argsort(owner, kind="stable")
    sizes = np.bincount(owner, minlength=groups)
    cuts = np.cumsum(sizes) - sizes
    seeds, free, checks = np.zeros(groups, np.uint32), np.ones(n, bool), np.zeros(n, np.uint32)
    for size in np.unique(sizes[sizes > 0])[::-1]:
        waiting = np.flatnonzero(sizes == size)
        mine = keys[order[cuts[waiting][:, None] + np.arange(size)]]
        first = np.zeros(len(waiting), np.int64)
        while len(waiting):
            tried = first[:, None] + np.arange(max(1, TRIES // mine.size))
            at = _place(mine[:, :, None], tried[:, None, :], n)
            good = free[at].all(axis=1)
            if size > 1:
                good &= (np.diff(np.sort(at, axis=1), axis=1) != 0).all(axis=1)
            pick, found = good.argmax(axis=1), good.any(axis=1)
            taken = np.take_along_axis(at, pick[:, None, None], axis=2)[:, :, 0]
            # Of the groups that found the same place free, the first gets it.
            asks = np.flatnonzero(found)
            winner = np.zeros(n, np.int64)
            winner[taken[asks][::-1].ravel()] = np.repeat(asks[::-1], size)
            done = asks[(winner[taken[asks]] == asks[:, None]).all(axis=1)]
            seeds[waiting[done]] = tried[done, pick[done]]
            free[taken[done]] = False
            checks[taken[done]] = _check(mine[done])
            left = np.setdiff1d(np.arange(len(waiting)), done)
            first = (first + np.where(found, pick, tried.shape[1]))[left]
            waiting, mine = waiting[left], mine[left]
    return seeds, checks


def find(keys: np.ndarray, seeds: np.ndarray, checks: np.ndarray) -> np.ndarray:
    """The place of each key in its bucket, -1 for keys that were not there."""
    if not len(checks):
        return np.full(len(keys), -1)
    at = _place(keys, seeds[_group(keys, len(seeds))], len(checks))
    return np.where(checks[at] == _check(keys), at, -1)


@dataclass
class FeatureIndex:
    """``buckets`` (bucket, offset, n, seeds, checks) of ``size`` features hashed with ``seed``."""

    buckets: DataFrame
    count: int
    size: int
    seed: int

    def hashed(self, feature: Column) -> Column:
        """The hash of a feature's text, null for null."""
        return hashed(feature, self.seed)

    def number(self, pairs: DataFrame, col: str = "h", out: str = "id") -> DataFrame:
        """Add the numbers of hashed features, -1 for features that were not seen; rows meet their bucket by a shuffle."""
        bucket = F.pmod(F.col(col), F.lit(self.count)).cast("int")
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema)

        def run(rows: pa.Table, index: pa.Table) -> pa.Table:
            ids = np.full(len(rows), -1)
            if len(index):
                keys = rows[col].to_numpy().view(np.uint64)
                at = find(keys, np.frombuffer(index["seeds"][0].as_py(), np.uint32), np.frombuffer(index["checks"][0].as_py(), np.uint32))
                ids = np.where(at < 0, -1, at + index["offset"][0].as_py())
            return rows.drop_columns("_bucket").append_column(out, pa.array(ids, pa.int64()))

        both = pairs.withColumn("_bucket", bucket).groupBy("_bucket").cogroup(self.buckets.groupBy("bucket"))
        return both.applyInArrow(run, f"{kinds}, {out} long")


def hashed(feature: Column, seed: int) -> Column:
    return F.when(feature.isNotNull(), F.xxhash64(feature, F.lit(seed)))


def build_index(features: DataFrame, col: str = "feature") -> FeatureIndex:
    """An index of the distinct values of a text column."""
    distinct = freeze(features.select(F.col(col).alias("feature")).where("feature IS NOT NULL").distinct())
    size, seed = distinct.count(), 0
    while distinct.select(hashed(F.col("feature"), seed).alias("h")).distinct().count() < size:
        seed += 1
    count = max(1, -(-size // KEYS))

    def build(table: pa.Table) -> pa.Table:
        keys = table["h"].to_numpy().view(np.uint64)
        seeds, checks = build_bucket(keys)
        found = {"bucket": table["bucket"].slice(0, 1), "n": pa.array([len(keys)], pa.int32()),
                 "seeds": pa.array([seeds.tobytes()], pa.binary()), "checks": pa.array([checks.tobytes()], pa.binary())}
        return pa.table(found)

    keys = distinct.select(hashed(F.col("feature"), seed).alias("h"))
    built = keys.withColumn("bucket", F.pmod("h", F.lit(count)).cast("int")).groupBy("bucket").applyInArrow(build, BUCKET_SCHEMA)
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # over one row per bucket
    sizes = freeze(built)
    offsets = sizes.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("offset"))
    return FeatureIndex(freeze(sizes.join(offsets, "bucket")), count, size, seed)
