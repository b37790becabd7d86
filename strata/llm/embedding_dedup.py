"""Near-duplicate vectors by random-hyperplane sign hashing in several tables.

Vectors meet only under the same label and length. Equal vectors are folded into one
set with its number of rows, so a vector repeated in a third of all rows costs one.
Every set gets one key per table: the signs of its products with random hyperplanes.
Two sets at cosine c agree in a sign with probability 1 - arccos(c)/pi. The number
of signs grows with the logarithm of the largest label's sets, so that strangers
rarely meet, and the number of tables follows from the target recall at the
threshold.

Buckets with one set end there. Others are cut into chunks of about ``CHUNK`` sets,
and every pair of chunks is one tile, so a bucket of any size is spread over tasks and
a task holds one tile. A tile multiplies unit vectors in double precision and keeps
what reaches the threshold: a pair counts in the first table in which its keys agree,
so no pair counts twice. Tasks return sums per set and a spanning forest of the
tile's links, never the pairs. Components are found from the forests, distributed.

Cases: null ids and labels, null, empty and zero vectors, and vectors with null or
non-finite components are rows of their own without links; repeated ids are separate
rows; vectors of other lengths link with nothing; extra columns are not read; an
empty table gives an empty result. The seed fixes the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written
from strata.llm.components import connected_components

CHUNK = 4096     # sets of one side of a tile, about
SLAB = 512       # rows multiplied at once
SMALL = 24       # groups up to this size are compared together, by offsets
SPARE_BITS = 3   # signs beyond the logarithm of a label's sets


def tables_for(threshold: float, sets: int, recall: float) -> tuple[int, int]:
    """(signs of a key, number of tables) for labels of at most ``sets`` sets."""
    bits = min(62, max(8, math.ceil(math.log2(max(sets, 2))) + SPARE_BITS))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, 1 if agree >= recall else math.ceil(math.log(1 - recall) / math.log(1 - agree))


def usable(vec: Column) -> Column:
    """Whether a vector can link: finite components, not all of them zero."""
    inf = F.lit(float("inf"))
    return F.coalesce(F.forall(vec, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < inf))
                      & F.exists(vec, lambda x: x != 0), F.lit(False))


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaling by the largest component first keeps the squares finite."""
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _signer(bits: int, tables: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            sizes = batch.column("dim").to_numpy(zero_copy_only=False)
            keys = np.zeros((batch.num_rows, tables), np.int64)
            for dim in np.unique(sizes).tolist():
                if dim not in planes:
                    planes.clear()
                    planes[dim] = np.random.default_rng([seed, dim]).standard_normal((dim, tables * bits))
                rows = np.flatnonzero(sizes == dim)
                unit = units(_matrix(batch.column("vec").take(pa.array(rows))).astype(np.float64))
                signs = (unit @ planes[dim] > 0).reshape(len(rows), tables, bits)
                keys[rows] = signs @ weights
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * tables)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))],
                names=[*batch.schema.names, "keys"])
    return run


class _Tile:
    """Rows of whole tiles, sorted by tile, and the links found among them."""

    def __init__(self, batch: pa.Table, threshold: float):
        self.threshold = threshold
        self.ids = batch.column("set").to_numpy()
        self.copies = batch.column("n").to_numpy()
        self.unit = units(_matrix(batch.column("vec").combine_chunks()).astype(np.float64))
        self.keys = _matrix(batch.column("keys").combine_chunks())
        self.table = batch.column("t").to_numpy()
        self.side = batch.column("side").to_numpy()
        self.links = np.zeros(len(self.ids), np.int64)
        self.root = np.arange(len(self.ids))

    def new(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs whose keys agree in no earlier table."""
        for t in range(int(self.table[i].max(initial=0))):
            fresh = (self.keys[i, t] != self.keys[j, t]) | (self.table[i] <= t)
            i, j = i[fresh], j[fresh]
        return i, j

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        i, j = self.new(i, j)
        if not len(i):
            return
        np.add.at(self.links, i, self.copies[j])
        np.add.at(self.links, j, self.copies[i])
        while True:  # hang the larger root of a link below the smaller one
            one, two = self.root[i], self.root[j]
            if np.array_equal(one, two):
                return
            np.minimum.at(self.root, np.maximum(one, two), np.minimum(one, two))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up

    def small(self, first: np.ndarray, last: np.ndarray) -> None:
        """Tiles of few rows (from ``first`` to before ``last``), all at once."""
        size = last - first
        end = np.repeat(last, size)
        # Positions first, first + 1, ... of every tile.
        place = np.arange(len(end)) + np.repeat(first - (np.cumsum(size) - size), size)
        for d in range(1, int(size.max(initial=1))):
            i = place[place + d < end]
            j = i + d
            i, j = (x[(self.side[i] == 0) | (self.side[i] != self.side[j])] for x in (i, j))
            near = np.einsum("ij,ij->i", self.unit[i], self.unit[j]) >= self.threshold
            self.link(i[near], j[near])

    def large(self, first: int, last: int) -> None:
        """One tile, slab by slab."""
        side = self.side[first:last]
        for at in range(first, last, SLAB):
            to = min(at + SLAB, last)
            near = self.unit[at:to] @ self.unit[at:last].T >= self.threshold
            near &= np.arange(at, last)[None, :] > np.arange(at, to)[:, None]
            if side[0]:
                near &= side[at - first:to - first, None] != side[None, at - first:]
            i, j = np.nonzero(near)
            self.link(i + at, j + at)

    def rows(self) -> pa.RecordBatch:
        """(a, b, links): sums per set (b null), and the forest's edges (links null)."""
        some = np.flatnonzero(self.links)
        tied = np.flatnonzero(self.root != np.arange(len(self.root)))
        one, two = len(some), len(tied)
        return pa.RecordBatch.from_arrays([
            pa.array(np.r_[self.ids[some], self.ids[tied]]),
            pa.array(np.r_[np.zeros(one, np.int64), self.ids[self.root[tied]]],
                     mask=np.r_[np.ones(one, bool), np.zeros(two, bool)]),
            pa.array(np.r_[self.links[some], np.zeros(two, np.int64)],
                     mask=np.r_[np.zeros(one, bool), np.ones(two, bool)])], names=["a", "b", "links"])


def _verifier(threshold: float):
    def solved(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        tile = _Tile(rows, threshold)
        first, last = starts, np.r_[starts[1:], rows.num_rows]
        few = last - first <= SMALL
        tile.small(first[few], last[few])
        for a, b in zip(first[~few].tolist(), last[~few].tolist(), strict=True):
            tile.large(a, b)
        return tile.rows()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # All rows of one tile are neighbours; the last tile may go on.
            held.append(batch)
            ends = batch.column("tile").to_numpy()
            if held[0].column("tile")[0].as_py() == ends[-1]:
                continue
            rows = pa.Table.from_batches(held)
            done = int(np.flatnonzero(rows.column("tile").to_numpy() != ends[-1])[-1]) + 1
            yield from _by_dim(rows.slice(0, done), solved)
            held = rows.slice(done).combine_chunks().to_batches()
        if held:
            yield from _by_dim(pa.Table.from_batches(held), solved)
    return run


def _by_dim(rows: pa.Table, solved) -> Iterator[pa.RecordBatch]:
    """Whole tiles solved, those whose vectors have one length (rows are sorted by it)
    together. A tile is named by two hashes, so that buckets do not mix."""
    tile, mark = (rows.column(c).to_numpy() for c in ("tile", "mark"))
    starts = np.r_[0, np.flatnonzero((tile[1:] != tile[:-1]) | (mark[1:] != mark[:-1])) + 1]
    dims = rows.column("dim").to_numpy()[starts]
    cuts = [0, *(np.flatnonzero(dims[1:] != dims[:-1]) + 1).tolist(), len(starts)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        low = int(starts[a])
        high = int(starts[b]) if b < len(starts) else rows.num_rows
        yield solved(rows.slice(low, high - low), starts[a:b] - low)


def near_vectors(vectors: DataFrame, threshold: float = 0.98, recall: float = 0.9999,
                 id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                 seed: int = 2024) -> DataFrame:
    """One row per row of ``vectors``: id, n_links (rows at cosine ``threshold`` or more
    under its label), component_id (smallest id reachable by links) and kept (whether
    the row's id is that). ``recall`` is the chance of meeting a pair at the threshold."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                          F.col(vec_col).alias("vec"))
    fit = F.col("label").isNotNull() & usable(F.col("vec"))
    keyed = rows.where(fit).withColumns({
        "h1": F.xxhash64("vec"), "h2": F.xxhash64(F.reverse("vec"), F.lit(seed)), "dim": F.size("vec")})
    one = ["label", "dim", "h1", "h2"]
    folded = keyed.groupBy(*one).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"),
                                     F.any_value("vec").alias("vec"))
    sets = written(folded.withColumn("set", F.monotonically_increasing_id()), "vector-sets")
    largest = sets.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    bits, tables = tables_for(threshold, largest, recall)

    wide = sets.select("set", "n", "dim", "label", "vec")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wide.schema) + ", keys array<long>"
    signed = written(wide.mapInArrow(_signer(bits, tables, seed), ddl), "vector-keys")
    bucket = ["label", "dim", "t", "key"]
    cells = signed.select("set", "label", "dim", F.posexplode("keys").alias("t", "key"))
    shared = cells.groupBy(*bucket).agg(F.count(F.lit(1)).alias("sets")).where("sets > 1").select(
        *bucket, F.ceil(F.col("sets") / CHUNK).cast("int").alias("chunks"))
    placed = cells.join(shared, bucket).withColumn(
        "mine", F.pmod(F.xxhash64("set", F.lit(seed)), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    # A tile is named by its bucket and two chunks; side 0 marks tiles of one chunk,
    # elsewhere only rows of different sides meet.
    name = [*bucket, F.least("mine", "other"), F.greatest("mine", "other")]
    tiled = placed.select("*", other).select(
        "set", "t", F.col("dim").alias("d"), F.xxhash64(*name).alias("tile"),
        F.xxhash64(F.lit(seed), *name).alias("mark"),
        F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2)
        .alias("side"))
    full = tiled.join(signed.select("set", "n", "dim", "vec", "keys"), "set").select(
        "d", "tile", "mark", "t", "side", "set", "n", "dim", "vec", "keys")
    found = written(full.repartition("tile").sortWithinPartitions("d", "tile", "mark").drop("d").mapInArrow(
        _verifier(threshold), "a long, b long, links long"), "vector-links")

    links = found.where("links is not null").groupBy(F.col("a").alias("set")).agg(
        F.sum("links").alias("links"))
    labels = connected_components(found.where("b is not null").select(
        F.col("a").alias("u"), F.col("b").alias("v"))).withColumnsRenamed({"node": "set", "label": "root"})
    whole = sets.select("set", *one, "first", "n").join(links, "set", "left").join(labels, "set", "left")
    whole = whole.withColumn("root", F.coalesce("root", "set"))
    smallest = whole.groupBy("root").agg(F.min("first").alias("component"))
    classes = whole.join(smallest, "root").select(
        *one, (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component")
    linked = keyed.select("id", *one).join(classes, one).select("id", "n_links", "component")
    alone = rows.where(~fit).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))
