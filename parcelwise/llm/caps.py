"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction, and a vector passes if its inner product with it exceeds a
threshold: it lies in a cap. Directions are a product code: after a random rotation the
space is cut in two halves with B random unit vectors each, and each pair of them is a
direction. A vector is decoded to all filters it passes: codes of one half that can still
reach the threshold with the best of the other half, and for each of those the sorted
tail of the other half. Vectors of one filter are compared exactly.

Two vectors of cosine 0.95 share about two thirds of the ``HITS`` filters each passes on
average. A vector that lies badly to the code passes few; it goes to its ``LEAST`` best
filters then, which its neighbours mostly share. The threshold is the normal quantile at
which a filter holds ``BUCKET`` vectors, and B follows from it, so caps get smaller and
more numerous as the table grows by one rule.

Equal vectors are one class from the start. A filter with more than ``BLOCK`` classes is
cut into slices, and each pair of slices is a task's group. Pairs are never written: a
group counts for each class the links whose first common filter it is, and names the
smallest class it is linked with through the group.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batches_of, small_batches, stage
from .components import components
from .vectors import matrix, usable

BUCKET = 128
HITS = 32
LEAST = 24
BLOCK = 2048
FOUND = "id long, links long, root long"


class Caps:
    """The filters for about ``classes`` vectors of ``width`` components."""

    def __init__(self, width: int, classes: int, seed: int = 0):
        rng = np.random.default_rng(seed)
        width = max(2, width)
        share = min(0.1, BUCKET / max(1, classes))
        self.codes = int(np.ceil(np.sqrt(HITS / share)))
        self.rotation = np.linalg.qr(rng.normal(size=(width, width)))[0]
        self.half = width // 2
        self.first, self.second = (
            (c := rng.normal(size=(self.codes, n))) / np.linalg.norm(c, axis=1, keepdims=True)
            * np.sqrt(n / width)
            for n in (self.half, width - self.half)
        )
        self.least = NormalDist().inv_cdf(1 - share) / np.sqrt(width)

    def decode(self, vectors: np.ndarray) -> list[np.ndarray]:
        """The sorted filters of each unit vector: all it passes, and its LEAST best ones."""
        turned = np.zeros((len(vectors), len(self.rotation)))
        turned[:, : vectors.shape[1]] = vectors
        turned = turned @ self.rotation
        ones, twos = turned[:, : self.half] @ self.first.T, turned[:, self.half :] @ self.second.T
        out = []
        for one, two in zip(ones, twos):
            order = np.argsort(-two)
            falling = -two[order]
            able = np.flatnonzero(one >= self.least + falling[0])
            counts = np.searchsorted(falling, one[able] - self.least, "right")
            tails = np.concatenate([order[:0], *[order[:c] for c in counts]])
            found = np.repeat(able, counts) * self.codes + tails
            if len(found) < LEAST:
                # The best sums are among those of the best codes of both halves.
                heads, tails = np.argsort(-one)[:LEAST], order[:LEAST]
                sums = (one[heads][:, None] + two[tails][None, :]).ravel()
                best = np.argsort(-sums, kind="stable")[:LEAST]
                found = np.union1d(found, heads[best // len(tails)] * self.codes + tails[best % len(tails)])
            out.append(np.sort(found))
        return out


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)  # no overflow in the squares
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def compare(caps: Caps, name: int, ids, slices, weights, vectors, pair, least: float, lists: dict):
    """Rows of FOUND for one group: classes of one filter, within a slice or between two."""
    close = vectors @ vectors.T >= least
    np.fill_diagonal(close, False)
    if pair[0] != pair[1]:
        close &= slices[:, None] != slices[None, :]
    linked = np.flatnonzero(close.any(1))
    if not len(linked):
        return
    close, ids, weights = close[np.ix_(linked, linked)], ids[linked], weights[linked]
    new = [k for k, i in enumerate(ids.tolist()) if i not in lists]
    if new:
        for k, found in zip(new, caps.decode(vectors[linked[new]])):
            lists[int(ids[k])] = found
    # Links found in an earlier filter too are counted there.
    earlier = [lists[i][lists[i] < name] for i in ids.tolist()]
    names, place = np.unique(np.concatenate(earlier), return_inverse=True)
    before = np.zeros((len(ids), len(names)), np.float32)
    before[np.repeat(np.arange(len(ids)), [len(e) for e in earlier]), place] = 1
    first_here = close & (before @ before.T < 0.5)
    counts = first_here @ weights
    root = ids.copy()
    while True:
        lower = np.where(close, root[None, :], np.iinfo(np.int64).max).min(1)
        lower = np.minimum(root, lower)
        if (lower == root).all():
            break
        root = lower
    yield from zip(ids.tolist(), counts.tolist(), root.tolist())


def link_classes(classes: DataFrame, width: int, least: float) -> DataFrame:
    """FOUND rows of ``classes`` (id, vector, n): any number per class, links to be added up."""
    spark = classes.sparkSession
    caps = Caps(width, classes.count())
    shared = spark.sparkContext.broadcast(caps)

    def names(batches):
        for batch in batches:
            if batch.num_rows:
                lists = shared.value.decode(unit(matrix(batch.column("vector"), width)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(lists))], names=["filter"])

    def decode(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = shared.value.decode(unit(matrix(batch.column("vector"), width)))
            rows = pa.array(np.repeat(np.arange(batch.num_rows), [len(x) for x in lists]))
            columns = [batch.column(c).take(rows) for c in ("id", "n", "vector")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(lists)), *columns], names=["filter", "id", "n", "vector"]
            )

    # Vectors keep the type they have, and pass one shuffle; how full the filters are is
    # counted from their names alone.
    kind = classes.schema["vector"].dataType.simpleString()
    passed = classes.mapInArrow(decode, f"filter long, id long, n long, vector {kind}")
    full = (
        classes.mapInArrow(names, "filter long").groupBy("filter").count()
        .filter(F.col("count") > BLOCK)
        .select("filter", F.ceil(F.col("count") / BLOCK).cast("int").alias("slices"))
    )
    full = stage(full, "full-filters")
    slices = F.coalesce("slices", F.lit(1))
    rows = (
        passed.join(full, "filter", "left")
        .withColumn("slice", F.pmod(F.xxhash64("id"), slices).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), slices - 1)))
        .select(
            "filter", F.least("slice", "other").alias("a"), F.greatest("slice", "other").alias("b"),
            "id", "slice", "n", "vector",
        )
    )
    key = ["filter", "a", "b"]

    def run(batches):
        lists: dict = {}
        held_key, held = None, []

        def solve():
            ids, cut, n, vectors = zip(*held)
            if len(lists) > 20_000:
                lists.clear()
            return compare(
                shared.value, held_key[0], np.array(ids), np.array(cut), np.array(n),
                unit(np.array(vectors)), held_key[1:], least, lists,
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in [*key, "id", "slice", "n"]]
            vectors = matrix(batch.column("vector"), width) if batch.num_rows else []
            for f, a, b, i, cut, n, v in zip(*columns, vectors):
                if (f, a, b) != held_key:
                    if len(held) > 1:
                        yield from solve()
                    held_key, held = (f, a, b), []
                held.append((i, cut, n, v))
        if len(held) > 1:
            yield from solve()

    dealt = rows.repartition(*key).sortWithinPartitions(*key)
    return stage(dealt.mapInArrow(lambda b: batches_of(run(b), FOUND), FOUND), "cap-links")


def near_duplicates(df: DataFrame, least: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of ``df`` (vec_id, embedding).

    Rows link whose vectors' cosine, in doubles, is at least ``least``. Vectors that are
    null or zero, hold null or non-finite components, or have no vec_id link with none;
    shorter vectors are filled with zeros. Rows that repeat a vec_id are vectors of their
    own with one component_id. An empty table gives no rows.
    """
    spark = small_batches(df.sparkSession)
    rows = df.select("vec_id", F.col("embedding").alias("vector"))
    some = F.exists("vector", lambda x: x != 0)
    good = F.col("vec_id").isNotNull() & usable(F.col("vector")) & F.coalesce(some, F.lit(False))
    used = rows.filter(good)
    # A class is named by its vector's hash: a vec_id may stand on different vectors.
    classes = used.groupBy("vector").agg(
        F.min("vec_id").alias("smallest"), F.count("*").alias("n"), F.xxhash64("vector").alias("id")
    )
    classes = stage(classes, "vector-classes")
    width = classes.agg(F.max(F.size("vector"))).first()[0] or 0
    found = link_classes(classes, width, least)
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    members = classes.select(F.col("id").alias("node"), "smallest").join(roots, "node")
    lowest = members.groupBy("root").agg(F.min("smallest").alias("component_id"))
    roots = roots.join(lowest, "root").select(F.col("node").alias("id"), "component_id")
    told = (
        classes.join(links, "id", "left")
        .join(roots, "id", "left")
        .select(
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component_id", "smallest").alias("component_id"),
        )
    )
    return rows.select("vec_id", F.when(good, F.col("vector")).alias("vector")).join(
        told, "vector", "left"
    ).select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"),
    )
