"""Exact top-k inner products by a Voronoi join.

The largest inner products are the smallest distances once every data vector x gets one
more component, the root of M^2 - |x|^2 with M the largest norm, and every query a zero.
Data and queries go to their nearest of ``PIVOTS`` pivots, and each cell of data is
summarised by shells of distance from its pivot: count, least and largest distance. For a
cell of queries of radius U around pivot p, every vector of a shell lies within
|p p'| + U + largest; shells taken in that order until they hold k + 1 vectors bound the
k-th distance. A shell is sent to a cell only if its lower bound stays within that.

Cells of queries are joined to runs, and runs cut to parts of about ``QUERIES`` queries;
what a run needs is dealt out in chunks of about ``ROWS`` vectors. A task solves one part
against one chunk by a matrix product, and the chunks' answers meet in a ranking.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import batches_of, small_batches, stage
from .vectors import matrix

PIVOTS = 64
SHELLS = 64
QUERIES = 2048
ROWS = 4096
# Below this size of components a sum of products is exact in doubles.
EXACT = 1 << 20

ASSIGNED = "id long, vector array<long>, cell int, distance double"
FOUND = "query_id long, vec_id long, score long"


def pivots_of(data: DataFrame, width: int, largest: float) -> np.ndarray:
    """PIVOTS data vectors with their extra component, drawn by the hash of id and vector."""
    rows = data.orderBy(F.xxhash64("id", "vector"), "id", "vector").limit(PIVOTS).collect()
    out = np.zeros((len(rows), width + 1))
    for k, r in enumerate(rows):
        out[k, : len(r.vector)] = r.vector
    out[:, width] = np.sqrt(np.maximum(largest - (out**2).sum(1), 0))
    return out


def assign(df: DataFrame, pivots: np.ndarray, largest: float | None) -> DataFrame:
    """Nearest pivot and its distance; ``largest`` squared norm for data, None for queries."""
    shared = df.sparkSession.sparkContext.broadcast(pivots)
    width = pivots.shape[1] - 1

    def run(batches):
        at = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = matrix(batch.column("vector"), width)
            norms = (vectors**2).sum(1)
            extra = np.zeros(len(norms)) if largest is None else np.sqrt(np.maximum(largest - norms, 0))
            whole = np.concatenate([vectors, extra[:, None]], axis=1)
            far = (whole**2).sum(1)[:, None] + (at**2).sum(1) - 2 * whole @ at.T
            cells = far.argmin(1)
            distance = np.sqrt(((whole - at[cells]) ** 2).sum(1))
            yield from zip(
                batch.column("id").to_pylist(), batch.column("vector").to_pylist(),
                cells.tolist(), distance.tolist(),
            )

    return df.select("id", "vector").mapInArrow(
        lambda b: batches_of(run(b), ASSIGNED, 1000), ASSIGNED
    )


def plan(pivots: np.ndarray, shells: list, cells: list, k: int) -> tuple[dict, list, dict]:
    """From the summaries: the run of each query cell, the needs (cell, shell, run) and the
    number of vectors each run needs. ``shells``: (cell, shell, n, low, high); ``cells``: (cell, n, radius)."""
    apart = np.sqrt(np.maximum(((pivots[:, None] - pivots[None]) ** 2).sum(2), 0))
    of = np.array([s[0] for s in shells])
    counts, low, high = (np.array([s[i] for s in shells], float) for i in (2, 3, 4))
    needed = {}
    for cell, _, radius in cells:
        upper = apart[cell, of] + radius + high
        order = np.argsort(upper, kind="stable")
        enough = np.searchsorted(np.cumsum(counts[order]), k + 1)
        bound = upper[order[enough]] if enough < len(order) else np.inf
        lower = np.maximum(apart[cell, of] - radius - high, low - apart[cell, of] - radius)
        needed[cell] = lower <= bound * (1 + 1e-9) + 1e-6
    runs, totals, held = {}, {}, 0
    left = {cell: n for cell, n, _ in cells}
    at = min(left, default=None)
    while left:  # from each cell on to the nearest one left
        n = left.pop(at)
        if not totals or held + n > QUERIES:
            totals[len(totals)] = np.zeros(len(shells), bool)
            held = 0
        run = len(totals) - 1
        runs[at], held = run, held + n
        totals[run] |= needed[at]
        at = min(left, key=lambda c: (apart[at, c], c), default=None)
    needs = [(*shells[s][:2], run) for run, mask in totals.items() for s in np.flatnonzero(mask)]
    return runs, needs, {run: int(counts[mask].sum()) for run, mask in totals.items()}


def solve(queries: pd.DataFrame, data: pd.DataFrame, k: int) -> pd.DataFrame:
    """Each query's k best of the data, ties to the smaller id; its own row is left out."""
    if queries.empty or data.empty:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
    data = data.sort_values("id")
    width = max(max(map(len, queries["vector"])), max(map(len, data["vector"])))

    def whole(column):
        out = np.zeros((len(column), width), np.int64)
        for row, v in zip(out, column):
            row[: len(v)] = v
        return out

    q, d = whole(queries["vector"]), whole(data["vector"])
    if max(np.abs(q).max(initial=0), np.abs(d).max(initial=0)) < EXACT and width < 4096:
        scores = (q.astype(np.float64) @ d.T.astype(np.float64)).astype(np.int64)
    else:  # exact in Python's integers, then within the range of a long
        exact = q.astype(object) @ d.T.astype(object)
        scores = np.clip(exact, -(2**63) + 1, 2**63 - 1).astype(np.int64)
    own = queries["id"].to_numpy()[:, None] == data["id"].to_numpy()[None, :]
    lowest = np.iinfo(np.int64).min
    scores[own] = lowest
    out = []
    ids = data["id"].to_numpy()
    kth = -np.partition(-np.maximum(scores, lowest + 1), min(k, len(ids)) - 1, axis=1)[:, min(k, len(ids)) - 1]
    for query, row, least in zip(queries["id"].tolist(), scores, kth):
        near = np.flatnonzero((row >= least) & (row != lowest))
        near = near[np.argsort(-row[near], kind="stable")][:k]
        out += [(query, int(ids[j]), int(row[j])) for j in near]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")


def top_k(queries: DataFrame, data: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: per row of ``queries`` (id, vector) the k largest inner
    products with ``data`` (id, vector), vectors being arrays of longs.

    Ties go to the smaller vec_id, and a query's own id is left out. Different vectors of
    one id are candidates of their own, equal rows are one; of queries with one id the
    least vector counts. Rows with a null id or vector take no part; vectors of different
    lengths are filled with zeros. Without data or queries there are no rows.
    """
    small_batches(data.sparkSession)
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)

    def known(df):
        return df.select("id", "vector").filter(F.col("id").isNotNull() & F.col("vector").isNotNull())

    data = stage(known(data).distinct(), "data")
    queries = stage(known(queries).groupBy("id").agg(F.min("vector").alias("vector")), "queries")
    widths = data.select(F.size("vector").alias("w"), norm.alias("n")).unionByName(
        queries.select(F.size("vector").alias("w"), F.lit(0.0).alias("n"))
    )
    width, largest = widths.agg(F.max("w"), F.max("n")).first()
    pivots = pivots_of(data, width or 0, largest or 0.0)
    if not len(pivots):
        return data.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    shell = F.floor(F.col("distance") / F.lit(2 * np.sqrt(largest or 1.0) / SHELLS + 1e-9)).cast("int")
    placed = stage(assign(data, pivots, largest).withColumn("shell", shell), "placed")
    asked = stage(assign(queries, pivots, None), "asked")
    # At most PIVOTS x SHELLS and PIVOTS rows, whatever the number of vectors.
    shells = placed.groupBy("cell", "shell").agg(
        F.count("*"), F.min("distance"), F.max("distance")
    ).orderBy("cell", "shell").collect()
    cells = asked.groupBy("cell").agg(F.count("*"), F.max("distance")).orderBy("cell").collect()
    # A query leaves out all vectors of its id, so the bound must hold for k besides them.
    own = data.join(queries.select("id"), "id", "left_semi").groupBy("id").agg(F.count("*").alias("n"))
    most = own.agg(F.max("n")).first()[0] or 1
    runs, needs, totals = plan(
        pivots, [tuple(r) for r in shells], [tuple(r) for r in cells], k + most - 1
    )
    spark = data.sparkSession
    sizes = {run: sum(n for c, n, _ in cells if runs[c] == run) for run in totals}
    parts = {run: -(-n // QUERIES) for run, n in sizes.items()}
    chunks = {run: -(-n // ROWS) for run, n in totals.items()}
    routes = spark.createDataFrame(
        [(c, s, run, parts[run], chunks[run]) for c, s, run in needs],
        "cell int, shell int, run int, parts int, chunks int",
    )
    homes = spark.createDataFrame(
        [(c, run, parts[run], chunks[run]) for c, run in runs.items()],
        "cell int, run int, parts int, chunks int",
    )
    pick = lambda n: F.pmod(F.xxhash64("id", "vector"), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    # Both tables are bounded by PIVOTS x SHELLS x PIVOTS rows.
    sent = placed.join(F.broadcast(routes), ["cell", "shell"]).select(
        "id", "vector", "run", all_of("parts").alias("part"), pick("chunks").alias("chunk")
    )
    heard = asked.join(F.broadcast(homes), "cell").select(
        "id", "vector", "run", pick("parts").alias("part"), all_of("chunks").alias("chunk")
    )
    key = ["run", "part", "chunk"]
    found = (
        heard.groupBy(*key)
        .cogroup(sent.groupBy(*key))
        .applyInPandas(lambda q, d: solve(q, d, k), FOUND)
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
