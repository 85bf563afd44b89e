"""Random forests grown from histograms of binned features.

A level of all trees is one scan: each task adds its rows up per tree, open node, feature,
bin and label, the sums meet by node, and one row per node, its best cut, comes back. No
row knows its node between levels; a task finds it in the trees grown so far. How often
a tree draws a row follows from the row's own hash, and counts are whole numbers, so the
same rows give the same forest under any partitioning, retry or cluster size.

Rows that agree in all bins and the label take the same way down every tree. They are
stored next to each other, and a run of them is added up as one, with the sum of its
draws: there are at most as many as combinations of bins, however many rows there are.

Several forests, each without one fold of the rows, are more trees of the same scans.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.keys import unit_draw
from ..sources.tables import stage

BINS = 32
# Rows on which the bins are laid, drawn by their hash whatever the size of the table.
BIN_ROWS = 20_000
# Rows, or runs of alike ones, handled together, so that their arrays stay in the processor's cache.
BLOCK = 1 << 14
# Most rows of a run, so that the sum of their draws fits 16 bits.
RUN = 1 << 12
# Bytes of the sums a task holds; trees beyond it take a further scan of the level.
LEVEL_BYTES = 64 << 20

PARTIAL = "tree int, node int, sums binary"
BEST = "tree int, node int, feature int, cut int, gain double, l0 long, l1 long, r0 long, r1 long"


@dataclass(frozen=True)
class Forest:
    """Trees as heaps: the children of node i are 2i + 1 (value <= cut) and 2i + 2.

    A node that is not divided has feature 0 and cut +inf, which leads to the left down
    to the last level; ``late`` has the share of label 1 there. ``importance`` is the share
    of the impurity decrease per feature.
    """

    features: list[str]
    feature: np.ndarray
    cut: np.ndarray
    late: np.ndarray
    importance: np.ndarray


def draws_per_row() -> np.ndarray:
    """Poisson counts with mean 1 for the 65536 values of 16 random bits."""
    below, term, k = [], np.exp(-1.0), 0
    while not below or below[-1] < 1 - 2.0**-17:
        below.append((below[-1] if below else 0.0) + term)
        k += 1
        term /= k
    return np.searchsorted(below, (np.arange(65536) + 0.5) / 65536).astype(np.float64)


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers; every output bit depends on every input bit."""
    shifted = x >> np.uint64(30)
    out = x ^ shifted
    with np.errstate(over="ignore"):
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= np.right_shift(out, np.uint64(27), out=shifted)
        out *= np.uint64(0x94D049BB133111EB)
    out ^= np.right_shift(out, np.uint64(31), out=shifted)
    return out


def bin_edges(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """At most ``bins - 1`` cuts: between all values if they are few, else at equal shares."""
    found, counts = np.unique(values, return_counts=True)
    if len(found) < 2:
        return np.empty(0)
    if len(found) > bins:
        upto = np.cumsum(counts)
        at = np.searchsorted(upto, np.arange(1, bins) * upto[-1] / bins)
        at = np.unique(np.minimum(at, len(found) - 2))
    else:
        at = np.arange(len(found) - 1)
    # Half of each, as the sum of two large values may pass the largest double.
    middle = found[at] / 2 + found[at + 1] / 2
    return np.where(middle < found[at + 1], middle, found[at])


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= BLOCK:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


# Levels below a place of the tree that one 64-bit word of open leaves covers.
WORD_LEVELS = 6
# Places of a table for two features, so that it stays in the processor's cache.
PAIR_PLACES = 4096


def pairs_of(sizes: list[int]) -> list[tuple[int, ...]]:
    """Features are looked up two at a time, an odd one and those of many bins alone."""
    out, f = [], 0
    while f < len(sizes):
        both = f + 1 < len(sizes) and sizes[f] * sizes[f + 1] <= PAIR_PLACES
        out.append((f, f + 1) if both else (f,))
        f += len(out[-1])
    return out


def pair_places(bins: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """The place of each row in the tables of ``leaf_tables``, one array per pair of features."""
    out = []
    for pair in pairs_of(sizes):
        place = bins[pair[0]].astype(np.int64)
        if len(pair) == 2:
            place *= sizes[pair[1]]
            place += bins[pair[1]]
        out.append(place)
    return out


def leaf_tables(feature: np.ndarray, cut: np.ndarray, sizes: list[int], levels: int) -> tuple[int, list[np.ndarray]]:
    """What ``leaves`` needs of one tree: the levels to be walked, and a table per pair of features.

    A row reaches the lowest leaf that none of its nodes rules out: a node whose value is
    above the cut rules out all leaves on its left. What the nodes of a feature rule out
    follows from the row's bin of it, so a table gives for a pair of bins the leaves left, as
    the bits of a word. Of more than ``WORD_LEVELS`` levels the first are walked, and
    each place there has a part of the tables to itself.
    """
    head = max(0, levels - WORD_LEVELS)
    depth = levels - head
    every = np.uint64(2**64 - 1)
    words = [np.full((1 << head, size), every) for size in sizes]
    for level in range(depth):
        nodes = np.arange(1 << (head + level))
        root, within = nodes >> level, nodes & ((1 << level) - 1)
        node = nodes + (1 << (head + level)) - 1
        # The leaves on the left of a node are a run of ``half`` bits.
        half = 1 << (depth - level - 1)
        run = np.uint64((1 << half) - 1)
        keep = every ^ (run << (within * 2 * half).astype(np.uint64))
        for f, size in enumerate(sizes):
            of = feature[node] == f
            if of.any():
                ruled = np.where(np.arange(size) > cut[node[of]][:, None], keep[of][:, None], every)
                np.bitwise_and.at(words[f], root[of], ruled)
    tables = []
    for pair in pairs_of(sizes):
        table = words[pair[0]]
        if len(pair) == 2:
            table = (table[:, :, None] & words[pair[1]][:, None, :]).reshape(1 << head, -1)
        tables.append(table)
    return head, tables


class Room:
    """Arrays by name that are used again for every tree and block: new ones of this size
    cost more than what is done with them."""

    def __init__(self):
        self._held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, n: int, kind: type = np.int64) -> np.ndarray:
        if len(self._held.get(name, ())) < n:
            self._held[name] = np.empty(max(n, 2 * BLOCK), kind)
        return self._held[name][:n]


def leaves(
    feature: np.ndarray,
    cut: np.ndarray,
    head: int,
    tables: list[np.ndarray],
    bins: np.ndarray,
    places: list[np.ndarray],
    room: Room,
) -> np.ndarray:
    """The place, from 0 on the left, that each row reaches on the level below the tree's last.

    ``bins`` has a row per feature and ``places`` are those of ``pair_places``. The answer
    is in an array of ``room`` that the next call overwrites.
    """
    n = bins.shape[1]
    node, at = room("node", n), room("at", n)
    if not len(feature):
        node[:] = 0
        return node
    left, other = room("left", n, np.uint64), room("other", n, np.uint64)
    if head:
        walk(feature, cut, bins, head, node, room)
    for k, (table, place) in enumerate(zip(tables, places)):
        if head:
            np.multiply(node, table.shape[1], out=at)
            at += place
            place = at
        look(table.ravel(), place, other if k else left)
        if k:
            left &= other
    # The lowest of the bits left.
    np.invert(left, out=other)
    left -= np.uint64(1)
    other &= left
    lowest = np.bitwise_count(other, out=room("lowest", n, np.uint8))
    if not head:
        np.copyto(node, lowest)
        return node
    node <<= (len(feature) + 1).bit_length() - 1 - head
    node += lowest
    return node


def walk(feature, cut, bins: np.ndarray, levels: int, node: np.ndarray, room: Room) -> None:
    """Set ``node`` to the place each row reaches on level ``levels``."""
    n = bins.shape[1]
    flat, every, at, value = bins.ravel(), room("every", n), room("at", n), room("value", n, bins.dtype.type)
    every[:] = np.arange(n)
    start, limit = feature.astype(np.int64) * n, room("limit", n)
    node[:] = 0
    for _ in range(levels):
        look(start, node, at)
        at += every
        look(flat, at, value)
        look(cut, node, limit)
        right = value > limit
        node += node
        node += 1
        node += right
    node -= (1 << levels) - 1


def look(values: np.ndarray, places: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """``values[places]`` for places that are known to be inside."""
    return values.take(places, mode="clip", out=out)


def best_cuts(sums: np.ndarray, min_rows: int) -> tuple[int, int, float, np.ndarray] | None:
    """Feature place, bin, gain and class counts of both sides for one node's sums."""
    left = sums.cumsum(axis=1)[:, :-1, :].astype(float)
    whole = sums[0].sum(axis=0).astype(float)
    right = whole - left
    n_left, n_right = left.sum(axis=2), right.sum(axis=2)
    n = whole.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        # Rows times the Gini impurity is 2 p q / n.
        cost = lambda side, rows: np.where(rows > 0, 2 * side[..., 0] * side[..., 1] / rows, 0.0)
        gain = cost(whole, n) - cost(left, n_left) - cost(right, n_right)
    gain[(n_left < min_rows) | (n_right < min_rows)] = -1.0
    place = int(gain.argmax())
    f, b = divmod(place, gain.shape[1])
    if not gain[f, b] > 1e-9 * max(n, 1.0):
        return None
    return f, b, float(gain[f, b]), np.concatenate([left[f, b], right[f, b]]).astype(np.int64)


def run_starts(columns: list[np.ndarray]) -> np.ndarray:
    """Where a row differs from the one before it; ``RUN`` rows at most have one start."""
    new = np.zeros(len(columns[0]), bool)
    new[::RUN] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def run_draws(hashed: np.ndarray, fold: np.ndarray, starts: np.ndarray, times: np.ndarray, s: dict, room: Room) -> np.ndarray:
    """How often each tree of a scan draws the rows of each run: a row per tree, a column per run."""
    n, held = len(hashed), s["held"]
    out, of, seen = np.empty((len(s["trees"]), len(starts)), np.uint16), -1, {}
    last = np.append(starts[1:], n) - 1
    number, drawn, upto = room("number", 4 * n), room("drawn", 4 * n, np.uint16), room("upto", n, np.uint64)
    for i, t in enumerate(s["trees"]):
        # 64 bits of a row serve four trees, whose draws are added up as one number.
        if t // 4 != of:
            of = t // 4
            bits = mixed_bits(hashed ^ mixed_bits(np.full(1, (s["seed"] << 32) + of + 1, np.uint64)))
            np.copyto(number, bits.astype("<u8", copy=False).view("<u2"))
            look(times, number, drawn)
            for k, f in enumerate(held[4 * of : 4 * of + 4]):
                if f >= 0:
                    if f not in seen:
                        seen[f] = (fold != f).astype(np.uint16)
                    drawn[k::4] *= seen[f]
            sums = drawn.astype("<u2", copy=False).view("<u8")
            if len(starts) < n:
                sums = np.diff(look(np.cumsum(sums, out=upto), last), prepend=np.uint64(0)).astype("<u8", copy=False)
            sums = sums.view("<u2").reshape(-1, 4)
        out[i] = sums[:, t % 4]
    return out


def runs(batches: Iterator[pa.RecordBatch], s: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of rows alike in bins and label: their bins, labels and draws, some ``BLOCK`` runs at a time."""
    times, room = draws_per_row().astype(np.uint16), Room()
    held, n = [], 0

    def joined() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        alike, drawn = (np.concatenate(part, axis=1) for part in zip(*held))
        return alike[:-1].astype(np.uint8), alike[-1].astype(np.int64), drawn

    for table in blocks(batches):
        columns = [table.column(c).to_numpy() for c in (*s["columns"], "label")]
        hashed, fold = table.column("draw").to_numpy().view(np.uint64), table.column("fold").to_numpy()
        starts = run_starts(columns)
        if n and n + len(starts) > BLOCK:
            yield joined()
            held, n = [], 0
        alike = np.stack([column[starts] for column in columns])
        held.append((alike, run_draws(hashed, fold, starts, times, s, room)))
        n += len(starts)
    if n:
        yield joined()


def node_sums(rows: DataFrame, state: dict) -> DataFrame:
    """One scan: the counts of this level's open nodes, one row per task, tree and node."""
    shipped = rows.sparkSession.sparkContext.broadcast(state)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shipped.value
        sums = {}
        levels, inner = s["level"], (1 << s["level"]) - 1
        width = s["subset"].shape[2]
        cells = BINS * 2
        sizes, room = [BINS] * len(s["columns"]), Room()
        # Where a node's counts begin, negative for nodes that are not open.
        start = s["open"] * cells
        ways = {t: leaf_tables(s["feature"][t, :inner], s["cut"][t, :inner], sizes, levels) for t in s["trees"]}
        for bins, label, draws in runs(batches, s):
            n = len(label)
            places = pair_places(bins, sizes)
            # Place of a run's count among those of a feature; a run's features stand together.
            cell = np.ascontiguousarray((bins.astype(np.int64) * 2 + label).T).ravel()
            each, place = np.arange(n) * len(sizes), room("place", n)
            for t, drawn in zip(s["trees"], draws):
                node = leaves(s["feature"][t, :inner], s["cut"][t, :inner], *ways[t], bins, places, room)
                look(start[t], node, place)
                live = np.flatnonzero((drawn > 0) & (place >= 0))
                m = len(live)
                if not m:
                    continue
                begin, row = look(place, live, room("begin", m)), look(each, live, room("row", m))
                weight = room("weight", m, float)
                np.copyto(weight, look(drawn, live, room("drawn_live", m, np.uint16)))
                node = look(node, live, room("node_live", m))
                size = int(s["count"][t]) * cells
                if t not in sums:
                    sums[t] = np.zeros((width, size))
                at, one = room("at", m), room("one", m)
                for j in range(width):
                    look(s["subset"][t, inner : 2 * inner + 1, j], node, at)
                    at += row
                    look(cell, at, one)
                    one += begin
                    sums[t][j] += np.bincount(one, weight, minlength=size)
        for t, total in sums.items():
            nodes = np.flatnonzero(s["open"][t] >= 0)
            nodes = nodes[np.argsort(s["open"][t][nodes])]
            each = total.astype(np.int64).reshape(width, len(nodes), cells).swapaxes(0, 1).reshape(len(nodes), -1)
            met = each.any(axis=1)
            yield pa.record_batch(
                [
                    pa.array(np.full(int(met.sum()), t, np.int32)),
                    pa.array(nodes[met].astype(np.int32)),
                    pa.array([row.tobytes() for row in each[met]], pa.binary()),
                ],
                names=["tree", "node", "sums"],
            )

    return rows.mapInArrow(add, PARTIAL)


def level_cuts(partial: DataFrame, width: int, min_rows: int) -> DataFrame:
    """The best cut per tree and node. A task holds the sums of its nodes, whatever the rows."""

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for batch in batches:
            for tree, node, part in zip(batch["tree"], batch["node"], batch["sums"]):
                part = np.frombuffer(part, np.int64)
                if (tree, node) in sums:
                    sums[tree, node] += part
                else:
                    sums[tree, node] = part.copy()
        found = []
        for (tree, node), total in sums.items():
            total = total.reshape(width, BINS, 2)
            best = best_cuts(total, min_rows)
            if best is None:
                # Nothing divides it; its counts are still those of a leaf.
                l0, l1 = total[0].sum(axis=0)
                found.append((tree, node, -1, -1, 0.0, l0, l1, 0, 0))
            else:
                found.append((tree, node, *best[:3], *best[3]))
        yield pd.DataFrame(found, columns=[c.split()[0] for c in BEST.split(", ")])

    return partial.repartition("tree", "node").mapInPandas(choose, BEST)


def binned_rows(
    df: DataFrame, features: list[str], label: str, key: list[str], seed: int, fold: Column | None
) -> tuple[DataFrame, list[np.ndarray]]:
    """The rows as bin numbers with label, hash and fold, stored; and the edges of the bins.

    Rows alike in bins and label are brought together; the rebalance hint lets AQE deal a
    combination of very many rows out over several tasks.

    ``df`` is read three times (counted, sampled, binned), so pass a stored table.
    """
    values = [F.col(c).cast("double").alias(f"b{i}") for i, c in enumerate(features)]
    share = min(1.0, BIN_ROWS / max(1, df.count()))
    sample = df.filter(unit_draw(F.lit(seed), F.lit("bins"), *key) < share).select(*values).toPandas()
    edges = [bin_edges(sample[f"b{i}"].to_numpy(float)) for i in range(len(features))]
    numbers = df.select(
        *values,
        F.col(label).cast("tinyint").alias("label"),
        F.xxhash64(F.lit(seed), *key).alias("draw"),
        (F.lit(-1) if fold is None else fold).cast("int").alias("fold"),
    )

    def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [
                pa.array(np.searchsorted(edge, batch.column(i).to_numpy()).astype(np.int8))
                for i, edge in enumerate(edges)
            ]
            yield pa.record_batch([*columns, *batch.columns[len(edges) :]], names=batch.schema.names)

    names = [f"b{i}" for i in range(len(features))]
    types = ", ".join(f"{name} tinyint" for name in names)
    binned = numbers.mapInArrow(to_bins, f"{types}, label tinyint, draw long, fold int")
    alike = binned.withColumn("alike", F.xxhash64(*names, "label")).hint("rebalance", "alike")
    return stage(alike.sortWithinPartitions("alike").drop("alike"), "binned"), edges


def grow(
    df: DataFrame,
    features: list[str],
    label: str,
    key: list[str],
    trees: int,
    depth: int,
    min_rows: int,
    seed: int,
    fold: Column | None = None,
    folds: int = 0,
) -> list[Forest]:
    """A forest of all rows; with ``folds`` one for each fold, of the rows of the others.

    ``key`` are columns that tell rows apart; rows that agree in them are drawn together.
    ``df`` has no null in ``features`` and labels 0 and 1. No rows give trees without
    cuts and a share of 0. A level takes one scan for ``LEVEL_BYTES`` of sums a task.
    """
    rows, edges = binned_rows(df, features, label, key, seed, fold)
    forests = max(1, folds)
    n_trees, inner = trees * forests, (1 << depth) - 1
    width = int(np.ceil(np.sqrt(len(features))))
    # Features tried at each node, ascending.
    subset = np.stack(
        [
            np.sort(np.random.default_rng([seed, t]).random((inner, len(features))).argsort(axis=1)[:, :width])
            for t in range(n_trees)
        ]
    )
    feature = np.zeros((n_trees, inner), np.int64)
    cut = np.full((n_trees, inner), BINS, np.int64)
    counts = np.zeros((n_trees, 2 * inner + 1, 2), np.int64)
    gains = np.zeros((n_trees, len(features)))
    held = np.repeat(np.arange(forests), trees) if folds else np.full(n_trees, -1)
    live = np.zeros((n_trees, inner), bool)
    live[:, 0] = True
    for level in range(depth):
        first = (1 << level) - 1
        now = live[:, first : 2 * first + 1]
        state = {
            "columns": [f"b{i}" for i in range(len(features))],
            "seed": seed,
            "level": level,
            "held": held,
            "feature": feature,
            "cut": cut,
            "subset": subset,
            "open": np.where(now, now.cumsum(axis=1) - 1, -1),
            "count": now.sum(axis=1),
        }
        cost = state["count"] * width * BINS * 2 * 8
        at_once = np.cumsum(cost) // LEVEL_BYTES
        for part in np.unique(at_once[cost > 0]):
            state["trees"] = np.flatnonzero((at_once == part) & (cost > 0)).tolist()
            best = level_cuts(node_sums(rows, state), width, min_rows).toPandas()
            t, node = best["tree"].to_numpy(), first + best["node"].to_numpy()
            sides = best[["l0", "l1", "r0", "r1"]].to_numpy().reshape(-1, 2, 2)
            counts[t, node] = sides.sum(axis=1)
            counts[t, 2 * node + 1] = sides[:, 0]
            cuts = best["feature"].to_numpy() >= 0
            t, node, sides = t[cuts], node[cuts], sides[cuts]
            f = subset[t, node, best["feature"].to_numpy()[cuts]]
            feature[t, node], cut[t, node] = f, best["cut"].to_numpy()[cuts]
            counts[t, 2 * node + 2] = sides[:, 1]
            np.add.at(gains, (t, f), best["gain"].to_numpy()[cuts])
            if level + 1 < depth:
                # A child of one class or of too few rows cannot be divided again.
                open_to = (sides.min(axis=2) > 0) & (sides.sum(axis=2) >= 2 * min_rows)
                live[t, 2 * node + 1], live[t, 2 * node + 2] = open_to[:, 0], open_to[:, 1]
        # Below a leaf the way leads to the left, and its counts go along.
        here = np.arange(first, 2 * first + 1)
        closed = cut[:, here] == BINS
        counts[:, 2 * here + 1] = np.where(closed[..., None], counts[:, here], counts[:, 2 * here + 1])
    return [
        _forest(features, edges, *(x[f * trees : (f + 1) * trees] for x in (feature, cut, counts[:, inner:], gains)))
        for f in range(forests)
    ]


def _forest(features, edges, feature, cut, counts, gains) -> Forest:
    values = np.full((len(features), BINS + 1), np.inf)
    for f, edge in enumerate(edges):
        values[f, : len(edge)] = edge
    n = counts.sum(axis=2)
    late = np.divide(counts[..., 1], n, out=np.zeros(n.shape), where=n > 0)
    per_tree = gains.sum(axis=1, keepdims=True)
    shares = np.divide(gains, per_tree, out=np.zeros(gains.shape), where=per_tree > 0).sum(axis=0)
    total = shares.sum()
    return Forest(
        list(features),
        feature.astype(np.int32),
        values[feature, cut],
        late,
        shares / total if total > 0 else shares,
    )


def _lookup(feature: np.ndarray, cut: np.ndarray, late: np.ndarray) -> tuple[list, list[int], list[tuple]]:
    """A forest for ``leaves``: the cuts of each feature as edges of bins, their numbers, and the trees."""
    used = int(feature.max(initial=0)) + 1
    edges = [np.unique(cut[(feature == f) & (cut < np.inf)]) for f in range(used)]
    sizes = [len(edge) + 1 for edge in edges]
    numbers = np.full(cut.shape, max(sizes))
    for f, edge in enumerate(edges):
        of = (feature == f) & (cut < np.inf)
        numbers[of] = np.searchsorted(edge, cut[of])
    depth = (feature.shape[1] + 1).bit_length() - 1
    trees = [
        (share, nodes, at, *leaf_tables(nodes, at, sizes, depth))
        for share, nodes, at in zip(late, feature, numbers)
    ]
    return edges, sizes, trees


def probability(df: DataFrame, forests: list[Forest], fold: Column | None = None) -> Column:
    """The mean share of label 1 over a forest's trees, null where a feature is null.

    With ``fold`` a row is scored by the forest of that number.
    """
    shipped = df.sparkSession.sparkContext.broadcast([(f.feature, f.cut, f.late) for f in forests])

    @F.pandas_udf("double")
    def late(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        ready, room = [_lookup(*parts) for parts in shipped.value], Room()
        for *columns, which in batches:
            values = np.stack([c.to_numpy(float) for c in columns])
            which = which.to_numpy()
            out = np.empty(len(which))
            for number, (edges, sizes, trees) in enumerate(ready):
                at = np.flatnonzero(which == number)
                for begin in range(0, len(at), BLOCK):
                    rows = at[begin : begin + BLOCK]
                    # A value that is no number is above no cut.
                    bins = np.stack([
                        np.where(np.isnan(v), 0, np.searchsorted(edge, v)) for edge, v in zip(edges, values[:, rows])
                    ])
                    places = pair_places(bins, sizes)
                    total = np.zeros(len(rows))
                    for share, *tree in trees:
                        total += look(share, leaves(*tree, bins, places, room))
                    out[rows] = total / len(trees)
            yield pd.Series(out)

    inputs = [F.col(c).cast("double") for c in forests[0].features]
    known = F.lit(True)
    for c in inputs:
        known = known & c.isNotNull()
    return F.when(known, late(*inputs, F.lit(0) if fold is None else fold))
