"""Jaccard join of shingle sets by prefix lists, with skips by set relations.

Two sets of Jaccard similarity t or more have sizes within the factor t and share one of
their first n - ceil(t n) + 1 shingles in any order that holds for all sets. Here the
order is by the frequency of a shingle's words, rare ones first, then by hash; shingles
known to be frequent themselves come last, the most frequent at the end.
Inverted lists of those prefixes are cut by shingle and size bucket, so a set meets only
blocks whose sizes fit, and entries are skipped by position: at a first common shingle,
what is left of both sets bounds their overlap.

Set relations do the rest. Equal sets are one entry. A set is compared with a leader of
its lists first; similar to it, it takes over the leader's component, and no pair within a
component is looked at again. The first leader is the set that has the list's shingle
earliest: it has the fewest shingles of its own, like the text that others were copied
from. After rounds of one and then more leaders, the pairs left are those between
components; all of them are compared, so the components are exact.
Parity sketches reject most dissimilar pairs before their sets are fetched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import batches_of, drop_staged, small_batches, stage
from .components import components
from .shingles import parity_sketch, runs_of, scored_set, set_name, shingle_set, word_hashes

# Words whose shingles a task counts at once, the count there from which a shingle is told
# on, and how many shingles are put last at most; the count from which a word is told on,
# the places in which word levels are looked up, and their number. All this shapes the order only: any order of shingles
# gives the same result.
COUNTED = 1_000_000
FREQUENT = 2
LAST = 1_000_000
WORD_COUNT = 32
PLACES = 1 << 22
LEVELS = 16
# Sets a task remembers having told, so that copies are told once; told again they do no harm.
TOLD = 100_000
# Leaders per list and round; the round after them compares all that is left.
LEADERS = (1, 3)

# Bits of the map by which tasks skip documents whose set no pair needs.
MAP_BITS = 1 << 24

FACT = "kind int, doc_id long, text_key long, n long, name long, sketch array<long>"
SET = "set_id long, grams binary"


def texts_of(batch, *columns) -> Iterator[tuple]:
    return zip(*[batch.column(c).to_pylist() for c in (*columns, "text")])


def facts(rows: DataFrame, width: int) -> DataFrame:
    """Kind 0: a document's set, by name and size. Kind 1: a frequent shingle and its count.
    Kind 2: the place of a frequent word and its count."""

    def often(kind, held, least):
        names, counts = np.unique(np.concatenate(held), return_counts=True)
        high = counts >= least
        for name, count in zip(names[high].view(np.int64).tolist(), counts[high].tolist()):
            yield kind, None, None, count, name, None

    def run(batches):
        grams_held, words_held, total = [], [], 0
        for batch in batches:
            for doc_id, key, text in texts_of(batch, "doc_id", "text_key"):
                words = word_hashes(text or "")
                grams = np.unique(runs_of(words, width)) if len(words) else words
                yield 0, doc_id, key, len(grams), set_name(grams), parity_sketch(grams).tolist()
                grams_held.append(grams)
                words_held.append(words & np.uint64(PLACES - 1))
                total += len(words)
            if total > COUNTED:
                yield from often(1, grams_held, FREQUENT)
                yield from often(2, words_held, WORD_COUNT)
                grams_held, words_held, total = [], [], 0
        if grams_held:
            yield from often(1, grams_held, FREQUENT)
            yield from often(2, words_held, WORD_COUNT)

    return rows.mapInArrow(lambda b: batches_of(run(b), FACT), FACT)


class Order:
    """The order of shingles that holds for all sets."""

    def __init__(self, found: DataFrame):
        counted = found.filter("kind = 1").groupBy("name").agg(F.sum("n").alias("n"))
        counted = stage(counted, "frequent-shingles")
        top = self.most_frequent(counted).toArrow()
        drop_staged(counted)
        names = top.column("name").to_numpy().view(np.uint64)
        order = np.argsort(names)
        # The count is the rank; equal counts follow by hash.
        self.names, self.ranks = names[order], top.column("n").to_numpy()[order].astype(np.int32)
        # At most PLACES rows of two numbers, as arrays.
        words = found.filter("kind = 2").groupBy("name").agg(F.sum("n").alias("n")).toArrow()
        self.levels = np.zeros(PLACES, np.uint8)
        if len(words):
            counts = words.column("n").to_numpy().astype(float)
            level = LEVELS + np.floor(np.log2(counts / counts.max()))
            self.levels[words.column("name").to_numpy()] = np.maximum(level, 0)

    @staticmethod
    def most_frequent(counted: DataFrame) -> DataFrame:
        """The shingles (name, n) from some count on, about LAST at most. If already those
        counted 10,000 times are more, a part of them drawn by hash: any order is right."""
        sizes = counted.groupBy(F.least("n", F.lit(10_000)).alias("n")).count().collect()
        sizes = sorted(((r.n, r["count"]) for r in sizes), reverse=True)
        least, total = 10_000, 0
        for n, size in sizes:
            if total + size > LAST and total:
                break
            least, total = n, total + size
        parts = -(-total // LAST)
        top = counted.filter(F.col("n") >= least)
        return top if parts <= 1 else top.filter(F.pmod(F.xxhash64("name"), F.lit(parts)) == 0)

    def first(self, grams: np.ndarray, scores: np.ndarray, length: int) -> np.ndarray:
        """The first ``length`` shingles of a set."""
        late = np.zeros(len(grams), bool)
        if len(self.names):
            at = np.minimum(np.searchsorted(self.names, grams), len(self.names) - 1)
            late = self.names[at] == grams
        early = np.flatnonzero(~late)
        keys = (scores[early].astype(np.uint64) << np.uint64(56)) | (grams[early] >> np.uint64(8))
        out = grams[early[np.argsort(keys, kind="stable")[:length]]]
        if len(out) < length:
            rest = np.flatnonzero(late)
            rest = rest[np.argsort(self.ranks[at[rest]], kind="stable")]
            out = np.concatenate([out, grams[rest]])[:length]
        return out


def postings(rows: DataFrame, width: int, percent: int, order: Order) -> DataFrame:
    """gram, set_id, n and position of each prefix shingle; a task tells a set once."""
    import pyarrow as pa

    shared = rows.sparkSession.sparkContext.broadcast(order)

    def run(batches):
        told: set[int] = set()
        for batch in batches:
            parts = []
            for (text,) in texts_of(batch):
                grams, scores = scored_set(text, width, shared.value.levels)
                name, n = set_name(grams), len(grams)
                if not n or name in told:
                    continue
                if len(told) >= TOLD:
                    told.clear()
                told.add(name)
                first = shared.value.first(grams, scores, n - -(-percent * n // 100) + 1)
                size = len(first)
                parts.append((first.view(np.int64), np.full(size, name), np.full(size, n), np.arange(size)))
            if parts:
                columns = [np.concatenate(c).astype(np.int64) for c in zip(*parts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], names=["gram", "set_id", "n", "at"]
                )

    return rows.mapInArrow(run, "gram long, set_id long, n long, at long")


def overlap_needed(a: Column, b: Column, percent: int) -> Column:
    """The smallest intersection of sets of these sizes that reaches the similarity."""
    return F.ceil(F.lit(percent) * (a + b) / F.lit(100 + percent))


def shared_lists(entries: DataFrame, percent: int) -> DataFrame:
    """Entries of lists with more than one set: a list has a shingle's entries of two size
    buckets that follow each other, so an entry is in two lists. One shuffle, by shingle;
    the windows and the removal of repeated sets keep its partitions."""
    several = Window.partitionBy("gram")
    both = Window.partitionBy("gram", "bucket")
    bucket = F.floor(F.log(F.col("n")) / F.lit(math.log(100 / percent)) + F.lit(1e-9))
    return (
        entries.repartition("gram")
        .withColumn("alone", F.min("set_id").over(several) == F.max("set_id").over(several))
        .filter("not alone")
        .dropDuplicates(["gram", "set_id"])
        .withColumn("bucket", F.explode(F.array(bucket, bucket + 1)))
        .withColumn("alone", F.min("set_id").over(both) == F.max("set_id").over(both))
        .filter("not alone")
        .select("gram", "bucket", "set_id", "n", "at")
    )


def fits(percent: int) -> Column:
    """Sizes and positions of entries x and y leave the similarity possible."""
    small, large = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    left = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))
    return (small * 100 >= large * percent) & (
        left >= overlap_needed(F.col("x.n"), F.col("y.n"), percent)
    )


def pairs_of(chosen: DataFrame) -> DataFrame:
    return chosen.select(
        F.least("x.set_id", "y.set_id").alias("a"), F.greatest("x.set_id", "y.set_id").alias("b")
    ).distinct()


def leader_pairs(lists: DataFrame, leaders: int, turn: int, percent: int) -> DataFrame:
    """Pairs of each entry with some leaders of its list, of another component."""
    entry = F.struct("set_id", "n", "at", "root")
    draw = [F.xxhash64(F.lit(100 * turn + k), "set_id") for k in range(leaders)]
    if turn == 0:
        draw[0] = F.struct("at", draw[0])
    leading = [F.min_by(entry, d).alias(f"leader{k}") for k, d in enumerate(draw)]
    heads = (
        lists.groupBy("gram", "bucket")
        .agg(*leading, F.min("root").alias("low"), F.max("root").alias("high"))
        .filter("low <> high")
        .select("gram", "bucket", F.array(*[f"leader{k}" for k in range(leaders)]).alias("heads"))
    )
    met = lists.select("gram", "bucket", entry.alias("x")).join(heads, ["gram", "bucket"])
    met = met.select("x", F.explode(F.array_distinct("heads")).alias("y"))
    return pairs_of(met.filter(F.col("x.root") != F.col("y.root")).filter(fits(percent)))


def all_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs between different components that meet in a list."""
    mixed = (
        lists.groupBy("gram", "bucket")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .filter("low <> high")
        .select("gram", "bucket")
    )
    entry = F.struct("set_id", "n", "at", "root")
    left = lists.join(mixed, ["gram", "bucket"]).select("gram", "bucket", entry.alias("x"))
    right = left.withColumnRenamed("x", "y")
    return pairs_of(
        left.join(right, ["gram", "bucket"])
        .filter((F.col("x.set_id") < F.col("y.set_id")) & (F.col("x.root") != F.col("y.root")))
        .filter(fits(percent))
    )


def likely(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches leave the similarity possible."""

    def side(name):
        return sketches.select(F.col("set_id").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("n", "sketch")])

    apart = F.aggregate(
        F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0),
        lambda total, x: total + x,
    )
    most = F.col("n_a") + F.col("n_b") - 2 * overlap_needed(F.col("n_a"), F.col("n_b"), percent)
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.filter(apart <= most).select("a", "b")


def row_key() -> Column:
    """A hash of a row's id and text, by which rows are looked up; equal hashes do no harm."""
    return F.xxhash64("doc_id", "text_key")


def sets_of(rows: DataFrame, pairs: DataFrame, sketches: DataFrame, width: int) -> DataFrame:
    """The sets that ``pairs`` name, each built from one document.

    Texts are not joined: the keys of those documents fill a map of MAP_BITS bits, which
    has the same size whatever their number, and tasks pass over rows that are not in it.
    """
    names = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    keys = names.join(sketches.select("set_id", "row_key"), "set_id").select("set_id", "row_key")
    keys = stage(keys, "set-keys")
    place = F.col("row_key").bitwiseAND(MAP_BITS - 1)
    filled = (
        keys.select(F.shiftright(place, 6).alias("word"), place.bitwiseAND(63).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        .collect()
    )
    bits = np.zeros(MAP_BITS // 64, np.int64)
    bits[[r.word for r in filled]] = [r.bits for r in filled]
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def build(batches):
        told: set[int] = set()
        for batch in batches:
            places = batch.column("place").to_numpy()
            wanted = (shared.value[places >> 6] >> (places & 63)) & 1
            for k in np.flatnonzero(wanted).tolist():
                grams = shingle_set(batch.column("text")[k].as_py(), width)
                if (name := set_name(grams)) not in told:
                    if len(told) >= TOLD:
                        told.clear()
                    told.add(name)
                    yield name, grams.tobytes()

    keyed = rows.select("text", row_key().alias("row_key"))
    built = keyed.select("text", place.alias("place")).mapInArrow(
        lambda b: batches_of(build(b), SET, 128), SET
    )
    return stage(built.dropDuplicates(["set_id"]), "sets")


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets reach the similarity."""

    def run(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("a", "b", "grams_a", "grams_b")]
            for a, b, x, y in zip(*columns):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int(np.count_nonzero(y[at] == x))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    yield a, b

    fetched = pairs.join(sets.select(F.col("set_id").alias("a"), F.col("grams").alias("grams_a")), "a")
    fetched = fetched.join(sets.select(F.col("set_id").alias("b"), F.col("grams").alias("grams_b")), "b")
    return fetched.mapInArrow(lambda b: batches_of(run(b), "a long, b long"), "a long, b long")


def linked_sets(rows: DataFrame, found: DataFrame, width: int, percent: int) -> DataFrame | None:
    """node and root of the sets that have a similar, unequal set; None if there are none."""
    entries = stage(postings(rows, width, percent, Order(found)), "postings")
    lists = stage(shared_lists(entries, percent), "prefix-lists")
    drop_staged(entries)
    one = F.min(F.struct(row_key().alias("row_key"), "n", "sketch")).alias("one")
    sketches = found.filter("kind = 0").groupBy(F.col("name").alias("set_id")).agg(one)
    sketches = stage(sketches.select("set_id", "one.*"), "sketches")
    tested = links = roots = None
    for turn, leaders in enumerate([*LEADERS, None]):
        if roots is None:
            placed = lists.withColumn("root", F.col("set_id"))
        else:
            placed = lists.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left")
            placed = stage(placed.withColumn("root", F.coalesce("root", "set_id")), "placed-lists")
        if leaders:
            pairs = leader_pairs(placed, leaders, turn, percent)
        else:
            pairs = all_pairs(placed, percent)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stage(likely(pairs, sketches, percent), "likely-pairs")
        if roots is not None:
            drop_staged(placed)
        if pairs.isEmpty():
            continue
        tested = pairs if tested is None else tested.unionByName(pairs)
        sets = sets_of(rows, pairs, sketches, width)
        similar = stage(verify(pairs, sets, percent), "links")
        drop_staged(sets)
        links = similar if links is None else links.unionByName(similar)
        if not similar.isEmpty():
            roots = components(links)
    drop_staged(lists)
    return roots


def near_duplicates(df: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, text_key and kept for each row of ``df`` (doc_id, text).

    Two rows link when 100 times the size of their sets' intersection reaches ``percent``
    times that of the union. component_id is the smallest doc_id reachable by links, its
    own included. Null texts and texts without words have an empty set and link with none;
    rows without a doc_id link, but name no component unless none of theirs has an id, when
    it is null. Repeated rows are linked rows of their own; other columns are not read. kept is
    true for the rows of the smallest doc_id of a component and, if that id has several texts
    there, of the text with the smallest hash text_key; rows of an empty set are kept. An
    empty table gives no rows. Sets are told apart by 64-bit hashes of 64-bit shingles.
    """
    small_batches(df.sparkSession)
    rows = df.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    found = stage(facts(rows, width), "facts")
    roots = linked_sets(rows, found, width, percent)
    documents = found.filter("kind = 0").select("doc_id", F.col("n").alias("n_shingles"), "name", "text_key")
    if roots is not None:
        documents = documents.join(roots.withColumnRenamed("node", "name"), "name", "left")
        documents = documents.withColumn("name", F.coalesce("root", "name"))
    full = documents.filter("n_shingles > 0")
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key")
    smallest = full.groupBy("name").agg(F.min(place).alias("first"))
    return (
        full.join(smallest, "name")
        .select(
            "doc_id", "n_shingles", F.col("first.doc_id").alias("component_id"), "text_key",
            (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))).alias("kept"),
        )
        .unionByName(
            documents.filter("n_shingles = 0").select(
                "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "text_key",
                F.lit(True).alias("kept"),
            )
        )
    )


def one_of_each(df: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Of each group of ``near_duplicates`` one row stays, that of the smallest doc_id.

    Rows are told apart by doc_id and text (its 64-bit hash), so different texts of one
    doc_id are rows of their own, and of rows equal in both one stays. Rows without a
    doc_id stand behind all others.
    """
    key = [
        F.col("doc_id").isNull().alias("nameless"),
        F.coalesce("doc_id", F.lit(0)).alias("id"),
    ]
    names = ["nameless", "id", "text_key"]
    groups = near_duplicates(df, width, percent)
    kept = groups.filter("kept").select(*key, "text_key").distinct()
    keyed = df.select(F.struct("*").alias("row"), *key, F.xxhash64("text").alias("text_key"))
    return keyed.join(kept, names, "left_semi").dropDuplicates(names).select("row.*")
