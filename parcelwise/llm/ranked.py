"""Exact top-k lexical search over posting lists in blocks of similar documents.

The text is read once: each document becomes a vector of the term counts that the items
ask for. Vectors are dealt out by the nearest of a few centre documents, so that documents
with similar vectors meet in one task, in order. A task takes them in shards. There each
term has its posting list, in the order of similarity and cut into blocks, and each block
has a summary: for every term the largest impact that any of its documents has. An item's
weights times the summary bound the score of all documents of the block from above. Blocks
are opened from the highest bound on, until the bounds are below the k-th best score that
the task has seen for the item; these blocks are skipped, and nothing else is.

Lists shorter than a block have no summary and are always read. A task reports its k best
rows of each item, and one aggregation picks the k best of all.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from .common import batches_of, small_batches, stage

# Documents of a shard, and postings of a block.
SHARD, BLOCK = 2048, 128
# Centre documents; they order the lists and never change a result.
CENTRES = 64
# Pairs of item and term that are searched for at once; more items take more scans.
PAIRS = 100_000
# Bytes of a text that are split at once.
PART = 1 << 20
# Fixed values of the ranking.
SCALE, TOP, LENGTH_PERCENT = 1000, 1_000_000_000, 90
# Terms are runs of digits, ASCII letters and all characters beyond ASCII.
TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms(text: str | None):
    """The terms of a text, in parts."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(TABLE)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + PART)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term: the different terms of each item."""

    def run(batches):
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for term in {t for part in terms(text) for t in part}:
                    yield item, term

    schema = "item_id long, term binary"
    found = items.select(F.col("item_id").cast("long"), "text")
    return found.mapInArrow(lambda b: batches_of(run(b), schema), schema).distinct()


def count_vectors(df: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n, terms, counts: a document's number of terms, and which terms of the
    vocabulary it holds how often, as little-endian 32-bit numbers."""
    schema = "doc_id long, n long, terms binary, counts binary"

    def run(batches):
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen: Counter = Counter()
                for part in terms(text):
                    seen.update(part)
                held = sorted((vocabulary[t], c) for t, c in seen.items() if t in vocabulary)
                codes, counts = np.array(held, "<i4").reshape(-1, 2).T
                yield doc_id, seen.total(), codes.tobytes(), counts.tobytes()

    rows = df.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(lambda b: batches_of(run(b), schema, 1000), schema)


def document_frequencies(vectors: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term of the vocabulary is; one row per term is collected."""

    def run(batches):
        n = np.zeros(size, np.int64)
        for batch in batches:
            for codes in batch.column(0).to_pylist():
                n[np.frombuffer(codes, "<i4")] += 1
        yield from ((int(t), int(n[t])) for t in np.flatnonzero(n))

    schema = "term int, n long"
    found = vectors.select("terms").mapInArrow(lambda b: batches_of(run(b), schema), schema)
    out = np.zeros(size, np.int64)
    for r in found.groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]
    return out


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(SCALE * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def impacts(n: int, counts: bytes, documents: int, length: int) -> np.ndarray:
    """What each term adds to a score per unit of weight; at most ``TOP / SCALE``."""
    m = 100 - LENGTH_PERCENT + LENGTH_PERCENT * n * documents // length
    tf = np.frombuffer(counts, "<i4").astype(np.int64)
    return TOP * tf // (SCALE * tf + 8 * m)


class Shard:
    """Vectors in the order of similarity, as posting lists in blocks with their summaries."""

    def __init__(self, ids: list, rows: list[tuple[np.ndarray, np.ndarray]], size: int, block: int = BLOCK):
        self.missing = np.array([i is None for i in ids], bool)
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)
        self.starts = np.cumsum([0, *[len(t) for t, _ in rows]])
        self.terms = np.concatenate([t for t, _ in rows] or [np.zeros(0, np.int32)]).astype(np.int64)
        self.impacts = np.concatenate([v for _, v in rows] or [np.zeros(0, np.int64)])
        doc = np.repeat(np.arange(len(rows)), np.diff(self.starts))
        order = np.argsort(self.terms, kind="stable")
        self.postings = doc[order]
        self.list_starts = np.concatenate([[0], np.cumsum(np.bincount(self.terms, minlength=size))])
        self.block = block
        lengths = np.diff(self.list_starts)
        self.long = lengths > block
        blocks = np.where(self.long, -(-lengths // block), 0)
        self.first_block = np.concatenate([[0], np.cumsum(blocks)])
        # Terms of this shard only have a column in the summaries.
        present = lengths > 0
        self.column = np.cumsum(present) - 1
        self.summaries = np.zeros((int(self.first_block[-1]), int(present.sum())), np.int32)
        flat, width = self.summaries.reshape(-1), self.summaries.shape[1]
        for term in np.flatnonzero(self.long):
            docs = self.list(term)
            at, of = self.entries(docs)
            row = self.first_block[term] + of // block
            np.maximum.at(flat, row * width + self.column[self.terms[at]], self.impacts[at].astype(np.int32))

    def list(self, term: int) -> np.ndarray:
        return self.postings[self.list_starts[term] : self.list_starts[term + 1]]

    def entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the vectors of ``docs`` lie, and whose each entry is."""
        sizes = self.starts[docs + 1] - self.starts[docs]
        of = np.repeat(np.arange(len(docs)), sizes)
        skip = np.cumsum(sizes) - sizes
        return np.arange(len(of)) - skip[of] + self.starts[docs][of], of

    def scores(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Exact scores; ``weight`` has a place for each term of the vocabulary."""
        at, of = self.entries(docs)
        out = np.zeros(len(docs), np.int64)
        np.add.at(out, of, weight[self.terms[at]] * self.impacts[at])
        return out

    def bounds(self, item: np.ndarray, weight: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
        """The blocks (term, number) of an item's long lists and the bound of each."""
        blocks = [(t, b) for t in item if self.long[t] for b in range(self.first_block[t + 1] - self.first_block[t])]
        here = item[np.diff(self.list_starts)[item] > 0]
        rows = np.array([self.first_block[t] + b for t, b in blocks], np.int64)
        part = self.summaries[np.ix_(rows, self.column[here])].astype(np.int64)
        return blocks, part @ weight[here]

    def search(self, item: np.ndarray, weight: np.ndarray, best: "Best") -> int:
        """Offer all documents that may be among the best; returns the blocks skipped."""
        short = [self.list(t) for t in item if not self.long[t]]
        docs = np.unique(np.concatenate([np.zeros(0, np.int64), *short]))
        blocks, bound = self.bounds(item, weight)
        order = np.argsort(-bound, kind="stable")
        self.offer(docs, weight, best)
        done, opened = docs, 0
        while opened < len(order) and bound[order[opened]] >= best.least():
            # More blocks at each turn; the bar rises between turns.
            turn = order[opened : opened + max(4, opened)]
            turn = turn[bound[turn] >= best.least()]
            lists = [self.list(blocks[k][0])[blocks[k][1] * self.block :][: self.block] for k in turn]
            docs = np.setdiff1d(np.concatenate(lists), done)
            self.offer(docs, weight, best)
            done, opened = np.union1d(done, docs), opened + len(turn)
        return len(order) - opened

    def offer(self, docs: np.ndarray, weight: np.ndarray, best: "Best") -> None:
        if len(docs):
            best.add(self.scores(docs, weight), self.missing[docs], self.ids[docs])


class Best:
    """The k highest scores above 0; ties go to smaller ids, rows without an id last."""

    def __init__(self, k: int):
        self.k = k
        self.rows = [np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)]

    def least(self) -> int:
        """A score below this is not among the k best."""
        return int(self.rows[0][-1]) if len(self.rows[0]) >= self.k else 1

    def add(self, score: np.ndarray, missing: np.ndarray, ids: np.ndarray) -> None:
        good = score >= self.least()
        score, missing, ids = [np.concatenate([a, b[good]]) for a, b in zip(self.rows, (score, missing, ids))]
        order = np.lexsort((ids, missing, -score))[: self.k]
        self.rows = [score[order], missing[order], ids[order]]


def _vectors(batch, documents: int, length: int):
    columns = [batch.column(c).to_pylist() for c in ("doc_id", "n", "terms", "counts")]
    for doc_id, n, codes, counts in zip(*columns):
        yield doc_id, np.frombuffer(codes, "<i4"), impacts(n, counts, documents, length)


def by_similarity(vectors: DataFrame, weight: np.ndarray, documents: int, length: int) -> DataFrame:
    """The vectors with the number of the centre document that is nearest by cosine, dealt
    out and sorted by it. Rows of one centre are split over tasks by a hash."""
    some = vectors.orderBy(F.xxhash64("doc_id", "terms"), "doc_id").limit(CENTRES)
    centres = np.zeros((len(weight), CENTRES), np.float32)
    for k, r in enumerate(some.collect()):
        codes = np.frombuffer(r["terms"], "<i4")
        v = weight[codes] * impacts(r["n"], r["counts"], documents, length)
        centres[codes, k] = v / (np.linalg.norm(v) or 1)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            near = [
                int(np.argmax((weight[codes] * value).astype(np.float32) @ centres[codes])) if len(codes) else -1
                for _, codes, value in _vectors(batch, documents, length)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.int32())], names=[*batch.schema.names, "centre"])

    placed = vectors.mapInArrow(run, "doc_id long, n long, terms binary, counts binary, centre int")
    spark = vectors.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, documents // (8 * SHARD) + 1)
    spread = F.xxhash64("terms", "counts", "doc_id")
    placed = placed.withColumn("spread", spread)
    return placed.repartitionByRange(parts, "centre", "spread").sortWithinPartitions("centre", "spread").drop("centre", "spread")


def search_block(df: DataFrame, asked: list[tuple[int, bytes]], k: int) -> DataFrame:
    """item_id, score, doc_id: the k best documents of each task for the items ``asked``."""
    vocabulary = {t: c for c, t in enumerate(sorted({t for _, t in asked}))}
    vectors = stage(count_vectors(df, vocabulary), "vectors")
    documents, length = vectors.filter(F.col("n") > 0).agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weight = weights(document_frequencies(vectors, len(vocabulary)), documents)
    by_item: dict = {}
    for item, term in asked:
        by_item.setdefault(item, []).append(vocabulary[term])
    by_item = {item: np.array(sorted(codes)) for item, codes in by_item.items()}
    schema = "item_id long, score long, doc_id long"

    def run(batches):
        best = {item: Best(k) for item in by_item}
        mine = np.zeros(len(weight), np.int64)

        def take(ids, rows):
            shard = Shard(ids, rows, len(weight))
            for item, codes in by_item.items():
                mine[codes] = weight[codes]
                shard.search(codes, mine, best[item])
                mine[codes] = 0

        ids, rows = [], []
        for batch in batches:
            for doc_id, codes, value in _vectors(batch, documents, length):
                ids.append(doc_id)
                rows.append((codes, value))
                if len(ids) == SHARD:
                    take(ids, rows)
                    ids, rows = [], []
        if ids:
            take(ids, rows)
        for item, found in best.items():
            for score, missing, doc_id in zip(*[column.tolist() for column in found.rows]):
                yield item, score, None if missing else doc_id

    held = by_similarity(vectors.filter(F.octet_length("terms") > 0), weight, documents, length)
    return held.mapInArrow(lambda b: batches_of(run(b), schema), schema)


def top_k(df: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents of ``df`` (doc_id, text) for each item (item_id, text):
    item_id, rank, doc_id, score.

    Null and empty texts have no terms; a document without one counts neither in the number
    of documents nor in an average, and an item without one gives no rows. Texts of any
    length are read whole. Equal scores go by doc_id, rows without an id last; repeated rows
    are documents of their own and take a rank each. Rows that repeat an item_id make one
    item with the terms of all of them. Empty tables give no rows. Other columns are not
    read, whatever their names.
    """
    spark = small_batches(df.sparkSession)
    pairs = stage(item_terms(items), "items")
    blocks = -(-pairs.count() // PAIRS)
    parts = []
    for b in range(blocks):
        # A block has a bounded number of pairs: items are dealt out by their hash.
        mine = pairs.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        asked = [(r["item_id"], bytes(r["term"])) for r in mine.collect()]
        if asked:
            parts.append(search_block(df, asked, k))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = reduce(DataFrame.union, parts).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
