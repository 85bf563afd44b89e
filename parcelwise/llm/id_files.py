"""Token ids in files of Simple-8b words.

A file holds the ids of consecutive documents. They are cut into blocks of ``BLOCK``
ids that are decoded independently. In each 64-bit word the top four bits name a
selector, which says how many ids of how many bits fill the other 60:

    selector  0  1  2  3  4  5  6  7  8  9 10 11 12 13
    ids      60 30 20 15 12 10  8  7  6  5  4  3  2  1
    bits      1  2  3  4  5  6  7  8 10 12 15 20 30 60

Selector 15 is an escape: the next word is one id of more than 60 bits. Unused places
of a block's last word are zero; the block's number of ids tells where it ends.

    file    = "S8BIDS01" block... footer, length of footer (8 bytes)
    block   = words, 8 bytes each, little endian
    footer  = number of documents, of blocks (8 bytes each),
              doc_id per document, a null mask per document, ids per document,
              first word of each block and the end

Encoding finds for every position at once the fullest selector that fits there and then
steps from word to word; decoding shifts all words of one selector together.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from .common import batches_of, file_system, fresh_file, per_file, rows_of, small_batches, stage
from ..session import shared_folder

# Fixed values of the coding: (ids in a word, bits of each), by selector.
SELECTORS = [
    (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8),
    (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
]
ESCAPE = 15
# Ids in a word, by selector.
PLACES = np.array([count for count, _ in SELECTORS] + [1, 1])
MAGIC = b"S8BIDS01"
BLOCK = 16_384
# Ids in one file at most, unless one document has more: bounds what a reader's footer holds.
FILE_IDS = 1 << 26

LIST = "part int, number int, path string, n_docs long, n_ids long"
INDEX = "doc_id long, start long, n_tokens long, ids_crc32 long"


def encode_block(ids: np.ndarray) -> np.ndarray:
    """Words of up to a few ten thousand ids (unsigned integers of any size)."""
    ids = np.ascontiguousarray(ids)
    n = len(ids)
    if n == 0:
        return np.zeros(0, np.uint64)
    selector = np.full(n, ESCAPE, np.int8)
    top = int(ids.max())
    # ``over`` counts the ids before each place that need more bits; places past the end need none.
    over = np.zeros(n + 61, np.int32)
    # Narrow ids are compared as they are.
    narrow = ids if top >> 32 else ids.astype(np.uint32)
    for s in range(len(SELECTORS) - 1, -1, -1):
        count, bits = SELECTORS[s]
        if not top >> bits:
            selector[:] = s
            continue
        np.cumsum(narrow >= narrow.dtype.type(1 << bits), out=over[1 : n + 1], dtype=np.int32)
        over[n + 1 :] = over[n]
        fits = over[count : n + count] == over[:n]
        if not fits.any():
            break
        np.copyto(selector, s, where=fits)
    steps, at, starts = PLACES[selector].tolist(), 0, []
    step = starts.append
    while at < n:
        step(at)
        at += steps[at]
    starts = np.array(starts)
    chosen = selector[starts]
    place = np.arange(len(starts)) + np.concatenate([[0], np.cumsum(chosen == ESCAPE)[:-1]])
    words = np.zeros(len(starts) + int((chosen == ESCAPE).sum()), np.uint64)
    padded = np.concatenate([ids.astype(np.uint64, copy=False), np.zeros(60, np.uint64)])
    for s, (count, bits) in enumerate(SELECTORS):
        mine = np.flatnonzero(chosen == s)
        if len(mine):
            first = starts[mine]
            if count > 4 * len(mine):
                parts = padded[first[:, None] + np.arange(count)]
                word = np.bitwise_or.reduce(parts << (np.arange(count, dtype=np.uint64) * np.uint64(bits)), axis=1)
            else:
                # Few places of many words: one place of all of them at a time.
                word = padded[first]
                for k in range(1, count):
                    word |= padded[first + k] << np.uint64(k * bits)
            words[place[mine]] = word | np.uint64(s << 60)
    mine = chosen == ESCAPE
    words[place[mine]] = np.uint64(ESCAPE << 60)
    words[place[mine] + 1] = ids[starts[mine]]
    return words


def decode_block(words: np.ndarray, n: int) -> np.ndarray:
    words = np.ascontiguousarray(words, dtype=np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int8)
    marks = np.flatnonzero(selector == ESCAPE)
    if len(marks):  # a word after an escape is an id, whatever its top bits say
        real, last = [], -2
        for m in marks.tolist():
            if m != last + 1:
                real.append(m)
                last = m
        marks = np.array(real)
        selector[marks + 1] = -1
    counts = np.array([c for c, _ in SELECTORS] + [0, 1])[selector]
    counts[selector == -1] = 0
    starts = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()) if len(counts) else 0, np.uint64)
    for s, (count, bits) in enumerate(SELECTORS):
        mine = selector == s
        if mine.any():
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits)
            parts = (words[mine][:, None] >> shifts) & np.uint64((1 << bits) - 1)
            out[starts[mine][:, None] + np.arange(count)] = parts
    if len(marks):
        out[starts[marks]] = words[marks + 1]
    return out[:n]


class FileWriter:
    """Takes documents one by one; holds at most a block of ids and the document index."""

    def __init__(self, folder: str):
        self.path = fresh_file(folder, ".s8b")
        system, path = file_system(self.path)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self._out = system.open_output_stream(path)
        self._out.write(MAGIC)
        self._held: list[np.ndarray] = []
        self._n_held = self.ids = self._words = 0
        self._docs: list[tuple] = []
        self._blocks = [0]

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._docs.append((0 if doc_id is None else doc_id, doc_id is None, len(ids)))
        self.ids += len(ids)
        self._held.append(ids)
        self._n_held += len(ids)
        if self._n_held >= BLOCK:
            whole = np.concatenate(self._held)
            cut = len(whole) - len(whole) % BLOCK
            for at in range(0, cut, BLOCK):
                self._block(whole[at : at + BLOCK])
            self._held, self._n_held = [whole[cut:]], len(whole) - cut

    def _block(self, ids: np.ndarray) -> None:
        words = encode_block(ids)
        self._out.write(words.astype("<u8").tobytes())
        self._words += len(words)
        self._blocks.append(self._words)

    def close(self) -> tuple[str, int, int]:
        if self._n_held:
            self._block(np.concatenate(self._held))
        docs = np.array(self._docs, dtype="<i8").reshape(-1, 3)
        footer = np.concatenate(
            [[len(docs), len(self._blocks) - 1], docs[:, 0], docs[:, 1], docs[:, 2], self._blocks]
        )
        data = footer.astype("<i8").tobytes()
        self._out.write(data + len(data).to_bytes(8, "little"))
        self._out.close()
        return self.path, len(docs), self.ids


def read_file(path: str) -> Iterator[tuple[int | None, Iterator[np.ndarray]]]:
    """The documents of a file in order: doc_id, and its ids in runs of at most a block.

    The runs of a document must be taken before the next document is asked for.
    """
    system, path = file_system(path)
    with system.open_input_file(path) as file:
        size = file.size()
        if file.read_at(8, 0) != MAGIC:
            raise ValueError(f"{path}: not an id file")
        length = int.from_bytes(file.read_at(8, size - 8), "little")
        footer = np.frombuffer(file.read_at(length, size - 8 - length), "<i8")
        docs, blocks = int(footer[0]), int(footer[1])
        doc_ids, missing, counts = footer[2 : 2 + 3 * docs].reshape(3, docs)
        offsets = footer[2 + 3 * docs :]
        left = int(counts.sum())
        held, at, block = np.zeros(0, np.uint64), 0, 0

        def runs(n: int) -> Iterator[np.ndarray]:
            nonlocal held, at, block, left
            while n:
                if at == len(held):
                    first, last = int(offsets[block]), int(offsets[block + 1])
                    words = np.frombuffer(file.read_at((last - first) * 8, 8 + first * 8), "<u8")
                    held, at, block = decode_block(words, min(BLOCK, left)), 0, block + 1
                    left -= len(held)
                part = held[at : at + n]
                at += len(part)
                n -= len(part)
                yield part

        for k in range(docs):
            yield (None if missing[k] else int(doc_ids[k])), runs(int(counts[k]))
        assert block == blocks


def write_id_files(df: DataFrame, encoder, folder: str, end_id: int | None = None) -> DataFrame:
    """Write the ids of ``df`` (doc_id, text) in ascending doc_id order; returns the file list.

    ``encoder()`` builds an object whose ``encode(text)`` gives little-endian 32-bit ids
    and which a task tells to ``forget()`` at its end.
    Documents are dealt out by ranges of doc_id, each range sorted and written by one
    task. Null ids come first, rows of one id in the order of their texts' hashes; null
    texts count as empty. An empty table gives an empty list.
    The list: path, part and number (the order of the files), n_docs, n_ids.
    """
    small_batches(df.sparkSession)

    def write(batches):
        from pyspark import TaskContext

        part, number, made = TaskContext.get().partitionId(), 0, encoder()
        writer = None
        for doc_id, text in rows_of(batches, ["doc_id", "text"]):
            writer = writer or FileWriter(folder)
            ids = np.frombuffer(made.encode(text), "<u4")
            if end_id is not None:
                ids = np.concatenate([ids, np.array([end_id], np.uint32)])
            writer.add(doc_id, ids)
            if writer.ids >= FILE_IDS:
                yield part, number, *writer.close()
                writer, number = None, number + 1
        if writer:
            yield part, number, *writer.close()
        made.forget()

    order = [F.asc_nulls_first("doc_id"), F.asc("tie")]
    files = (
        df.select("doc_id", "text", F.xxhash64("text").alias("tie"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(lambda batches: batches_of(write(batches), LIST, 1), LIST)
    )
    return stage(files, "id-file-list")


def read_id_files(files: DataFrame) -> DataFrame:
    """Per document of the listed files: doc_id, start (ids of all documents before it),
    n_tokens and the crc32 of its ids as little-endian 32-bit integers."""

    def read(batches):
        for path, start in rows_of(batches, ["path", "before"]):
            for doc_id, runs in read_file(path):
                n = crc = 0
                for run in runs:
                    n += len(run)
                    crc = zlib.crc32(run.astype("<u4").tobytes(), crc)
                yield doc_id, start, n, crc
                start += n

    # One row per file: what this window sorts is the list of files, not their ids.
    earlier = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    listed = files.withColumn("before", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))
    listed = stage(listed, "id-file-starts")
    return per_file(listed).mapInArrow(lambda batches: batches_of(read(batches), INDEX), INDEX)


def encode_and_read(df: DataFrame, encoder, end_id: int | None = None) -> DataFrame:
    folder = shared_folder(df.sparkSession, "id-files")
    return read_id_files(write_id_files(df, encoder, folder, end_id))
