"""Sum-of-squares packing of token ids into windows of one length.

A document is cut into whole windows and a remainder. The remainder goes into the fill
level that leaves the sum of squared counts of partly filled windows smallest: with
N(h) windows filled to level h, moving one from h to h + s changes the sum by
2 (N(h + s) - N(h)) + 2, opening a window by 2 N(s) + 1 and completing one by
1 - 2 N(h). The counts are one level array, and the choice one scan over it.

Packing is online and each task packs the rows it scans, so texts and ids are never
shuffled. At its end, and whenever more than ``OPEN`` windows are partly filled, a
task completes them: the pieces of the emptiest windows are cut to fill the fullest,
so at most one window of a task is padded. A task's sequences are numbered from its
partition number on, so a task that runs again makes the same sequences.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame

from .common import batches_of, rows_of, small_batches

# Partly filled windows a task holds; bounds its memory at OPEN windows of ids.
OPEN = 4096

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


class Packer:
    """``add`` and ``finish`` return finished pieces as tuples in the order of ``PIECES``."""

    def __init__(self, window: int, first_sequence: int = 0):
        self.window = window
        self.level = np.zeros(window + 1, np.int64)  # open windows by fill
        self.at: list[list[list]] = [[] for _ in range(window + 1)]
        self.open = 0
        self.next = first_sequence

    def add(self, doc_id, ids: np.ndarray) -> list[tuple]:
        out, n = [], len(ids)
        whole = n - n % self.window
        for start in range(0, whole, self.window):
            out += self._close([(doc_id, start, ids[start : start + self.window], n)])
        if n > whole:
            # A copy: a view would keep the whole document's ids while the window is open.
            out += self._place((doc_id, whole, ids[whole:].copy(), n))
        if self.open > OPEN:
            out += self.finish()
        return out

    def choose(self, size: int) -> int:
        """The level to move to ``level + size``; 0 opens a window. Ties go to the fuller level."""
        level, top = self.level, self.window - size
        change = 2 * (level[size : self.window] - level[:top]) + 2
        cost = np.append(change, 1 - 2 * level[top])
        cost[level[: top + 1] == 0] = np.iinfo(np.int64).max
        cost[0] = 2 * level[size] + 1
        return top - int(np.argmin(cost[::-1]))

    def _place(self, piece: tuple) -> list[tuple]:
        size = len(piece[2])
        fill = self.choose(size)
        if fill:
            pieces = self.at[fill].pop()
            self.level[fill] -= 1
            self.open -= 1
        else:
            pieces = []
        pieces.append(piece)
        if fill + size == self.window:
            return self._close(pieces)
        self.at[fill + size].append(pieces)
        self.level[fill + size] += 1
        self.open += 1
        return []

    def _close(self, pieces: list[tuple]) -> list[tuple]:
        out, offset = [], 0
        for doc_id, start, ids, n in pieces:
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            out.append((doc_id, start, len(ids), crc, n, self.next, offset))
            offset += len(ids)
        self.next += 1
        return out

    def finish(self) -> list[tuple]:
        """Complete all open windows, the fullest first, from the pieces of the emptiest."""
        windows = [p for fill in range(self.window, 0, -1) for p in self.at[fill]]
        fills = [sum(len(p[2]) for p in pieces) for pieces in windows]
        out, low, high = [], 0, len(windows) - 1
        while low <= high:
            pieces, fill = windows[low], fills[low]
            while fill < self.window and high > low:
                doc_id, start, ids, n = windows[high].pop()
                take = min(len(ids), self.window - fill)
                cut = len(ids) - take
                pieces.append((doc_id, start + cut, ids[cut:], n))
                if cut:
                    windows[high].append((doc_id, start, ids[:cut], n))
                fill += take
                fills[high] -= take
                if not windows[high]:
                    high -= 1
            out += self._close(pieces)
            low += 1
        self.level[:] = 0
        self.at = [[] for _ in range(self.window + 1)]
        self.open = 0
        return out


def pack(df: DataFrame, encoder, window: int = 1024, end_id: int | None = 0) -> DataFrame:
    """Pieces of the documents of ``df`` (doc_id, text): where each run of ids lies.

    ``encoder()`` builds an object whose ``encode(text)`` gives little-endian 32-bit ids
    and which a task tells to ``forget()`` at its end;
    ``end_id`` is appended to each document. Null texts count as empty; a document
    without ids has no piece. Repeated rows are packed once each. Other columns are not
    read. An empty table gives no rows.
    """
    small_batches(df.sparkSession)
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def run(batches):
        from pyspark import TaskContext

        made = encoder()
        packer = Packer(window, TaskContext.get().partitionId() << 33)
        for doc_id, text in rows_of(batches, ["doc_id", "text"]):
            yield from packer.add(doc_id, np.frombuffer(made.encode(text) + end, "<u4"))
        yield from packer.finish()
        made.forget()

    return df.select("doc_id", "text").mapInArrow(
        lambda batches: batches_of(run(batches), PIECES), PIECES
    )
