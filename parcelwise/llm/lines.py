"""Line dedup by winnowing over line hashes.

A document is the sequence of its lines that have words. A window is a shortest run of
lines of at least ``words`` words, forward from its first line or backward from its last
one. Each window selects the smallest of its line hashes as its fingerprint. Runs of
lines that two places share select the same fingerprints, so a run of ``words`` words or
more cannot be missed, and fingerprints seen once end the search.

Positions are joined on fingerprint and window, and the windows that lie at an earlier
place too are repeats. Forward windows extend a match to the right of its fingerprint and
backward windows to its left, line by line, so the union of a document's repeats is what
the longest matches cover, and that is deleted. Order is by doc_id and line, so the first
occurrence of each run stays.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import batches_of, drop_staged, rows_of, small_batches, stage
from .shingles import BASE, BASE_INVERSE, mix

WORDS = 50

PRINT = (
    "doc_id long, tie long, print long, again boolean, "
    "windows array<long>, firsts array<long>, lasts array<long>"
)
EDITED = "text string, deleted long"


def lines_of(text: str | None) -> tuple[list[str], np.ndarray]:
    """All lines of a text, and the numbers of those with words."""
    lines = (text or "").split("\n")
    return lines, np.array([k for k, line in enumerate(lines) if line and not line.isspace()], np.int64)


def windows(counts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last line of all forward and backward windows, each once."""
    ends = np.cumsum(counts)
    starts = ends - counts
    last = np.searchsorted(ends, starts + words, "left")
    forward = last < len(counts)
    first = np.searchsorted(starts, ends - words, "right") - 1
    backward = first >= 0
    each = np.arange(len(counts))
    a = np.concatenate([each[forward], first[backward]])
    b = np.concatenate([last[forward], each[backward]])
    both = np.unique(a * len(counts) + b)
    return both // max(1, len(counts)), both % max(1, len(counts))


def smallest(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least hash of each window, by doubling spans."""
    levels, span = [hashes], 1
    longest = int((last - first).max()) + 1
    while span * 2 <= longest:
        before = levels[-1]
        levels.append(np.minimum(before[: len(before) - span], before[span:]))
        span *= 2
    out = np.empty(len(first), hashes.dtype)
    level = np.frexp((last - first + 1).astype(float))[1] - 1
    for k in np.unique(level):
        mine = level == k
        out[mine] = np.minimum(levels[k][first[mine]], levels[k][last[mine] - (1 << int(k)) + 1])
    return out


def prints(text: str | None, words: int) -> dict[int, tuple[list, list, list]]:
    """Of each fingerprint of a text: its windows' hashes, first and last lines."""
    import xxhash

    lines, full = lines_of(text)
    kept = [lines[k] for k in full]
    counts = np.array([len(line.split()) for line in kept], np.int64)
    if not len(kept) or counts.sum() < words:
        return {}
    hashes = np.array([xxhash.xxh3_64_intdigest(line.strip().encode("utf-8", "replace")) for line in kept], np.uint64)
    first, last = windows(counts, words)
    chosen = smallest(hashes, first, last).view(np.int64)
    # Hash of a run: its lines' hashes by powers of BASE, moved to start at the power 0.
    steps = np.full(len(kept) + 1, BASE)
    steps[0] = 1
    back = np.full(len(kept) + 1, BASE_INVERSE)
    back[0] = 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * np.cumprod(steps)[:-1])])
    names = mix((sums[last + 1] - sums[first]) * np.cumprod(back)[first] + (last - first + 1).astype(np.uint64))
    order = np.argsort(chosen, kind="stable")
    cuts = np.flatnonzero(np.diff(chosen[order])) + 1
    out = {}
    for part in np.split(order, cuts):
        out[int(chosen[part[0]])] = (names[part].view(np.int64).tolist(), first[part].tolist(), last[part].tolist())
    return out


def repeats(df: DataFrame, words: int = WORDS) -> DataFrame:
    """The repeats of each place of ``df`` (doc_id, tie, text): first and last lines, counted
    among the lines with words."""

    def run(batches):
        for doc_id, tie, text in rows_of(batches, ["doc_id", "tie", "text"]):
            for name, (found, firsts, lasts) in prints(text, words).items():
                yield doc_id, tie, name, len(set(found)) < len(found), found, firsts, lasts

    all_prints = stage(
        df.select("doc_id", "tie", "text").mapInArrow(lambda b: batches_of(run(b), PRINT, 2000), PRINT),
        "line-prints",
    )
    # A fingerprint of one document, with no window twice, ends here.
    home = F.struct("doc_id", "tie")
    shared = (
        all_prints.groupBy("print")
        .agg(F.min(home).alias("low"), F.max(home).alias("high"), F.max("again").alias("again"))
        .filter("low <> high or again")
        .select("print")
    )
    places = (
        all_prints.join(shared, "print")
        .select("print", "doc_id", "tie", F.explode(F.arrays_zip("windows", "firsts", "lasts")).alias("w"))
        .select("print", F.col("w.windows").alias("window"), "doc_id", "tie", "w.firsts", "w.lasts")
    )
    places = stage(places, "line-places")
    drop_staged(all_prints)
    place = F.struct("doc_id", "tie", "firsts")
    earliest = (
        places.groupBy("print", "window")
        .agg(F.min(place).alias("earliest"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("print", "window", "earliest")
    )
    later = places.join(earliest, ["print", "window"]).filter(place > F.col("earliest"))
    # As many spans as two per line of the document at most.
    spans = later.groupBy("doc_id", "tie").agg(F.collect_list(F.struct("firsts", "lasts")).alias("s"))
    spans = stage(spans.select("doc_id", "tie", "s.firsts", "s.lasts"), "line-spans")
    drop_staged(places)
    return spans


def cut(text: str, firsts: list[int], lasts: list[int]) -> tuple[str, int]:
    """The text without the lines of the spans, and how many those are."""
    lines, full = lines_of(text)
    change = np.zeros(len(full) + 1, np.int64)
    np.add.at(change, np.array(firsts, np.int64), 1)
    np.add.at(change, np.array(lasts, np.int64) + 1, -1)
    gone = set(full[np.cumsum(change)[:-1] > 0].tolist())
    return "\n".join([line for k, line in enumerate(lines) if k not in gone]), len(gone)


def dedup(df: DataFrame, words: int = WORDS) -> DataFrame:
    """The rows of ``df`` (doc_id, text, ...) with later repeats of line runs deleted, and
    the number of lines deleted as deleted_lines, which replaces a column of that name.

    Lines are equal if they are after stripping outer blanks; lines without words belong to
    no run and stay. Repeats within a document count. Null texts stay null. A null doc_id
    comes before all others, texts of one doc_id follow by hash, and rows equal in both are
    one place: their runs do not delete one another. An empty table gives no rows.
    """
    small_batches(df.sparkSession)
    # Rows that repeat a doc_id with another text are places of their own.
    key = [F.coalesce("doc_id", F.lit(-(2**63))).alias("doc_id"), F.xxhash64("text").alias("tie")]
    spans = repeats(df.select(*key, "text"), words)
    keyed = df.select(F.struct("*").alias("row"), *key)
    # One plan at every size: a broadcast of the spans would end where they outgrow it.
    edited = keyed.join(spans.hint("merge"), ["doc_id", "tie"], "left").withColumn(
        "edit", edit_udf()("row.text", "firsts", "lasts")
    )
    columns = [F.col("edit.text").alias(c) if c.lower() == "text" else F.col("row").getField(c).alias(c)
               for c in df.columns if c.lower() != "deleted_lines"]
    return edited.select(*columns, F.col("edit.deleted").alias("deleted_lines"))


def edit_udf():
    def edit(texts: pd.Series, firsts: pd.Series, lasts: pd.Series) -> pd.DataFrame:
        out = [
            (t, 0) if t is None or a is None else cut(t, a.tolist(), b.tolist())
            for t, a, b in zip(texts, firsts, lasts)
        ]
        return pd.DataFrame(out, columns=["text", "deleted"])

    return F.pandas_udf(edit, EDITED)
