"""Phrase collocations by top-order marginalisation.

Each word occurrence leads one window: its word and the four that follow it in its piece
of text, padded at the piece's end, as the columns w1 to w5. Only these longest windows
are counted. A phrase of k words occurs as often as windows begin with it, so Spark's
ROLLUP over the lead columns sums the counts of all shorter phrases from them, and no
n-gram of another order is ever exploded.

Windows are padded early where a phrase cannot be frequent any more. The words and the
word pairs that occur often enough are counted first, over all rows, and passed to the
tasks as bitmaps of their hashes: a window ends before a word, or a pair, that is not in
the map. A phrase is never more frequent than a pair in it, so no count of a frequent
phrase changes. The maps have 16 bits for each entry up to ``MOST_BITS`` in all; beyond
that they let more windows through and the counts stay exact.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from .common import small_batches, stage
from .shingles import BASE, mix

# Bits of the larger of the maps of frequent words and pairs: 16 MB, whatever the input.
MOST_BITS = 1 << 27
# Words a task counts at once, and bytes of one text that are split at once.
CHUNK, PART = 1 << 21, 1 << 20
# The marks that end a piece.
ENDS = b".,;:!?\n\x0b\x0c\r"
TABLE = bytes.maketrans(ENDS + b"\t", b"." * len(ENDS) + b" ")


class Codes(dict):
    """Numbers words in the order they are met; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def encode(text: bytes, codes: Codes) -> list[np.ndarray]:
    """The codes of a text's words, a 0 at each end of a piece and at the end."""
    data = text.lower().translate(TABLE)
    out, start = [], 0
    while start < len(data):
        end = data.find(b" ", start + PART)
        end = len(data) if end < 0 else end
        words = data[start:end].replace(b".", b" . ").split()
        out.append(np.fromiter(map(codes.__getitem__, words), np.int32, len(words)))
        start = end
    return [*out, np.zeros(1, np.int32)]


def chunks(batches):
    """(language, words, codes) for about ``CHUNK`` words at a time; whole texts only.

    Languages are bytes; words[c] is the word of code c.
    """
    import pyarrow as pa

    held: dict[bytes, tuple[Codes, list]] = {}
    size = 0
    for batch in batches:
        columns = [batch.column(c).cast(pa.binary()).to_pylist() for c in ("lang", "text")]
        for lang, text in zip(*columns):
            if not text:
                continue
            codes, parts = held.setdefault(lang, (Codes(), []))
            found = encode(text, codes)
            parts += found
            size += sum(map(len, found))
            if size >= CHUNK:
                for name, (known, kept) in held.items():
                    yield name, list(known), np.concatenate(kept)
                held, size = {}, 0
    for name, (known, kept) in held.items():
        yield name, list(known), np.concatenate(kept)


def hashes(lang: bytes, words: list[bytes]) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(lang + b"\0" + w) for w in words], np.uint64)


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * BASE + second)


class Bits:
    """Which hashes are in a set, with some others let through."""

    def __init__(self, size: int, data: np.ndarray):
        self.size, self.data = size, data

    def __getitem__(self, h: np.ndarray) -> np.ndarray:
        at = (h & np.uint64(self.size - 1)).astype(np.int64)
        return (self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def bits_of(df: DataFrame, most: int = MOST_BITS) -> Bits:
    """A map of the column ``h``; at most ``most`` bits reach the driver, in blocks of 4 KB."""
    size = 1 << 16
    rows = df.count()
    while size < 16 * rows and size < most:
        size *= 2
    at = F.col("h").bitwiseAND(F.lit(size - 1)) + 1
    found = (
        df.groupBy(F.bitmap_bucket_number(at).alias("block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
        .collect()
    )
    data = np.zeros(size // 8, np.uint8)
    for r in found:
        block = np.frombuffer(r["bits"], np.uint8)
        data[(r["block"] - 1) * 4096 :][: len(block)] = block[: len(data)]
    return Bits(size, data)


def _batch(columns: dict):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _repeat(lang: bytes, n: int):
    import pyarrow as pa

    return pa.array([lang] * n, pa.binary())


def word_counts(texts: DataFrame) -> DataFrame:
    """lang, word, h, f: how often each word occurs. The hash h tells words apart for maps only."""

    def run(batches):
        import pyarrow as pa

        for lang, words, codes in chunks(batches):
            n = np.bincount(codes, minlength=len(words))[1:]
            if len(n):
                yield _batch({
                    "lang": _repeat(lang, len(n)),
                    "word": pa.array(words[1:], pa.binary()),
                    "h": pa.array(hashes(lang, words[1:]).view(np.int64)),
                    "n": pa.array(n.astype(np.int64)),
                })

    found = texts.mapInArrow(run, "lang binary, word binary, h long, n long")
    return found.groupBy("lang", "word", "h").agg(F.sum("n").alias("f"))


def pair_counts(texts: DataFrame, frequent: Bits) -> DataFrame:
    """h, f: how often each pair of frequent words occurs in a row, by its hash."""

    def run(batches):
        import pyarrow as pa

        for lang, words, codes in chunks(batches):
            h = hashes(lang, words)
            often = frequent[h]
            often[0] = False
            both = often[codes[:-1]] & often[codes[1:]]
            pairs = codes[:-1][both].astype(np.int64) << 32 | codes[1:][both]
            pairs, n = np.unique(pairs, return_counts=True)
            key = pair_hashes(h[pairs >> 32], h[pairs & 0xFFFFFFFF])
            yield _batch({"h": pa.array(key.view(np.int64)), "n": pa.array(n.astype(np.int64))})

    return texts.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("f"))


def lead_columns(codes: np.ndarray, often: np.ndarray, linked: np.ndarray, longest: int) -> np.ndarray:
    """One row per frequent word occurrence: its code and those that follow it, 0 from the
    end of the piece or the first word or pair on that is not frequent."""
    starts = np.flatnonzero(often[codes])
    out = np.zeros((longest, len(starts)), np.int32)
    out[0] = codes[starts]
    going = np.ones(len(starts), bool)
    reach = np.append(linked, False)
    for k in range(1, longest):
        going &= reach[np.minimum(starts + k - 1, len(reach) - 1)]
        out[k][going] = codes[starts[going] + k]
    return out


def distinct_windows(lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different columns of ``lead`` and how often each occurs."""
    rank = lead[0].astype(np.int64)
    for k in range(1, len(lead) - 1):
        rank = np.unique(rank << 32 | lead[k], return_inverse=True)[1]
    _, first, n = np.unique(rank << 32 | lead[-1], return_index=True, return_counts=True)
    return lead[:, first], n


def windows(texts: DataFrame, words: Bits, pairs: Bits, longest: int) -> DataFrame:
    """lang, w1 to w``longest`` and n: the padded windows and how often each occurs in a
    chunk of a task. Padding is the empty word."""
    names = [f"w{k}" for k in range(1, longest + 1)]

    def run(batches):
        import pyarrow as pa

        for lang, known, codes in chunks(batches):
            h = hashes(lang, known)
            often = words[h]
            often[0] = False
            linked = often[codes[:-1]] & often[codes[1:]]
            at = np.flatnonzero(linked)
            linked[at] = pairs[pair_hashes(h[codes[at]], h[codes[at + 1]])]
            lead, n = distinct_windows(lead_columns(codes, often, linked, longest))
            spelled = pa.array([b"", *known[1:]], pa.binary())
            for start in range(0, len(n), 50_000):
                part = slice(start, start + 50_000)
                columns = {name: spelled.take(pa.array(c[part])) for name, c in zip(names, lead)}
                some = n[part].astype(np.int64)
                yield _batch({"lang": _repeat(lang, len(some)), **columns, "n": pa.array(some)})

    schema = ", ".join(f"{name} binary" for name in names)
    return texts.mapInArrow(run, f"lang binary, {schema}, n long")


def phrase_counts(found: DataFrame, least: int) -> DataFrame:
    """lang, words, f: all phrases that begin at least ``least`` windows, by ROLLUP."""
    names = [c for c in found.columns if c not in ("lang", "n")]
    # Rolled-up columns are null; padding is empty and never the end of a phrase.
    words = F.array_compact(F.array(*names))
    return (
        found.rollup("lang", *names)
        .agg(F.sum("n").alias("f"))
        .filter(F.col("f") >= least)
        .select("lang", words.alias("words"), "f")
        .filter((F.size("words") > 0) & (F.octet_length(F.element_at("words", -1)) > 0))
    )


def _phrase(words) -> F.Column:
    return F.array_join(F.transform(words, lambda w: w.cast("string")), " ")


def lowest_cuts(candidates: DataFrame, phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Each candidate with the counts and the score of its lowest-scoring cut.

    score = floor(1000 a n / (l r)) in decimals of 38 digits, exact while n is below
    10^18. It is at most 1000 n, a long.
    """
    counts = phrases.select("lang", "phrase", "f")
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", F.col("f").alias("a"), "k",
        _phrase(F.slice("words", F.lit(1), F.col("k"))).alias("head"),
        _phrase(F.slice("words", F.col("k") + 1, F.size("words"))).alias("tail"),
    )
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    met = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang")
    # Under 10^16 phrases and 10^18 words a product has at most 38 digits.
    top = "cast(1000 * a as decimal(19,0)) * cast(n as decimal(18,0))"
    bottom = "cast(l as decimal(19,0)) * cast(r as decimal(18,0))"
    lowest = F.min(F.struct(F.expr(f"{top} div ({bottom})").alias("score"), "k", "l", "r"))
    return (
        met.groupBy("lang", "phrase", "a", "n")
        .agg(lowest.alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )


def absorbed(candidates: DataFrame) -> DataFrame:
    """lang, phrase of candidates that never occur outside a longer one.

    A phrase is never less frequent than one that contains it, so if a longer phrase is as
    frequent as this one then so is one with one word more: only these are compared.
    """
    longer = candidates.filter(F.size("words") > 2)
    inner = F.array(
        F.slice("words", F.lit(1), F.size("words") - 1), F.slice("words", F.lit(2), F.size("words"))
    )
    parts = longer.select("lang", "f", F.explode(inner).alias("part"))
    # One row per phrase, so that a common phrase meets its own count only.
    most = parts.groupBy("lang", _phrase("part").alias("phrase")).agg(F.max("f").alias("outer"))
    met = candidates.select("lang", "phrase", "f").join(most, ["lang", "phrase"])
    return met.filter(F.col("outer") >= F.col("f")).select("lang", "phrase")


def collocations(df: DataFrame, longest: int = 5, least: int = 100, first: int = 2000) -> DataFrame:
    """Phrases of 2 to ``longest`` words (3 at least) that occur ``least`` times or more,
    scored against their parts: lang, rank, phrase, a, l, r, n, score.

    ``df`` needs text and lang; all other columns are ignored, whatever their names. A null
    lang counts as 'und', together with rows that say so. Null and empty texts have no
    words, texts of any length are read whole, and repeated rows count each time. Equal
    scores go by count, then by the bytes of the phrase, so ranks do not depend on the
    order of rows. An empty table, or one without frequent phrases, gives no rows.
    """
    small_batches(df.sparkSession)
    texts = df.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    words = stage(word_counts(texts), "words")
    totals = words.groupBy(F.col("lang").cast("string").alias("lang")).agg(F.sum("f").alias("n"))
    known = bits_of(words.filter(F.col("f") >= least))
    pairs = stage(pair_counts(texts, known).filter(F.col("f") >= least), "pairs")
    found = windows(texts, known, bits_of(pairs), longest)
    phrases = phrase_counts(found, least).select(
        F.col("lang").cast("string").alias("lang"), "words", _phrase("words").alias("phrase"), "f"
    )
    phrases = stage(phrases, "phrases")
    candidates = phrases.filter(F.size("words") > 1)
    scored = lowest_cuts(candidates, phrases, totals)
    scored = scored.join(absorbed(candidates), ["lang", "phrase"], "left_anti")
    # Spark keeps the first rows of each language in every task before it shuffles them.
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
