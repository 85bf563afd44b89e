"""Distinct word shingles of texts as 64-bit hashes."""

from __future__ import annotations

import numpy as np

# Fixed odd multipliers of the hashes.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
# Bytes hashed at once; longer texts are cut between words.
PART = 1 << 20

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse to the powers from 0 on."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", BASE), ("down", BASE_INVERSE)):
            steps = np.full(size, base)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX_1
    h = (h ^ (h >> np.uint64(27))) * MIX_2
    return h ^ (h >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """A hash per word of a text, A-Z lower-cased; words end at blanks and control blanks."""
    byte = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    out, start = [], 0
    while start < len(byte):
        end = len(byte)
        if end - start > PART:
            gaps = np.flatnonzero(separators(byte[start + PART :]))
            end = start + PART + int(gaps[0]) if len(gaps) else end
        out.append(_words(byte[start:end]))
        start = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def separators(byte: np.ndarray) -> np.ndarray:
    return (byte == 32) | ((byte - np.uint8(9)) < 5)


def _words(byte: np.ndarray) -> np.ndarray:
    gap = separators(byte)
    edges = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    lower = byte + ((byte - np.uint8(65)) < 26).astype(np.uint8) * np.uint8(32)
    up, down = powers(len(byte) + 1)
    sums = np.zeros(len(byte) + 1, np.uint64)
    np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def runs_of(words: np.ndarray, width: int) -> np.ndarray:
    """A hash per run of ``width`` words, or of all words if there are fewer."""
    span = min(width, len(words))
    runs = words[: len(words) - span + 1] + np.uint64(span)
    for k in range(1, span):
        runs = mix(runs * BASE + words[k : len(words) - span + 1 + k])
    return runs


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of ``width`` words; of a text with fewer words,
    of all its words as one; empty for a text without words or null."""
    words = word_hashes(text) if text else np.zeros(0, np.uint64)
    return np.unique(runs_of(words, width)) if len(words) else words


def scored_set(text: str | None, width: int, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingle set, and for each shingle the sum of its words' levels. ``levels`` has
    a power of two of small numbers, looked up by word hash."""
    words = word_hashes(text) if text else np.zeros(0, np.uint64)
    if not len(words):
        return words, np.zeros(0, np.int64)
    grams, first = np.unique(runs_of(words, width), return_index=True)
    sums = np.concatenate([[0], np.cumsum(levels[(words & np.uint64(len(levels) - 1)).astype(np.int64)], dtype=np.int64)])
    span = min(width, len(words))
    return grams, sums[first + span] - sums[first]


def set_name(grams: np.ndarray) -> int:
    """A signed 64-bit hash of a whole set."""
    import xxhash

    return int.from_bytes(xxhash.xxh3_64_digest(grams.tobytes()), "big", signed=True)


def parity_sketch(grams: np.ndarray, words: int = 16) -> np.ndarray:
    """Bit b is the parity of the number of shingles hashed to b. The sketches of two sets
    differ in no more bits than the sets differ in shingles."""
    bits = np.bincount((grams >> np.uint64(40)).astype(np.int64) % (64 * words), minlength=64 * words)
    return np.packbits((bits & 1).astype(np.uint8), bitorder="little").view("<i8")
