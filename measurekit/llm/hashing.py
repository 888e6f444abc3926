"""64-bit hashes of the words of many texts at once, straight from Arrow buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
#: Fixed odd constants of the mixing steps.
MULTIPLIER, STEP = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)
#: One random number a byte value.
BYTES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)

SPACES = b" \t\n\x0b\x0c\r"


def lower_table() -> np.ndarray:
    """A-Z to a-z, all other bytes to themselves."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def space_classes() -> np.ndarray:
    """1 for every byte that belongs to a word, 0 for ASCII white space."""
    table = np.ones(256, dtype=np.uint8)
    table[list(SPACES)] = 0
    return table


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * STEP
    h = (h ^ (h >> U(29))) * MULTIPLIER
    return h ^ (h >> U(32))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, MULTIPLIER, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string array and the n + 1 offsets of its texts in them; a null is empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(texts: pa.Array, classes: np.ndarray, lower: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and the n + 1 offsets of the texts in them.

    ``classes`` maps each byte to 0 (between words) or a class; a word is a longest run of one class in one text.
    Takes about 40 bytes of memory a byte of text.
    """
    data, offsets = buffers(texts)
    none = np.zeros(len(offsets), dtype=np.int64)
    if not len(data):
        return np.zeros(0, dtype=np.uint64), none
    kind = classes[data]
    start = np.empty(len(kind), dtype=bool)
    start[0] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start[offsets[:-1][offsets[:-1] < len(kind)]] = True
    begins = np.flatnonzero(start)
    lengths = np.diff(np.append(begins, len(kind)))
    place = np.arange(len(kind)) - np.repeat(begins, lengths)
    terms = BYTES[data if lower is None else lower[data]]
    terms *= _powers(int(lengths.max()))[place]
    sums = np.add.reduceat(terms, begins)
    real = kind[begins] > 0
    begins = begins[real]
    found = mix(sums[real] + lengths[real].astype(np.uint64) * MULTIPLIER)
    return found, np.searchsorted(begins, offsets, side="left").astype(np.int64)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words that begin at each place of a row of words; the last n - 1 places have none."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = words[:count]
    for i in range(1, n):
        h = mix(h * MULTIPLIER + words[i : i + count])
    return h
