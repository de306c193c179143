"""Words of many texts at once, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

import numpy as np

#: An odd multiplier and its inverse modulo 2**64, for polynomial hashes by prefix sums.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX = np.uint64(0xD6E8FEB86659FD93)


def _letters() -> np.ndarray:
    """Byte to its word byte: ASCII letters lower-cased, digits and all above 127; 0 for the rest."""
    table = np.zeros(256, np.uint8)
    for code in range(256):
        if code >= 128 or chr(code).isalnum():
            table[code] = ord(chr(code).lower()) if code < 128 else code
    return table


LETTERS = _letters()


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes with a blank after each, and where each text starts."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8) if texts else np.zeros(0, np.uint8)
    return data, np.cumsum(sizes) - sizes


def word_features(texts: list[bytes], prefixes: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words of ``texts`` and how many words each text has.

    The buckets are a row per word: of its hash and of the hashes of its first bytes, as
    many as ``prefixes`` says.  Words are runs of letters and digits.
    """
    data, text_starts = joined(texts)
    letters = LETTERS[data]
    is_word = letters != 0
    edge = np.diff(is_word.astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(letters.astype(np.uint64) * powers(BASE, len(data)), out=sums[1:])
    shift = powers(INVERSE, len(data))[starts]
    out = np.empty((len(starts), 1 + len(prefixes)), np.int32)
    low = np.uint64(64 - (buckets - 1).bit_length())
    for k, length in enumerate((None, *prefixes)):
        to = ends if length is None else np.minimum(ends, starts + length)
        value = (sums[to] - sums[starts]) * shift + np.uint64(k + 1)
        value ^= value >> np.uint64(29)
        out[:, k] = (value * MIX) >> low
    counts = np.diff(np.searchsorted(starts, np.append(text_starts, len(data))))
    return out, counts
