"""Word and shingle hashes of whole texts, computed for an Arrow batch at a time.

Words are runs of anything but space and \\t..\\r; A-Z is lower-cased.  A word's hash
is a polynomial over its bytes, taken from prefix sums so that a batch needs no
loop over words; a shingle's hash combines five word hashes.  Both are finished
with a 64-bit mixer.  Long texts are hashed in pieces cut between words, so memory
follows the number of words, not the bytes.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa

WORDS = 5
_PIECE = 1 << 18
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (in place)."""
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit constants."""
    x = np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed)
    return mix(x) | _U(1)


@cache
def _tables(fold: bool = True):
    code = constants(256, 77)
    if fold:
        code[65:91] = code[97:123]
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    return code, space, constants(WORDS, 5)


@cache
def _powers(n: int):
    base = _U(0x2545F4914F6CDD1D)
    inverse = _U(pow(int(base), -1, 1 << 64))
    up, down = np.ones(n + 1, _U), np.ones(n + 1, _U)
    up[1:], down[1:] = base, inverse
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _piece_words(data: np.ndarray, cut: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the words of a piece; ``cut`` are positions where a text begins."""
    code, space, _ = _tables(fold)
    n = len(data)
    blank = np.frombuffer(data.tobytes().translate(space.tobytes()), bool)
    first = np.empty(n, bool)
    first[0] = True
    first[1:] = blank[:-1]
    first[cut] = True
    last = np.empty(n, bool)
    last[-1] = True
    last[:-1] = first[1:] | blank[1:]
    used = ~blank
    starts = np.flatnonzero(first & used)
    ends = np.flatnonzero(last & used) + 1
    up, down = _powers(1 << max(18, int(n).bit_length()))
    sums = np.zeros(n + 1, _U)
    np.cumsum(code[data] * up[:n], out=sums[1:])
    value = (sums[ends] - sums[starts]) * down[starts]
    return starts, mix(value + (ends - starts).astype(_U) * _U(0x9E3779B97F4A7C15))


def batch_words(texts: pa.Array, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words of a column, where each text's words begin: one more than texts).

    ``fold`` lower-cases A-Z first.
    """
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    if len(texts) == 0:
        return np.empty(0, _U), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    base = offsets[0]
    size = int(offsets[-1] - base)
    offsets = offsets - base
    if size == 0:
        return np.empty(0, _U), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[base : base + size]
    space = _tables()[1]
    begins = offsets[:-1][offsets[:-1] < size]
    starts, hashes, at = [], [], 0
    while at < size:
        end = min(size, at + _PIECE)
        while end < size:
            # Back to a blank or to the start of a text; forward where a word fills the piece.
            gaps = np.empty(0, int)
            for tail in (max(at + 1, end - 4096), at + 1):
                gaps = np.flatnonzero(space[data[tail:end]]) + tail
                if len(gaps):
                    break
            begun = begins[np.searchsorted(begins, at, "right") : np.searchsorted(begins, end, "right")]
            best = max(int(gaps[-1]) if len(gaps) else at, int(begun[-1]) if len(begun) else at)
            if best > at:
                end = best
                break
            end = min(size, end + (end - at))
        low, high = np.searchsorted(begins, [at, end])
        s, h = _piece_words(data[at:end], begins[low:high] - at, fold)
        starts.append(s + at)
        hashes.append(h)
        at = end
    starts = np.concatenate(starts)
    return np.concatenate(hashes), np.searchsorted(starts, offsets)


def batch_shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes in text order, where each text's begin); repeats are kept.

    A text of one to four words has one shingle, the whole sequence.
    """
    hashes, at = batch_words(texts)
    mult = _tables()[2]
    n = len(hashes)
    counts = np.diff(at)
    total = np.where(counts >= WORDS, counts - WORDS + 1, (counts > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(total)])
    if n == 0:
        return np.empty(0, _U), bounds
    padded = np.concatenate([hashes, np.zeros(WORDS, _U)])
    value = padded[:n] * mult[0]
    for k in range(1, WORDS):
        value += padded[k : n + k] * mult[k]
    keep = np.zeros(n + 1, np.int32)
    # A text's shingles start at its first word and stop before its last four.
    has = counts > 0
    np.add.at(keep, at[:-1][has], 1)
    np.add.at(keep, at[:-1][has] + total[has], -1)
    keep = np.cumsum(keep[:n]) > 0
    for i in np.flatnonzero(has & (counts < WORDS)):
        own = hashes[at[i] : at[i + 1]]
        value[at[i]] = (own * mult[: len(own)]).sum(dtype=_U) + _U(len(own))
    return mix(value[keep]), bounds
