"""Hashes of words and word shingles of whole texts, computed in tasks with numpy.

Texts are read as UTF-8 bytes: A-Z are lower-cased and the six ASCII blanks part words.  A word's
hash is a polynomial in its bytes, taken from running sums over a block of text, so a block costs a
few passes over its bytes and no Python step per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that are hashed at once; a longer word makes its block longer.
BLOCK = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    blank = np.zeros(256, bool)
    blank[[32, *range(9, 14)]] = True
    other = np.arange(256) < 128
    other[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
    return lower, blank, other


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for b in (_BASE, inverse):
        p = np.ones(n, _U)
        p[1:] = b
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def word_hashes(text: str) -> np.ndarray:
    """One 64-bit hash per word, in order."""
    return words_at(text)[0]


def words_at(text: str, plain: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, end) of each word; ``plain``: all ASCII but letters and digits part words."""
    return _words(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), plain)


def _words(raw: np.ndarray, plain: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    blank, out, at = _tables()[1 + plain], [], 0
    if len(raw) <= BLOCK:
        return _block(raw, blank)
    while at < len(raw):
        end = min(at + BLOCK, len(raw))
        while end < len(raw) and not blank[raw[end]]:  # to the next blank
            near = np.flatnonzero(blank[raw[end : end + BLOCK]])
            end = end + int(near[0]) if len(near) else min(end + BLOCK, len(raw))
        h, first, last = _block(raw[at:end], blank)
        out.append((h, first + at, last + at))
        at = end
    return tuple(np.concatenate(x) for x in zip(*out))


def _block(raw: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lower = _tables()[0]
    word = ~blank[raw]
    edge = np.diff(word.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.zeros(0, _U), start, end
    size = BLOCK
    while size < len(raw):
        size *= 2
    power, inverse = _powers(size)
    sums = np.zeros(len(raw) + 1, _U)
    np.cumsum((lower[raw].astype(_U) + _U(1)) * power[: len(raw)], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(_U)), start, end


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the ``k``-word shingles, in order; with fewer words, of the whole sequence."""
    n = len(words)
    if not n:
        return words
    if n < k:
        k = n
    out = np.zeros(n - k + 1, _U)
    for j in range(k):
        out = mix(out + words[j : n - k + 1 + j] + _U(j + 1))
    return out


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Distinct shingle hashes of a text, ascending; none for null texts and texts without words."""
    return np.unique(shingle_hashes(word_hashes(text), k)) if text else np.zeros(0, _U)


def shingle_groups(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, members, members per row) for runs of rows of a column of texts.

    ``members`` has the rows' distinct shingle hashes one after the other, each row's ascending.  A run
    has about ``BLOCK`` bytes of text, so memory is bounded and numpy's calls are shared by many rows;
    a longer text is a run of its own.  Null texts have no members.
    """
    column = pc.fill_null(column, "").cast(pa.large_string())
    offset = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offset + np.arange(len(offset)), offset[lo] + lo + BLOCK, side="right")) - 1)
        raw, size = data[offset[lo] : offset[hi]], np.diff(offset[lo : hi + 1])
        if hi == lo + 1:
            members = np.unique(shingle_hashes(_words(raw)[0], k))
            yield lo, hi, members, np.array([len(members)])
        else:
            yield lo, hi, *_run(raw, size, k)
        lo = hi


def _run(raw: np.ndarray, size: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(size)
    padded = np.full(len(raw) + n, 32, np.uint8)  # a blank after each text keeps its words apart
    padded[np.arange(len(raw)) + np.repeat(np.arange(n), size)] = raw
    h, start, _ = _block(padded, _tables()[1])
    row = np.searchsorted(np.cumsum(size + 1), start, side="right")
    words = np.bincount(row, minlength=n)
    whole = np.flatnonzero((words > 0) & (words < k))
    per = np.maximum(words - (k - 1), 0)
    per[whole] = 1
    end = np.cumsum(per)
    members, short = np.empty(int(per.sum()), _U), np.zeros(int(per.sum()), bool)
    first = np.cumsum(words) - words
    for i in whole.tolist():
        members[end[i] - 1] = shingle_hashes(h[first[i] : first[i] + words[i]], k)[0]
    short[end[whole] - 1] = True
    if len(h) >= k:
        members[~short] = shingle_hashes(h, k)[row[: len(h) - k + 1] == row[k - 1 :]]
    for i, j in zip((end - per).tolist(), end.tolist()):
        members[i:j].sort()
    new = np.ones(len(members), bool)
    new[1:] = members[1:] != members[:-1]
    new[(end - per)[per > 0]] = True
    upto = np.concatenate([[0], np.cumsum(new)])
    return members[new], upto[end] - upto[end - per]


def set_digests(members: np.ndarray, per: np.ndarray) -> np.ndarray:
    """64-bit names of sets of hashes that stand one after the other; 0 for empty ones."""
    out = np.zeros(len(per), np.int64)
    some = per > 0
    if some.any():
        at = (np.cumsum(per) - per)[some]
        a = np.add.reduceat(mix(members + _U(0xA0761D6478BD642F)), at)
        b = np.bitwise_xor.reduceat(mix(members ^ _U(0xE7037ED1A0B428DB)), at)
        out[some] = mix(a ^ mix(b + per[some].astype(_U))).astype(np.int64)
    return out


def set_digest(members: np.ndarray) -> int:
    """64-bit name of one set of hashes, as a signed number."""
    return int(set_digests(members, np.array([len(members)]))[0])
