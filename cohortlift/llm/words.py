"""Vectorised words of Arrow text columns: 64-bit word hashes and n-gram hashes, without a Python object per word.

A word's hash is a polynomial over random values of its bytes modulo 2^64, read off prefix sums, then mixed.
All work on text is cut into pieces of at most ``CHUNK`` bytes (a single longer word makes a longer piece), so the
temporary arrays stay small however long a text is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18
U64 = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values (xor-shift and multiply); wraps around by intent."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=U64) * U64(_MULTIPLIER))
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


BYTE_VALUES = _byte_values()
#: Words are runs of bytes other than blank, tab to carriage return; multi-byte characters hold none of these.
SPACES = np.zeros(256, dtype=bool)
SPACES[[32, *range(9, 14)]] = True
#: Runs of ASCII letters, digits and bytes of multi-byte characters.
NOT_ALNUM = np.ones(256, dtype=bool)
for _low, _high in ((48, 57), (65, 90), (97, 122), (128, 255)):
    NOT_ALNUM[_low : _high + 1] = False


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The multiplier's powers 0 to n-1 and their inverses."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, CHUNK + 1)
        for key, base in (("up", _MULTIPLIER), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=U64)
            steps[0] = 1
            _POWERS[key] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and its offsets (rows + 1); a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type not in (pa.string(), pa.large_string()):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = np.int64 if column.type == pa.large_string() else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def _pieces(raw: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes with a blank between documents, positions where documents begin, first document) of each piece.

    A document longer than a piece is cut at a separator and goes on in the next piece.
    """
    n_docs, doc, start = len(offsets) - 1, 0, 0
    while doc < n_docs:
        # whole documents that fit
        last = int(np.searchsorted(offsets, start + CHUNK, "right")) - 1
        if last > doc:
            inner = offsets[doc + 1 : last] - start
            yield np.insert(raw[start : offsets[last]], inner, 32), np.concatenate(([0], inner + np.arange(1, len(inner) + 1))), doc
            doc, start = last, int(offsets[last])
            continue
        end = int(offsets[doc + 1])
        cut = min(start + CHUNK, end)
        while cut < end:
            back = np.flatnonzero(separators[raw[start:cut]])
            if len(back):
                cut = start + int(back[-1]) + 1
                break
            cut = min(cut + CHUNK, end)
        yield raw[start:cut], np.zeros(1, np.int64), doc
        start = cut
        if cut == end:
            doc += 1


def find_words(
    raw: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES, prefixes: tuple[int, ...] = ()
) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Hashes of all words in order, the offsets of each document's words, and hashes of word prefixes.

    ``prefixes`` are lengths in bytes; a word that is not longer than a length has 0 there.
    """
    hashes, extra = [], [[] for _ in prefixes]
    counts = np.zeros(len(offsets), np.int64)
    for piece, begins, doc in _pieces(raw, offsets, separators):
        n = len(piece)
        if not n:
            continue
        up, down = powers(n + 1)
        inside = np.zeros(n + 2, np.int8)
        inside[1:-1] = ~separators[piece]
        edge = np.diff(inside)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.empty(n + 1, U64)
        sums[0] = 0
        np.cumsum(BYTE_VALUES[piece] * up[:n], out=sums[1:])
        at, scale = sums[starts], down[starts]
        hashes.append(mix((sums[ends] - at) * scale + (ends - starts).astype(U64)))
        for length, found in zip(prefixes, extra):
            stops = starts + length
            h = mix((sums[np.minimum(stops, n)] - at) * scale + U64(length << 32))
            h[stops >= ends] = 0
            found.append(h)
        owner = np.searchsorted(begins, starts, "right") - 1 + doc
        counts[1:] += np.bincount(owner, minlength=len(offsets) - 1)
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, U64)
    return join(hashes), np.cumsum(counts), [join(p) for p in extra]


_STEP = [U64(pow(0xD6E8FEB86659FD93, k, 1 << 64)) for k in range(64)]


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams of one document's words; with fewer words the whole sequence is one; none without words."""
    size = min(n, len(words))
    if not size:
        return words[:0]
    many = len(words) - size + 1
    total = np.full(many, U64(size), U64)
    for k in range(size):
        total += words[k : k + many] * _STEP[k % 64]
    return mix(total)


def all_grams(words: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """n-grams at every word position of many documents, and whether the position holds a whole one of its document."""
    if len(words) < n:
        return words[:0], np.zeros(0, bool)
    many = len(words) - n + 1
    total = np.full(many, U64(n), U64)
    for k in range(n):
        total += words[k : k + many] * _STEP[k % 64]
    left = np.repeat(offsets[1:], np.diff(offsets))[:many] - np.arange(many)
    return mix(total), left >= n


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def unsigned(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h).view(U64)
