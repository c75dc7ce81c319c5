"""Interpolated modified Kneser-Ney language model: counted in Spark, stored as sorted hash arrays, read by memory map.

Tokens are the words of a text (runs without blanks, A-Z lower-cased) and one end; a text is preceded by ``order - 1``
begins.  The words are counted first: a shard holds a range of their 64-bit hashes, sorted, and a word's number is its place
over all shards, which takes four bytes up to 2^32 words.  An n-gram is named by a hash of its words' numbers.  Tasks count
the n-grams of their rows and send each shard one packed block of numbers and sorted counts.  An n-gram goes to the shard of
its context, the words before the last one, so a shard has all followers of its contexts: it adds its blocks and writes to the
shared folder the sorted names of its contexts, for each its total and its numbers of followers seen once, twice and more often,
and the numbers and counts of its followers, sorted.  What it sends on are the distinct predecessors of the shorter n-grams.

Workers map the arrays and look up sorted batches.  ``spark.checkpoint.dir`` must therefore be a folder that driver and
executors have mounted; the arrays grow with the corpus, their maps take no memory that the system can't reclaim.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlift.llm import words as W
from cohortlift.llm.scratch import discard, lean, release, table
from cohortlift.session import scratch_path

ORDER, TOKENS_AT_ONCE, SHARDS, SHARD_BYTES = 2, 1 << 22, 16, 32 << 20
_GRAMS, _WORDS = 1, 2
#: A context's total and its followers seen twice and more often; where its followers begin: a place for every STRIDE contexts, and
#: the distance from it; their last words and counts.
FOLLOWERS, STRIDE = {"t": "u1", "f2": "u1", "f3": "u1", "starts": "u8", "shift": "u1", "c": "u1"}, 16
_END, _BEGIN = (W.mix(np.array([k], np.uint64))[0] for k in (0xE17D, 0xBE61))


def local_path(uri: str) -> str:
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped arrays need a mounted shared folder, not {uri}")
    return unquote(parts.path)


def token_stream(column: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of many texts, each after ``order - 1`` begins, and the offsets of the texts."""
    hashes, at, _ = W.find_words(*W.text_buffer(column))
    pad = order - 1
    n = np.diff(at)
    offsets = np.concatenate(([0], np.cumsum(n + pad + 1)))
    out = np.empty(offsets[-1], np.uint64)
    for k in range(pad):
        out[offsets[:-1] + k] = _BEGIN
    out[offsets[1:] - 1] = _END
    doc = np.repeat(np.arange(len(n)), n)
    out[np.arange(len(hashes)) - at[doc] + offsets[doc] + pad] = hashes
    return out, offsets


def name(tokens: list[np.ndarray]) -> np.ndarray:
    """Hash of the n-grams whose k-th words are ``tokens[k]``; a hash stands for itself."""
    if len(tokens) == 1 and tokens[0].dtype == np.uint64:
        return tokens[0]
    total = np.full(len(tokens[0]), np.uint64(len(tokens)), np.uint64)
    for step, t in zip(W._STEP, tokens):
        total += t.astype(np.uint64) * step
    return W.mix(total)


def _add(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Rows of equal keys added up, in the order of their names: (keys, values, names)."""
    names = name(keys)
    order = np.argsort(names)
    names = names[order]
    new = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1]))) if len(names) else np.zeros(0, np.int64)
    add = lambda v: np.add.reduceat(v[order], new, dtype=np.uint64) if len(new) else v.astype(np.uint64)
    return [k[order][new] for k in keys], [add(v) for v in values], names[new]


def _order(group: np.ndarray, minor: np.ndarray) -> np.ndarray:
    """Order by small numbers ``group``, then by ``minor``; one sort of single numbers, which is far quicker, if these have four bytes."""
    if minor.itemsize > 4:
        return np.lexsort((minor, group))
    return np.argsort(group.astype(np.uint64) << np.uint64(32) | minor)


def _part(names: np.ndarray, shards: int) -> np.ndarray:
    return (((names >> np.uint64(40)) * np.uint64(shards)) >> np.uint64(24)).astype(np.int64)


def _kinds(kind: int, k: int, number: str) -> list[str]:
    """Column types of a block: an n-gram's words and count; a word's hash and count."""
    return {_GRAMS: [number] * k + ["u4"], _WORDS: ["u8", "u4"]}[kind]


def _owner(keys: list[np.ndarray]) -> np.ndarray:
    """Name of the context, whose shard has the n-gram; a single word's own."""
    return name(keys[:-1] or keys)


def _send(kind: int, columns: list[np.ndarray], owners: np.ndarray, shards: int, types: list[str]) -> Iterator[pa.RecordBatch]:
    """One block of packed columns for each shard that has rows, ordered by the first one."""
    part = _part(owners, shards)
    order = _order(part, columns[0])
    columns = [c[order].astype(t) for c, t in zip(columns, types)]
    edges = np.searchsorted(part[order], np.arange(shards + 1))
    for p in np.flatnonzero(np.diff(edges)):
        data = _pack([c[edges[p] : edges[p + 1]] for c in columns])
        yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([kind], pa.int32()), pa.array([data], pa.binary())], ["part", "kind", "data"])


def _pack(columns: list[np.ndarray]) -> bytes:
    """The number of rows, and the columns compressed: the first one, which is sorted, as steps; of each all first bytes, all second ones."""
    columns = [np.diff(columns[0], prepend=columns[0].dtype.type(0)), *columns[1:]]
    planes = b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns)
    return len(columns[0]).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _unpack(data: pa.Scalar, types: list[str]) -> list[np.ndarray]:
    buffer, sizes = data.as_buffer(), [np.dtype(t).itemsize for t in types]
    n, at, out = int.from_bytes(buffer[:8], "little"), 0, []
    planes = np.frombuffer(pa.decompress(buffer[8:], n * sum(sizes), "zstd"), np.uint8)
    for t, size in zip(types, sizes):
        out.append(np.ascontiguousarray(planes[at : at + n * size].reshape(size, n).T).view(t).reshape(n))
        at += n * size
    return [np.cumsum(out[0], dtype=types[0]), *out[1:]]


def _blocks(batches: Iterator[pa.RecordBatch], k: int, number: str) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """(kind, shard, columns) of all blocks of a shard together."""
    blocks: dict[tuple[int, int], list[list[np.ndarray]]] = {}
    for batch in batches:
        for part, kind, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            blocks.setdefault((kind, part), []).append(_unpack(data, _kinds(kind, k, number)))
    for (kind, part), found in sorted(blocks.items(), key=lambda b: b[0]):
        columns = [np.concatenate(c) for c in zip(*found)]
        found.clear()
        yield kind, part, columns


def _count_words(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Blocks of the words' counts, over runs of about TOKENS_AT_ONCE tokens."""
    held: list[np.ndarray] = []

    def flush():
        if held:
            words, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            yield from _send(_WORDS, [words, counts], words, shards, _kinds(_WORDS, 1, "u4"))

    size = 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            held.append(token_stream(batch.column(0).slice(lo, 256), 1)[0])
            size += len(held[-1])
            if size >= TOKENS_AT_ONCE:
                yield from flush()
                size = 0
    yield from flush()


def _save_words(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    for _, part, (words, counts) in _blocks(batches, 1, "u4"):
        order = np.argsort(words)
        words, counts = words[order], counts[order]
        new = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1])))
        total = np.add.reduceat(counts, new, dtype=np.uint64)
        _save(folder, "words", part, {"hash": words[new], **_counts("total", total)}, {"n": len(new), "total": int(total.sum())})
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32())], ["part"])


def _count(batches: Iterator[pa.RecordBatch], order: int, shards: int, words: Words) -> Iterator[pa.RecordBatch]:
    """Blocks of the n-grams of highest order, counted over runs of about TOKENS_AT_ONCE tokens."""
    held: list[np.ndarray] = []

    def flush():
        if held:
            grams = list(np.concatenate(held, 1))
            held.clear()
            keys, (c,), _ = _add(grams, [np.ones(len(grams[0]), np.uint32)])
            yield from _send(_GRAMS, [*keys, c], _owner(keys), shards, _kinds(_GRAMS, order, words.type))

    size = 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            tokens, offsets = token_stream(batch.column(0).slice(lo, 256), order)
            real = _real(offsets, order)
            numbers = words.numbers(tokens, real)
            at = np.flatnonzero(real)
            held.append(np.stack([numbers[at - order + 1 + k] for k in range(order)]))
            size += len(at)
            if size >= TOKENS_AT_ONCE:
                yield from flush()
                size = 0
    yield from flush()


def _real(offsets: np.ndarray, order: int) -> np.ndarray:
    """Where a stream holds tokens and no begins."""
    real = np.ones(offsets[-1], bool)
    for k in range(order - 1):
        real[offsets[:-1] + k] = False
    return real


def _save(folder: str, kind: str, part: int, arrays: dict[str, np.ndarray], stats: dict) -> None:
    """Write a shard's arrays; a retry replaces them."""
    os.makedirs(folder, exist_ok=True)
    attempt = TaskContext.get().taskAttemptId()
    base = f"{folder}/{kind}-{part:06d}"
    for label, array in arrays.items():
        array.tofile(f"{base}.{label}.{attempt}")
        os.replace(f"{base}.{label}.{attempt}", f"{base}.{label}")
    with open(f"{base}.json.{attempt}", "w") as out:
        json.dump(stats, out)
    os.replace(f"{base}.json.{attempt}", f"{base}.json")


def _counts(label: str, c: np.ndarray) -> dict[str, np.ndarray]:
    """A byte for each count; those of 255 and more stand in arrays of their own."""
    big = np.flatnonzero(c >= 255)
    return {label: np.minimum(c, 255).astype(np.uint8), f"{label}_at": big.astype(np.uint64), f"{label}_big": c[big].astype(np.uint64)}


def _of_counts(c: np.ndarray) -> list[int]:
    return [int((c == k).sum()) for k in (1, 2, 3, 4)]


def _level(batches: Iterator[pa.RecordBatch], k: int, folder: str, shards: int, number: str) -> Iterator[pa.RecordBatch]:
    """Write a shard's n-grams of order ``k`` and their contexts; send on what order ``k - 1`` needs."""
    for _, part, columns in _blocks(batches, k, number):
        stats = lambda c: {"n": len(c), "of": _of_counts(c), "c": int(c.sum())}
        if k == 1:
            _, (c,), names = _add(columns[:1], columns[1:])
            _save(folder, "grams1", part, {"hash": names, **_counts("c", c)}, stats(c))
            continue
        names = name(columns[: k - 1])
        order = np.argsort(names)
        names = names[order]
        group = np.cumsum(np.concatenate(([False], names[1:] != names[:-1])))
        order = order[_order(group, columns[k - 1][order])]  # the names stay as they are
        last = columns[k - 1][order]
        del group
        new = np.flatnonzero(np.concatenate(([True], (names[1:] != names[:-1]) | (last[1:] != last[:-1]))))
        c = np.add.reduceat(columns[k][order], new, dtype=np.uint64)
        keys = [x[order[new]] for x in columns[1:k]]
        names, last = names[new], last[new]
        del columns, order
        begin = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))
        add = lambda v: np.add.reduceat(v, begin, dtype=np.uint64)
        arrays = {"hash": names[begin], "starts": begin[::STRIDE].astype(np.uint64), "word": last}
        shift = begin - np.repeat(begin[::STRIDE], STRIDE)[: len(begin)]
        for label, v in (("t", add(c)), ("f2", add(c == 2)), ("f3", add(c > 2)), ("shift", shift), ("c", c)):
            arrays |= _counts(label, v)
        _save(folder, f"grams{k}", part, arrays, stats(c))
        shorter, values, _ = _add(keys, [np.ones(len(c), np.uint32)])
        yield from _send(_GRAMS, [*shorter, *values], _owner(shorter), shards, _kinds(_GRAMS, k - 1, number))


class Arrays:
    """Sorted arrays of one kind over all shards; shard k holds the k-th range of hashes."""

    def __init__(self, folder: str, kind: str, values: dict[str, str], shards: int):
        self.folder, self.kind, self.values, self.shards = folder, kind, values, shards
        self.open: dict[int, dict[str, np.ndarray] | None] = {}

    def __getstate__(self):
        return {**self.__dict__, "open": {}}

    def stats(self) -> dict[int, dict]:
        found = {}
        for part in range(self.shards):
            path = f"{self.folder}/{self.kind}-{part:06d}.json"
            if os.path.exists(path):
                with open(path) as text:
                    found[part] = json.load(text)
        return found

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Places of sorted hashes in their shards, -1 for one that is not there."""
        out = np.full(len(hashes), -1, np.int64)
        edges = np.searchsorted(_part(hashes, self.shards), np.arange(self.shards + 1))
        for part in np.flatnonzero(np.diff(edges)):
            have = self._map(int(part))
            if have is not None:
                own = hashes[edges[part] : edges[part + 1]]
                at = np.minimum(np.searchsorted(have["hash"], own), len(have["hash"]) - 1)
                out[edges[part] : edges[part + 1]] = np.where(have["hash"][at] == own, at, -1)
        return out

    def _map(self, part: int) -> dict[str, np.ndarray] | None:
        if part not in self.open:
            base = f"{self.folder}/{self.kind}-{part:06d}"
            kinds = {"hash": "u8", **self.values}
            kinds |= {f"{v}_{more}": "u8" for v, t in self.values.items() if t == "u1" for more in ("at", "big")}
            load = lambda path, t: np.memmap(path, t, "r") if os.path.getsize(path) else np.zeros(0, t)
            there = os.path.exists(f"{base}.json")
            self.open[part] = {v: load(f"{base}.{v}", t) for v, t in kinds.items()} if there else None
        return self.open[part]

    def look_up(self, hashes: np.ndarray, parts: np.ndarray) -> list[np.ndarray]:
        """Values of hashes that are in order of their shards ``parts``, and sorted in each; 0 for one that is not there."""
        out = [np.zeros(len(hashes), np.int64) for _ in self.values]
        edges = np.searchsorted(parts, np.arange(self.shards + 1))
        for part in np.flatnonzero(np.diff(edges)):
            have = self._map(int(part))
            if have is None:
                continue
            lo, hi = edges[part], edges[part + 1]
            at = np.minimum(np.searchsorted(have["hash"], hashes[lo:hi]), len(have["hash"]) - 1)
            hit = have["hash"][at] == hashes[lo:hi]
            at = at[hit]
            for o, v in zip(out, self.values):
                o[lo:hi][hit] = self._read(have, v, at)
        return out

    @staticmethod
    def _read(have: dict[str, np.ndarray], label: str, at: np.ndarray) -> np.ndarray:
        """Values at places of a shard."""
        found = have[label][at].astype(np.int64)
        if len(have.get(f"{label}_big", ())):
            full = np.flatnonzero(found == 255)
            found[full] = have[f"{label}_big"][np.searchsorted(have[f"{label}_at"], at[full].astype(np.uint64))]
        return found

    def follow(self, contexts: np.ndarray, sizes: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the words ``last``, of which ``sizes`` stand together for each named context; and for each context a row of its total
        and its followers seen once, twice and more often.  0 for what is not there."""
        order = np.argsort(contexts)
        names, offsets = contexts[order], np.cumsum(sizes) - sizes
        counts, out = np.zeros(len(last), np.int64), np.zeros((4, len(contexts)), np.int64)
        edges = np.searchsorted(_part(names, self.shards), np.arange(self.shards + 1))
        for part in np.flatnonzero(np.diff(edges)):
            have = self._map(int(part))
            if have is None:
                continue
            own = names[edges[part] : edges[part + 1]]
            at = np.minimum(np.searchsorted(have["hash"], own), len(have["hash"]) - 1)
            hit = have["hash"][at] == own
            at, which = at[hit], order[edges[part] : edges[part + 1]][hit]
            read = lambda label, at: self._read(have, label, at)  # noqa: B023, E731
            begin = read("starts", at // STRIDE) + read("shift", at)
            end = np.full(len(at), len(have["word"]))
            inner = np.flatnonzero(at + 1 < len(have["hash"]))
            end[inner] = read("starts", (at[inner] + 1) // STRIDE) + read("shift", at[inner] + 1)
            t, f2, f3 = (read(label, at) for label in ("t", "f2", "f3"))
            out[:, which] = t, end - begin - f2 - f3, f2, f3
            n = sizes[which]
            rows = np.repeat(offsets[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            seen = _find(have["word"], np.repeat(begin, n), np.repeat(end, n), last[rows])
            counts[rows[seen >= 0]] = read("c", seen[seen >= 0])
        return counts, out


def _find(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted value in its range of ``values``, which is sorted there; -1 for one that is not there."""
    out, row = np.full(len(wanted), -1, np.int64), np.arange(len(wanted))
    while len(row):
        some = lo < hi
        row, lo, hi = row[some], lo[some], hi[some]
        middle = (lo + hi) // 2
        found, own = values[middle], wanted[row]
        same, less = found == own, found < own
        out[row[same]] = middle[same]
        lo, hi = np.where(less, middle + 1, lo), np.where(less, hi, np.where(same, lo, middle))
    return out


class Words:
    """The vocabulary: a word's number is its place in the order of the hashes."""

    def __init__(self, arrays: Arrays):
        sizes = np.zeros(arrays.shards, np.int64)
        for part, stats in arrays.stats().items():
            sizes[part] = stats["n"]
        self.arrays, self.offsets = arrays, np.concatenate(([0], np.cumsum(sizes)))
        self.size = int(self.offsets[-1])
        self.unknown, self.begin = self.size, self.size + 1
        self.type = "u4" if self.begin < 1 << 32 else "u8"

    def number(self, words: np.ndarray) -> np.ndarray:
        """Numbers of sorted words."""
        found = self.arrays.places(words)
        return np.where(found >= 0, self.offsets[_part(words, self.arrays.shards)] + found, self.unknown).astype(self.type)

    def numbers(self, tokens: np.ndarray, real: np.ndarray) -> np.ndarray:
        """Numbers of a stream's tokens; begins stand where it is not ``real``."""
        words, place = np.unique(tokens, return_inverse=True)
        return np.where(real, self.number(words)[place], np.array(self.begin, self.type))


@dataclass
class Model:
    order: int
    words: Words  # with their counts
    grams: list[Arrays]  # of order 2 and up: contexts, and their followers with counts or continuation counts
    unigrams: Arrays  # distinct predecessors
    discounts: list[tuple[float, float, float]]  # of order 1 and up
    predecessors: int  # sum of the unigrams' continuation counts
    followers: tuple[int, int, int]  # unigrams of continuation count 1, 2, 3 and more
    tokens: int
    vocabulary: int

    def score(self, tokens: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """Number of tokens, of known ones, log10 by counts plus one and by the model, of each text."""
        pad = self.order - 1
        real = _real(offsets, self.order)
        at = np.flatnonzero(real)
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets) - pad)
        sums = lambda x: np.bincount(doc, x, len(offsets) - 1)
        # Each word and n-gram of the stream is looked up once; the last one stands for the begins.
        words, place = np.unique(tokens, return_inverse=True)
        place = np.where(real, place, len(words))
        own = place[at]
        numbers = np.append(self.words.number(words), np.array(self.words.begin, self.words.type))
        (count,) = self._at(self.words.arrays, words)
        (n1,) = self._at(self.unigrams, name([numbers]))
        base = np.log10((count + 1.0) / (self.tokens + self.vocabulary + 1.0))[own]
        total = max(1, self.predecessors)
        d = np.array((0.0, *self.discounts[0]))
        rest = sum(a * b for a, b in zip(self.discounts[0], self.followers)) / total if self.predecessors else 1.0
        p = (np.maximum(n1 - d[np.minimum(n1, 3)], 0) / total + rest / (self.vocabulary + 1))[own]
        many = np.uint64(len(numbers))
        gram, members = place, [np.arange(len(numbers))]  # the n-gram at each place, the words of each n-gram
        for k in range(2, self.order + 1):
            pairs, gram = np.unique(gram[:-1].astype(np.uint64) * many + place[k - 1 :].astype(np.uint64), return_inverse=True)
            context, last = (x.astype(np.int64) for x in np.divmod(pairs, many))
            first = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1]))) if len(context) else np.zeros(0, np.int64)
            sizes = np.diff(np.append(first, len(context)))
            names = name([numbers[m[context[first]]] for m in members])
            c, (total, f1, f2, f3) = self.grams[k - 2].follow(names, sizes, numbers[last])
            members = [*(m[context] for m in members), last]
            d1, d2, d3 = self.discounts[k - 1]
            d = np.array((0.0, d1, d2, d3))
            some = np.maximum(total, 1)
            rest = np.where(total > 0, (d1 * f1 + d2 * f2 + d3 * f3) / some, 1)
            seen = np.maximum(c - d[np.minimum(c, 3)], 0) / np.repeat(some, sizes)
            here = gram[at - (k - 1)]
            p = seen[here] + np.repeat(rest, sizes)[here] * p
        n = np.diff(offsets) - pad
        return n, sums((count > 0).astype(float)[own]).astype(np.int64), sums(base), sums(np.log10(p))

    @staticmethod
    def _at(arrays: Arrays, hashes: np.ndarray) -> list[np.ndarray]:
        """Values of each hash."""
        found, place = np.unique(hashes, return_inverse=True)
        return [values[place] for values in arrays.look_up(found, _part(found, arrays.shards))]


def _discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Discounts of counts 1, 2, 3 and more from the numbers of n-grams with counts 1 to 4."""
    if not n1 or not n2:
        return (0.5, 0.5, 0.5)
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2 - y)
    return tuple(float(min(max(d, 0.05), k - 0.05)) for k, d in zip((1, 2, 3), found))


def train(texts: DataFrame, order: int = ORDER) -> Model:
    """Count and store a model of the one text column of ``texts``."""
    if order < 2:
        raise ValueError("the order is 2 or more")
    folder = local_path(scratch_path(texts.sparkSession, "kneser-ney"))
    size = texts.agg(F.sum(F.octet_length(F.col(f"`{texts.columns[0]}`").cast("binary")))).first()[0] or 0
    shards = max(SHARDS, -(-size // SHARD_BYTES))

    def arrays(kind: str, values: dict[str, str]) -> Arrays:
        return Arrays(folder, kind, values, shards)

    schema = "part int, kind int, data binary"
    counted = texts.mapInArrow(lean(_count_words, shards=shards), schema).repartitionById(shards, "part")
    counted.mapInArrow(lean(_save_words, folder=folder), "part int").write.format("noop").mode("overwrite").save()
    del counted
    release(texts)
    words = Words(arrays("words", {"total": "u1"}))
    blocks = texts.mapInArrow(lean(_count, order=order, shards=shards, words=words), schema)
    for k in range(order, 0, -1):  # a level's shuffle files and its blocks go before the next but one is made
        dealt = blocks.repartitionById(shards, "part")
        found = table(dealt.mapInArrow(lean(_level, k=k, folder=folder, shards=shards, number=words.type), schema), "blocks")
        if k < order:
            discard(blocks)
        del dealt
        blocks = found
        release(blocks)
    discard(blocks)

    grams = [arrays(f"grams{k}", {"c": "u1"} if k == 1 else {"word": words.type, **FOLLOWERS}) for k in range(1, order + 1)]
    stats = [list(x.stats().values()) for x in grams]
    of = [[sum(s["of"][i] for s in level) for i in range(4)] for level in stats]
    distinct, predecessors = (sum(s[key] for s in stats[0]) for key in ("n", "c"))
    tokens = sum(s["total"] for s in words.arrays.stats().values())
    followers = (of[0][0], of[0][1], distinct - of[0][0] - of[0][1])
    return Model(order, words, grams[1:], grams[0], [_discounts(*n) for n in of], predecessors, followers, tokens, words.size)


def _perplexity(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    own: Model = model.value
    for batch in batches:
        _, offsets = W.text_buffer(batch.column(1))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + (6 << 20), "right")) - 1)
            part = batch.slice(lo, hi - lo)
            found = own.score(*token_stream(part.column(1), own.order))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(x) for x in found)], ["doc_id", "n_tokens", "n_known", "base_score", "score"]
            )
            lo = hi


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity)`` of every row; a null text is an empty one."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = source.mapInArrow(lean(_perplexity, model=sent), "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return out.select(
        F.col("doc_id").alias(id_col), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
