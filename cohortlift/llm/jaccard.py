"""Set-similarity join of documents by a blocked product of the document by n-gram incidence matrix.

1. Every document becomes its sorted distinct n-gram hashes; equal sets are one row of the matrix from then on.
2. Rows that could reach the threshold are brought into blocks.  Two sets of a similarity of t or more differ in at most
   (1-t)/(1+t) of their joint size, so of one more parts than that (ranges of the hash) at least one part is equal in
   both; the sum of a part's hashes is its key.  Sets whose sizes lie further apart than t allows share no scheme of
   parts.
3. Passages that many texts share make parts meet by chance, and in a larger corpus such meetings tie most texts to one
   cluster.  So a link between rows of equal key stays only if their sketches allow it: a sketch holds the parity of the
   number of hashes in each of its slots, and two sets differ in as many hashes at least as their sketches in slots.
4. A block holds the rows of one candidate cluster, or of two size classes of one, up to a bounded number of n-grams.  Its
   product is accumulated over column blocks, rare columns as index pairs and frequent ones as dense products; after
   each block, rows of which no pair can still reach its size-derived bound leave.  Blocks return a spanning set of links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlift.llm import words as W
from cohortlift.llm.components import components
from cohortlift.llm.scratch import discard, lean, release, table

#: n-grams and rows of a block, keys that a task thins out at once, columns of a dense product, index pairs added at once.
BLOCK_GRAMS, BLOCK_ROWS, KEYS_AT_ONCE, DENSE_COLUMNS, PAIRS_AT_ONCE = 1 << 22, 2048, 1 << 21, 1024, 1 << 18
#: Bytes of text cut into words at once, sorted keys strung at once, rows of a batch that leaves, matrix rows compared at once.
TEXT_AT_ONCE, STRUNG_AT_ONCE, ROWS_OUT, STRIP = 1 << 22, 1 << 19, 1 << 16, 256
#: Rows of a key whose sketches are compared (rows of a larger key are strung), rows of a task that compares, slots of a sketch.
GROUP_ROWS, COMPARED_ROWS, MOST_SLOTS = 1 << 14, 1 << 16, 1 << 15


@lru_cache
def classes(num: int, den: int, most: int = 1 << 40) -> np.ndarray:
    """Upper sizes of the size classes: linked sets lie in the same class or in neighbouring ones."""
    tops = [1]
    while tops[-1] < most:
        tops.append(max(tops[-1] + 1, tops[-1] * den // num))
    return np.array(tops, np.int64)


def _scheme(u: np.ndarray, k: int, top: int, num: int, den: int) -> Iterator[np.ndarray]:
    """Keys of one set under the parts of size class ``k``."""
    differ = 2 * top * (den - num) // (den + num)
    if not differ:
        return  # linked sets of this size are equal
    slack = differ // 16
    parts = differ + 1 + slack
    bounds = np.arange(1, parts, dtype=np.uint64) * np.uint64((1 << 64) // parts)
    at = np.concatenate(([0], np.searchsorted(u, bounds), [len(u)]))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(W.mix(u + np.uint64(k)))))
    full = np.flatnonzero(np.diff(at))
    yield W.mix(sums[at[full + 1]] - sums[at[full]] + np.uint64(k << 32) + full.astype(np.uint64))
    if parts - len(full) > slack:
        # All equal parts may be empty ones, then of both sets: the first n-grams in hash order must meet.
        first = u[: len(u) - -(-num * len(u) // den) + 1]
        yield W.mix(first + np.uint64((k << 32) + 0x5BD1E995))


def candidate_keys(u: np.ndarray, num: int, den: int) -> np.ndarray:
    tops = classes(num, den)
    k = int(np.searchsorted(tops, len(u)))
    return np.concatenate([np.zeros(0, np.uint64), *(x for j in (k, k + 1) for x in _scheme(u, j, int(tops[j]), num, den))])


def sketch(u: np.ndarray) -> bytes:
    """The parity of the number of hashes in each slot; about as many slots as hashes, a power of two."""
    slots = min(MOST_SLOTS, max(64, 1 << (len(u) - 1).bit_length()))
    odd = np.bincount((u & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def _folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of words, all with the slots of the shortest: that of fewer slots is the sum of its parts."""
    width = min(map(len, sketches)) // 8
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(x, np.uint64).reshape(-1, width), axis=0) for x in sketches])


def _sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    raw, at = W.text_buffer(texts)
    lo = 0
    while lo < len(at) - 1:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + TEXT_AT_ONCE, "right")) - 1)
        hashes, words, _ = W.find_words(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
        for d in range(hi - lo):
            yield np.unique(W.grams(hashes[words[d] : words[d + 1]], n))
        lo = hi


def _taken(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The held keys and ids in one piece; ``held`` lets go of them."""
    both = tuple(np.concatenate(x) for x in zip(*held))
    held.clear()
    return both


def _once(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def _star(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(smallest id of each key, the keys, linked ids, the id they link to) of ids under sorted keys, one at least."""
    begin = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    least = np.minimum.reduceat(ids, begin)
    pivot = np.repeat(least, np.diff(np.append(begin, len(ids))))
    far = pivot != ids
    return least, keys[begin], *_once(ids[far], pivot[far])


_INCIDENCE = pa.schema(
    [("kind", pa.int8()), ("doc", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("sketch", pa.binary())]
)


def _incidence(batches: Iterator[pa.RecordBatch], n: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Kind 0: a document's set size and set hash.  Kind 1: (key, document).  Kind 2: a document's set size and sketch.

    Of equal sets only the first one that the task sees gives keys.
    """
    seen: set[bytes] = set()
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def rows(kind, *columns):
        for lo in range(0, len(columns[0]), ROWS_OUT):
            k = len(columns[0][lo : lo + ROWS_OUT])
            parts = [pa.nulls(k, f.type) if x is None else pa.array(x[lo : lo + ROWS_OUT], f.type) for f, x in zip(list(_INCIDENCE)[1:], columns)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(k, kind, np.int8)), *parts], schema=_INCIDENCE)

    def flush():
        if held:
            keys, ids = _taken(held)
            yield from rows(1, ids, None, W.signed(keys), None, None)

    count = 0
    for batch in batches:
        ids = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), np.int64)
        sizes, one, two = (np.zeros(len(ids), np.int64) for _ in range(3))
        sketches: list[bytes] = []
        for d, u in enumerate(_sets(batch.column(1), n)):
            sizes[d] = len(u)
            if not len(u):
                continue
            sketches.append(sketch(u))
            pair = np.array([u.sum(), W.mix(u * np.uint64(3)).sum()], np.uint64)
            one[d], two[d] = W.signed(pair)
            if (name := pair.tobytes()) in seen:
                continue
            seen.add(name)
            keys = candidate_keys(u, num, den)
            if len(keys):
                held.append((keys, np.full(len(keys), ids[d])))
                count += len(keys)
            if count >= KEYS_AT_ONCE:
                yield from flush()
                count = 0
        yield from rows(0, ids, sizes, one, two, None)
        full = sizes > 0
        yield from rows(2, ids[full], sizes[full], None, None, sketches)
    yield from flush()


def _string(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the rows that share a key; the rows of a key are in one task and come together.

    However many rows a task has, it holds few of them: of those strung so far, the smallest id of the last key stays.
    Links are held until the end, each once, and leave before only if they are many.
    """
    held: list[tuple[np.ndarray, np.ndarray]] = []
    links: list[tuple[np.ndarray, np.ndarray]] = []

    def string():
        first, keys, a, b = _star(*_taken(held))
        held.append((keys[-1:].copy(), first[-1:].copy()))
        links.append((a, b))
        links[:] = [_once(*_taken(links))]

    def leave():
        a, b = _taken(links)
        for lo in range(0, len(a), ROWS_OUT):
            yield pa.RecordBatch.from_arrays([pa.array(x[lo : lo + ROWS_OUT]) for x in (a, b)], ["a", "b"])

    count = 0
    for batch in batches:
        for lo in range(0, batch.num_rows, STRUNG_AT_ONCE):
            part = batch.slice(lo, STRUNG_AT_ONCE)
            held.append((W.unsigned(part.column(0).to_numpy()), part.column(1).to_numpy()))
            count += part.num_rows
            if count >= STRUNG_AT_ONCE:
                string()
                count = 0
                if len(links[0][0]) >= STRUNG_AT_ONCE:
                    yield from leave()
    if count:
        string()
    if links:
        yield from leave()


_GROUP = pa.schema([("group", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(group, row, null) of the rows that share a key, a group once however many keys it shares, and (null, a, b) for the
    links of a key of more than GROUP_ROWS rows; the rows of a key are in one task and come together.
    """
    held: list[tuple[np.ndarray, np.ndarray]] = []
    seen = np.zeros(0, np.int64)  # groups that have left
    many = np.zeros(0, np.uint64)  # the key whose first rows have left as links

    def out(*columns):
        for lo in range(0, len(columns[1]), ROWS_OUT):
            k = len(columns[1][lo : lo + ROWS_OUT])
            parts = [pa.nulls(k, pa.int64()) if x is None else pa.array(x[lo : lo + ROWS_OUT]) for x in columns]
            yield pa.RecordBatch.from_arrays(parts, schema=_GROUP)

    def close(last: bool):
        nonlocal seen, many
        keys, ids = _taken(held)
        begin = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        size = np.diff(np.append(begin, len(keys)))
        large = (size > GROUP_ROWS) | np.isin(keys[begin], many)
        if not last:  # more rows of the last key may come
            rest = slice(begin[-1], None)
            if large[-1]:
                many = keys[-1:].copy()
                held.append((many, ids[rest].min(keepdims=True)))
            else:
                held.append((keys[rest].copy(), ids[rest].copy()))
                size[-1] = 0
        for wide in (False, True):
            keep = np.repeat((size > 1) & (large == wide), np.diff(np.append(begin, len(keys))))
            if not keep.any():
                continue
            own, docs = _once(keys[keep], ids[keep])
            if wide:
                strung = pa.RecordBatch.from_arrays([pa.array(W.signed(own)), pa.array(docs)], ["key", "doc"])
                for links in _string(iter([strung])):
                    yield from out(None, links.column(0).to_numpy(), links.column(1).to_numpy())
                continue
            start = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            names = W.signed(W.mix(np.add.reduceat(W.mix(docs.astype(np.uint64)), start)))
            names, first = np.unique(names, return_index=True)
            new = ~np.isin(names, seen) & (np.diff(np.append(start, len(own)))[first] > 1)
            names, first = names[new], first[new]
            seen = np.union1d(seen, names)
            sizes = np.diff(np.append(start, len(own)))[first]
            at = np.repeat(start[first], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            yield from out(np.repeat(names, sizes), docs[at], None)

    count = 0
    for batch in batches:
        for lo in range(0, batch.num_rows, STRUNG_AT_ONCE):
            part = batch.slice(lo, STRUNG_AT_ONCE)
            held.append((W.unsigned(part.column(0).to_numpy()), part.column(1).to_numpy()))
            count += part.num_rows
            if count >= STRUNG_AT_ONCE:
                yield from close(False)
                count = 0
    if held:
        yield from close(True)


def _plausible(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Links that span the rows of a group whose sketches and sizes allow the threshold; a group's rows come together."""
    rows: list[tuple[int, int, bytes]] = []
    found: list[tuple[int, int]] = []
    group = None

    def close():
        if len(rows) < 2:
            return rows.clear()
        ids, sizes = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
        words = _folded([r[2] for r in rows])
        rows.clear()
        left, reached = np.arange(1, len(ids)), [0]
        while len(left):
            if not reached:
                reached.append(left[0])
                left = left[1:]
            at = reached.pop()
            differ = np.bitwise_count(words[left] ^ words[at]).sum(1, dtype=np.int64)
            small, big = np.minimum(sizes[left], sizes[at]), np.maximum(sizes[left], sizes[at])
            near = (differ * (num + den) <= (den - num) * (small + big)) & (num * big <= den * small)
            found.extend((int(x), int(ids[at])) for x in ids[left[near]])
            reached.extend(left[near])
            left = left[~near]

    def leave():
        links = list(dict.fromkeys(x for x in found if x[0] != x[1]))
        found.clear()
        if links:
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"])

    for batch in batches:
        for name, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if name != group:
                close()
                group = name
            rows.append(tuple(row))
        if len(found) >= ROWS_OUT:
            yield from leave()
    close()
    yield from leave()


def _product(sets: list[np.ndarray], num: int, den: int) -> Iterator[np.ndarray]:
    """Links of a block's rows as (row, first row of its component).  ``sets`` lets go of them, as their product takes room."""
    m = len(sets)
    strips = [(lo, min(m, lo + STRIP)) for lo in range(0, m, STRIP)]
    sizes = np.array([len(s) for s in sets], np.int64)
    columns = np.concatenate(sets)
    sets.clear()
    row = np.repeat(np.arange(m, dtype=np.int32), sizes)
    order = np.argsort(columns, kind="stable")
    row = row[order]
    columns = columns[order]
    del order
    begin = np.flatnonzero(np.concatenate(([True], columns[1:] != columns[:-1])))
    count = np.diff(np.append(begin, len(columns)))
    del columns
    left = np.bincount(row[begin[count == 1]], minlength=m)  # columns of one row overlap with nothing
    open_columns = sizes - left
    begin, count = begin[count > 1], count[count > 1]
    need = np.empty((m, m), np.int32)
    for lo, hi in strips:  # overlap * (num + den) >= num * (|x| + |y|)
        need[lo:hi] = -(-num * (sizes[lo:hi, None] + sizes) // (num + den))
    overlap = np.zeros((m, m), np.int32)  # the half above the diagonal counts
    alive = np.ones(m, bool)

    def prune():
        met = np.zeros(m, bool)
        for lo, hi in strips:
            reach = overlap[lo:hi] + np.minimum(open_columns[lo:hi, None], open_columns) >= need[lo:hi]
            reach = np.triu(reach, lo + 1)
            met[lo:hi] |= reach.any(1)
            met |= reach.any(0)
        return alive & met

    alive = prune()
    rare = max(2, int(np.sqrt(m)))
    frequent = np.flatnonzero(count > rare)
    for lo in range(0, len(frequent), DENSE_COLUMNS):
        take = frequent[lo : lo + DENSE_COLUMNS]
        r = np.concatenate([row[begin[c] : begin[c] + count[c]] for c in take])
        c = np.repeat(np.arange(len(take), dtype=np.int32), count[take])
        open_columns -= np.bincount(r, minlength=m)
        live = np.flatnonzero(alive)
        place = np.cumsum(alive, dtype=np.int32) - 1
        keep = alive[r]
        dense = np.zeros((len(live), len(take)), np.float32)
        dense[place[r[keep]], c[keep]] = 1
        del r, c, keep
        for at in range(0, len(live), STRIP):
            overlap[np.ix_(live[at : at + STRIP], live)] += (dense[at : at + STRIP] @ dense.T).astype(np.int32)
        alive = prune()
    flat = overlap.reshape(-1)
    for k in range(2, rare + 1):
        at = begin[count == k]
        i, j = np.triu_indices(k, 1)
        step = max(1, PAIRS_AT_ONCE // len(i))
        for lo in range(0, len(at), step):
            if not alive.any():
                return
            members = row[at[lo : lo + step, None] + np.arange(k)].astype(np.int64)  # ascending in a column
            open_columns -= np.bincount(members.reshape(-1), minlength=m)
            members = members[alive[members].sum(1) > 1]
            np.add.at(flat, (members[:, i] * m + members[:, j]).reshape(-1), 1)
        if len(at):
            alive = prune()
    linked = np.eye(m, dtype=bool)
    for lo, hi in strips:
        above = np.triu((overlap[lo:hi] >= need[lo:hi]) & alive[lo:hi, None] & alive, lo + 1)
        linked[lo:hi] |= above
        linked[:, lo:hi] |= above.T
    label = np.arange(m)
    while True:
        new = np.array([label[x].min() for x in linked])
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = np.flatnonzero(label != np.arange(m))
    yield np.stack((far, label[far]))


def _pairs(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """The product of a block of two rows."""
    if num * max(len(a), len(b)) > den * min(len(a), len(b)):
        return False
    both = np.sort(np.concatenate((a, b)))
    overlap = int((both[1:] == both[:-1]).sum())
    return overlap * (num + den) >= num * (len(a) + len(b))


def _multiply(batches: Iterator[pa.RecordBatch], n: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Links of consecutive blocks; the rows of a block come together.  Texts move, and not their n-grams, which take more room."""
    ids: list[int] = []
    sets: list[np.ndarray] = []
    links: list[tuple[int, int]] = []
    block = None

    def close():
        if len(ids) == 2:
            if _pairs(sets[0], sets[1], num, den):
                links.append((max(ids), min(ids)))
        elif len(ids) > 2:
            for found in _product(sets, num, den):
                links.extend((ids[a], ids[b]) for a, b in found.T)
        ids.clear()
        sets.clear()

    for batch in batches:
        for name, doc, u in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _sets(batch.column(2), n)):
            if name != block:
                close()
                block = name
            ids.append(doc)
            sets.append(u)
        if links:
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"])
            links.clear()
    close()
    if links:
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"])


def _blocks(members: DataFrame, block_grams: int, block_rows: int) -> DataFrame:
    """Deal the rows of each cluster to blocks: the whole cluster, or pairs of buckets of neighbouring size classes."""
    def load(parts: int):
        return F.greatest(F.ceil(parts * F.sum("n") / block_grams), F.ceil(parts * F.count("*") / block_rows)).cast("int")

    # Two buckets, of one class or of two neighbouring ones, fit a block.
    per_class = members.groupBy("cluster", "cls").agg(load(2).alias("nb"))
    whole = members.groupBy("cluster").agg(load(1).alias("all_nb"))
    near = [
        per_class.select("cluster", (F.col("cls") + step).alias("cls"), F.col("nb").alias(name))
        for step, name in ((-1, "nb_up"), (1, "nb_down"))
    ]
    out = members.join(whole, "cluster")
    small = out.where("all_nb = 1").select("doc", F.array(F.xxhash64("cluster")).alias("blocks"))
    large = out.where("all_nb > 1").join(per_class, ["cluster", "cls"])
    for table in near:
        large = large.join(table, ["cluster", "cls"], "left")
    # The blocks that a class of one bucket shares with a neighbouring class pair its own rows as well.
    count = lambda c: F.coalesce(F.col(c), F.lit(0))
    none = F.array().cast("array<int>")
    upto = lambda c: F.when(count(c) > 0, F.sequence(F.lit(0), count(c) - 1)).otherwise(none)
    met = (F.col("nb") == 1) & (F.col("nb_up").isNotNull() | F.col("nb_down").isNotNull())
    large = large.withColumn("i", F.pmod(F.xxhash64("doc"), count("nb")).cast("int"))
    name = lambda c, i, d, j: F.xxhash64(F.col("cluster"), c, i, d, j)
    cls, i = F.col("cls"), F.col("i")
    large = large.select(
        "doc",
        F.concat(
            F.transform(F.when(met, none).otherwise(upto("nb")), lambda j: name(cls, F.least(i, j), cls, F.greatest(i, j))),
            F.transform(upto("nb_up"), lambda j: name(cls, i, cls + 1, j)),
            F.transform(upto("nb_down"), lambda j: name(cls - 1, j, cls, i)),
        ).alias("blocks"),
    )
    return small.union(large)


def jaccard_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 5,
    num: int = 4,
    den: int = 5,
    block_grams: int = BLOCK_GRAMS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per row of ``docs``.

    Words are runs without blanks, A-Z lower-cased.  A set holds the distinct ``n``-word shingles, the whole sequence
    if there are fewer words, and nothing for a null or empty text, which links with nothing.  Two documents link if
    the sets' Jaccard similarity is ``num/den`` or more; ``component_id`` is the smallest id that links reach.  Rows
    with one id are one document; a row without id has no component.  Other columns are not looked at.
    """
    if not 0 < num <= den:
        raise ValueError("the threshold must lie above 0 and not above 1")
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    known = source.where("doc IS NOT NULL")
    made = table(
        known.mapInArrow(lean(_incidence, n=n, num=num, den=den), "kind byte, doc long, n long, h1 long, h2 long, sketch binary"),
        "incidence",
        ["kind"],
    )
    sizes = made.where("kind = 0").select("doc", "n", "h1", "h2")
    keyed = made.where("kind = 1").select(F.col("h1").alias("key"), "doc")
    # A task names a group of rows once however many keys it shares: few large tasks return fewer rows.
    keyed = keyed.repartition(max(8, -(-keyed.count() // KEYS_AT_ONCE // 2)), "key")
    groups = table(keyed.sortWithinPartitions("key").mapInArrow(lean(_group), "group long, a long, b long"), "groups")
    del keyed
    discard(made, "kind=1")
    release(groups)  # the keys' shuffle files
    # Equal sets are represented by their smallest id.
    rep = sizes.where("n > 0").groupBy("n", "h1", "h2").agg(F.min("doc").alias("rep"), F.count("*").alias("copies"))
    to_rep = table(
        sizes.where("n > 0").join(rep.where("copies > 1"), ["n", "h1", "h2"]).select("doc", "rep").distinct(), "copies"
    )

    def represented(rows: DataFrame, *columns: str) -> DataFrame:
        for c in columns:
            rows = (
                rows.distinct()
                .join(to_rep.select(F.col("doc").alias(c), F.col("rep").alias("_r")), c, "left")
                .withColumn(c, F.coalesce("_r", c))
                .drop("_r")
            )
        return rows.distinct()

    grouped = table(represented(groups.where("b IS NULL").select("group", F.col("a").alias("doc")), "doc"), "grouped")
    compared = grouped.join(made.where("kind = 2").select("doc", "n", "sketch"), "doc").select("group", "doc", "n", "sketch")
    compared = compared.repartition(max(8, -(-grouped.count() // COMPARED_ROWS)), "group")
    near = compared.sortWithinPartitions("group", "doc").mapInArrow(lean(_plausible, num=num, den=den), "a long, b long")
    strung = represented(groups.where("b IS NOT NULL").select("a", "b"), "a", "b").where("a != b").select("a", "b")
    strings = table(near.union(strung).distinct(), "strings")
    del compared, near, strung
    release(strings)  # the sketches' shuffle files
    clusters = components(strings, "a", "b")
    roots = clusters.select(F.col("root").alias("node"), "root").distinct()
    tops = classes(num, den)
    member = clusters.union(roots).select(F.col("node").alias("doc"), F.col("root").alias("cluster"))
    member = member.join(sizes.select("doc", "n").groupBy("doc").agg(F.max("n").alias("n")), "doc").withColumn(
        "cls", F.lit(0) + sum(F.when(F.col("n") > int(t), 1).otherwise(0) for t in tops[tops < (1 << 20)])
    )
    member = table(member, "members")
    discard(made, "kind=2")
    for done in (groups, grouped, clusters, strings):
        discard(done)
    dealt = _blocks(member, block_grams, block_rows)
    # A task gets about a block of n-grams, however many there are.
    load = dealt.join(member.select("doc", "n"), "doc").agg(F.sum(F.size("blocks") * F.col("n"))).first()[0] or 0
    blocks = known.join(dealt, "doc").select(F.explode("blocks").alias("block"), "doc", "text")
    blocks = blocks.repartition(max(8, -(-load // block_grams)), "block")
    links = blocks.sortWithinPartitions("block", "doc").mapInArrow(
        lean(_multiply, n=n, num=num, den=den), "a long, b long"
    )
    # Copies hang on their representative.
    final = components(links.union(to_rep.select(F.col("doc").alias("a"), F.col("rep").alias("b"))), "a", "b")
    out = sizes.join(final, sizes["doc"] == final["node"], "left").select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("root", "doc").alias("component_id")
    )
    lost = source.where("doc IS NULL").select(
        F.col("doc").alias(id_col), F.lit(None).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")
    )
    return out.unionByName(lost)
