"""Toxic spans by a linear-chain conditional random field.

Words are lower-cased runs of letters and digits.  Document labels mark words first: a word, or a prefix of 3 to 8 bytes,
that a likelihood-ratio test ties to toxic documents is tagged toxic there, every other word is tagged clean.  The field
learns emission weights of word and prefix hashes and the tag transitions from these words.  Forward-backward marginals
of all words give the offending offsets and, through a logistic function of their maximum and sum, the document score.

The fit is one task, over at most ``max_toxic`` + ``max_clean`` labelled rows of at most ``max_chars`` characters
(the first by hash of the id, of those whose text is there); scoring covers every word of every row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cohortlift.llm import words as W
from cohortlift.llm.fitting import fit_in_task
from cohortlift.llm.scratch import lean

PREFIXES = (3, 4, 5, 6, 7, 8)
MAX_TOXIC, MAX_CLEAN, MAX_CHARS = 1000, 2000, 200_000
TRAIN_WORDS, SEGMENT, MARGIN, STEPS, RIDGE = 32, 256, 24, 120, 1e-4
FAINT, FLOOR = 0.1, 1e-3
_BITS = 20
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
SCHEMA = "doc_id long, score double, spans array<struct<begin:long,end:long,marginal:double>>"


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each word and its prefixes (words x 7, 0 where there is none) and the word offsets of the texts."""
    hashes, at, prefixes = W.find_words(raw, offsets, W.NOT_ALNUM, PREFIXES)
    return np.stack([hashes, *prefixes], 1) if len(hashes) else np.zeros((0, 1 + len(PREFIXES)), np.uint64), at


def _odds(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def messages(e: np.ndarray, inside: np.ndarray, t: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log ratios (toxic to clean) of sequences in columns; steps outside a text carry nothing.

    ``t`` holds the transitions clean-toxic, toxic-clean and toxic-toxic; clean-clean is 0.
    """
    forward, backward = np.zeros_like(e), np.zeros_like(e)
    r = None
    for k in range(len(e)):
        step = start + e[k] if r is None else e[k] + np.where(
            inside[k - 1], np.logaddexp(r + t[2], t[0]) - np.logaddexp(r + t[1], 0), start
        )
        forward[k] = r = step
    q = np.zeros(e.shape[1], e.dtype)
    for k in range(len(e) - 2, -1, -1):
        x = e[k + 1] + q
        q = np.where(inside[k + 1], np.logaddexp(x + t[2], t[1]) - np.logaddexp(x + t[0], 0), 0)
        backward[k] = q
    return forward, backward


@dataclass
class Model:
    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    bias: float = -12.0
    transitions: tuple[float, float, float] = (0.0, 0.0, 0.0)
    start: float = 0.0
    link: tuple[float, float, float] = (-12.0, 0.0, 0.0)

    def emissions(self, found: np.ndarray) -> np.ndarray:
        out = np.full(len(found), self.bias, np.float32)
        if len(self.hashes):
            bits = np.zeros(1 << _BITS, bool)
            bits[self.hashes >> np.uint64(64 - _BITS)] = True
            for c in range(found.shape[1]):
                at = np.flatnonzero(bits[found[:, c] >> np.uint64(64 - _BITS)])
                place = np.minimum(np.searchsorted(self.hashes, found[at, c]), len(self.hashes) - 1)
                hit = self.hashes[place] == found[at, c]
                out[at[hit]] += self.weights[place[hit]]
        return out

    def marginals(self, found: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Toxic probability of every word.

        Long texts are cut into segments that see MARGIN more words on either side: what lies further away reaches
        a word through so many transitions that it no longer matters.
        """
        e = self.emissions(found)
        out = np.zeros(len(e), np.float32)
        sizes = np.diff(at)
        pieces = -(-sizes // SEGMENT)
        first = np.repeat(at[:-1], pieces) + SEGMENT * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        low, high = np.repeat(at[:-1], pieces), np.repeat(at[1:], pieces)
        length = np.minimum(high - first, SEGMENT)
        order = np.argsort(length, kind="stable")
        for part in np.array_split(order, max(1, len(order) // 4096)):
            if not len(part):
                continue
            steps = int(length[part].max()) + 2 * MARGIN
            place = first[part] - MARGIN + np.arange(steps)[:, None]
            inside = (place >= low[part]) & (place < high[part])
            x = np.where(inside, e[np.clip(place, 0, len(e) - 1)], np.float32(0))
            forward, backward = messages(x, inside, np.float32(self.transitions), np.float32(self.start))
            own = inside & (place >= first[part]) & (place < first[part] + SEGMENT)
            out[place[own]] = _odds(forward[own] + backward[own])
        return out

    def score(self, p: np.ndarray, at: np.ndarray) -> np.ndarray:
        a, b, c = self.link
        top, total = _document_marginals(p, at)
        return _odds(a + b * top + c * total)


def _document_marginals(p: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of the largest marginal, within the odds of FLOOR, and log(1 + sum of the marginals over FAINT)."""
    top, total = np.full(len(at) - 1, FLOOR), np.zeros(len(at) - 1)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        top[full] = np.clip(np.maximum.reduceat(p, at[full]), FLOOR, 1 - FLOOR)
        total[full] = np.log1p(np.add.reduceat(np.where(p > FAINT, p, 0).astype(np.float64), at[full]))
    return np.log(top / (1 - top)), total


def _tag(found: np.ndarray, at: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words that are, or begin with, what the test ties to toxic texts; those of them that toxic texts hold."""
    doc = np.repeat(np.arange(len(toxic)), np.diff(at))
    tied, n1, n0 = np.zeros(len(found), bool), toxic.sum(), (~toxic).sum()
    share = n1 / (n1 + n0)
    for c in range(found.shape[1]):
        code, inverse = np.unique(found[:, c], return_inverse=True)
        pairs = np.unique(inverse.astype(np.int64) * len(toxic) + doc)
        of, mark = pairs // len(toxic), toxic[pairs % len(toxic)]
        yes = np.bincount(of[mark], minlength=len(code)).astype(float)
        no = np.bincount(of[~mark], minlength=len(code)).astype(float)
        every = yes + no
        log = lambda o, x: np.where(o > 0, o * np.log(np.maximum(o, 1e-9) / np.maximum(x, 1e-9)), 0)
        ratio = 2 * (log(yes, every * share) + log(no, every * (1 - share)))
        least = 2 * np.log(max(2, (yes >= 2).sum())) + 6
        good = (ratio >= least) & (yes >= 3) & (yes / n1 >= 20 * no / max(1, n0)) & (code != 0)
        tied |= good[inverse]
    return tied, tied & toxic[doc]


def fit(texts: list[str], toxic: list | np.ndarray, seed: int = 7) -> Model:
    """Fit the field and the document score; without rows of both labels the score is their constant share."""
    texts, place = np.unique(np.array([t or "" for t in texts], object), return_index=True)
    toxic = np.asarray(toxic, bool)[place]
    if not len(toxic) or toxic.all() or not toxic.any():
        return Model(link=(12.0 if len(toxic) and toxic.all() else -12.0, 0.0, 0.0))
    found, at = features(*W.text_buffer(pa.array(list(texts), pa.string())))
    tied, tags = _tag(found, at, toxic)

    # All windows that hold a tied word, tagged or not, and twice as many others.
    rng = np.random.default_rng(seed)
    doc = np.repeat(np.arange(len(toxic)), np.diff(at))
    window = (np.arange(len(found)) - at[doc]) // TRAIN_WORDS + np.concatenate(([0], np.cumsum(-(-np.diff(at) // TRAIN_WORDS))))[doc]
    marked = np.unique(window[tied])
    rest = np.setdiff1d(np.arange(window[-1] + 1 if len(window) else 0), marked)
    rest = rng.permutation(rest)[: max(500, 2 * len(marked))]
    model = Model()
    if len(marked):
        chosen = np.concatenate((marked, rest))
        begin = np.searchsorted(window, chosen)
        end = np.searchsorted(window, chosen, "right")
        idx = begin + np.arange(TRAIN_WORDS)[:, None]
        inside = idx < end
        idx = np.where(inside, idx, 0)
        flat = np.flatnonzero(inside.reshape(-1))
        used = idx.reshape(-1)[flat]
        codes, x = np.unique(found[used], return_inverse=True)
        x = x.reshape(len(used), -1)
        seen = np.bincount(x.reshape(-1), minlength=len(codes))
        active = (seen >= 3) & (codes != 0)
        y = np.where(inside, tags[idx], False)
        w, g = np.zeros(len(codes)), {}
        extra = np.array([-2.0, 0.0, 0.0, 0.0, 0.0])  # bias, transitions, start
        m, v = np.zeros(len(codes) + 5), np.zeros(len(codes) + 5)
        before, after = y[:-1], y[1:]
        both = inside[1:]
        for step in range(1, STEPS + 1):
            e = np.zeros(idx.size)
            e[flat] = extra[0] + w[x].sum(1)
            e = e.reshape(idx.shape)
            t = extra[1:4]
            forward, backward = messages(e, inside, t, extra[4])
            p = np.where(inside, _odds(forward + backward), 0)
            error = (y - p).reshape(-1)[flat]
            later = e[1:] + backward[1:]
            w01, w10, w11 = later + t[0], forward[:-1] + t[1], forward[:-1] + later + t[2]
            z = np.logaddexp(np.logaddexp(0, w01), np.logaddexp(w10, w11))
            grad = np.concatenate((
                np.bincount(x.reshape(-1), np.repeat(error, x.shape[1]), len(codes)) * active,
                [error.sum()],
                [((o & both).sum() - np.exp(k - z)[both].sum()) for o, k in ((~before & after, w01), (before & ~after, w10), (before & after, w11))],
                [(y[0] - p[0]).sum()],
            )) / len(chosen)
            grad -= RIDGE * np.concatenate((w, extra))
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
            move = 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
            w += move[: len(codes)] * active
            extra += move[len(codes) :]
        keep = active & (np.abs(w) > 0.02)
        model = Model(codes[keep], w[keep].astype(np.float32), float(extra[0]), tuple(map(float, extra[1:4])), float(extra[4]))
    top, total = _document_marginals(model.marginals(found, at), at)
    z = np.stack((np.ones(len(top)), top, total), 1)
    b = np.zeros(3)
    for _ in range(30):  # Newton steps of a ridge logistic regression
        p = _odds(z @ b)
        h = (z * (p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(3)
        b += np.linalg.solve(h, z.T @ (toxic - p) - 0.1 * b)
    model.link = tuple(map(float, b))
    return model


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, train: Column | None,
    max_toxic: int, max_clean: int, max_chars: int,
) -> Model:
    """Fit on the texts of the first rows of each label by hash of the id."""
    known = labels.select(F.col(id_col).cast("long").alias("i"), F.col(label_col).cast("int").alias("y")).where("i IS NOT NULL")
    if train is not None:
        known = known.where(train)
    texts = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).where(
        F.col("t").isNotNull() & (F.length("t") <= max_chars)
    )
    there, samples = known.distinct().join(texts.select("i").distinct(), "i"), []
    for y, most in ((1, max_toxic), (0, max_clean)):
        some = there.where(F.col("y") == y).orderBy(F.xxhash64("i"), "i").limit(most)
        samples.append(texts.join(F.broadcast(some), "i").orderBy(F.xxhash64("i", "t")).limit(most).select("t", "y"))
    return fit_in_task(samples, fit)


def _score(batches: Iterator[pa.RecordBatch], model, spans: bool) -> Iterator[pa.RecordBatch]:
    own: Model = model.value
    span = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())])
    for batch in batches:
        raw, offsets = W.text_buffer(batch.column(1))
        scores, marked = np.zeros(batch.num_rows), [[] for _ in range(batch.num_rows)]
        for lo, hi in _slices(offsets, 4 << 20):
            found, at = features(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            p = own.marginals(found, at)
            scores[lo:hi] = own.score(p, at)
            if not spans:
                continue
            hot = np.flatnonzero(p >= 0.5)
            owner = np.searchsorted(at, hot, "right") - 1
            for d in np.unique(owner):
                text = raw[offsets[lo + d] : offsets[lo + d + 1]].tobytes()
                words = list(_WORD.finditer(text))
                for k in hot[owner == d]:
                    word = words[k - at[d]]
                    begin = len(text[: word.start()].decode())
                    marked[lo + d].append((begin, begin + len(word.group().decode()), float(p[k])))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(scores), pa.array([[dict(zip(("begin", "end", "marginal"), s)) for s in m] for m in marked], pa.list_(span))],
            ["doc_id", "score", "spans"],
        )


def _slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``most`` bytes, one row at least."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def _append(batches: Iterator[pa.RecordBatch], model, column: int, out: str) -> Iterator[pa.RecordBatch]:
    own: Model = model.value
    for batch in batches:
        raw, offsets = W.text_buffer(batch.column(column))
        scores = np.zeros(batch.num_rows)
        for lo, hi in _slices(offsets, 4 << 20):
            found, at = features(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            scores[lo:hi] = own.score(own.marginals(found, at), at)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, out])


def with_toxicity(docs: DataFrame, labels: DataFrame, text_col: str = "text", out: str = "_toxicity", id_col: str = "doc_id") -> DataFrame:
    """``docs``, whole and in place, with each row's score as one more column; learns from all labels as ``toxicity`` does."""
    if out.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"there is a column {out} already")
    model = learn(docs, labels, id_col, text_col, "toxic", None, MAX_TOXIC, MAX_CLEAN, MAX_CHARS)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*docs.schema.fields, StructField(out, DoubleType())])
    return docs.mapInArrow(lean(_append, model=sent, column=docs.columns.index(text_col), out=out), schema)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    train: Column | None = None,
    spans: bool = True,
    max_toxic: int = MAX_TOXIC,
    max_clean: int = MAX_CLEAN,
    max_chars: int = MAX_CHARS,
) -> DataFrame:
    """``(doc_id, score, spans)``, a row per row of ``docs``; spans are character offsets and marginals of toxic words.

    ``train`` is a condition on the label rows' id ``i``.  A null or empty text scores as one without toxic words.
    Label rows without id or label, or whose document is not there, are not learned from; repeated ones count once, and an id
    that carries both labels counts for both.  Repeated rows of ``docs`` score alike, texts of any length are scored whole.
    Other columns are not looked at.
    """
    model = learn(docs, labels, id_col, text_col, label_col, train, max_toxic, max_clean, max_chars)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = source.mapInArrow(lean(_score, model=sent, spans=spans), SCHEMA)
    return out.withColumnRenamed("doc_id", id_col)
