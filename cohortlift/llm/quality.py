"""Document quality from good and bad lines, by a linear-chain conditional random field.

A line is described by shares of its letters, marks, blanks and words, how its words repeat and whether the document holds
the line again; the numbers fall into bins cut at quantiles of all and of the distinct values.  A line's evidence adds the weights of its own bins and of those
of the line before and behind it.  Document labels become line labels in two steps: a first fit, by a line's own bins alone, takes
every line of a bad document for bad, then its lines that look good are called good (the worst one stays bad) and the whole
field is fitted.  Forward-backward marginals come from prefix products of the transition matrices, all lines of a batch at
once: a document's first line has a matrix of equal rows, which forgets what stands before.  A logistic function of the mean
marginal, weighted by the lengths of the lines, is the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlift.llm import words as W
from cohortlift.llm.fitting import fit_in_task
from cohortlift.llm.scratch import lean

MAX_ROWS, MAX_LINES, BINS, STEPS, RIDGE = 4000, 64, 13, 150, 1e-3
LINE_SCHEMA = "doc_id long, score double, lines array<struct<begin:long,end:long,good:double>>"
_SLICE = 4 << 20


def _class(of: str = "", also: tuple[tuple[int, int], ...] = ()) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(of.encode())] = True
    for low, high in also:
        table[low : high + 1] = True
    return table


UPPER = _class(also=((65, 90),))
LETTER = _class(also=((65, 90), (97, 122), (0xC0, 0xFF)))  # a character beyond ASCII counts by its first byte
DIGIT = _class(also=((48, 57),))
STOP = _class(".,;:!?'\"()-")
TAIL = _class(also=((0x80, 0xBF),))
SYMBOL = ~(LETTER | DIGIT | STOP | TAIL | W.SPACES)
FEATURES = (
    "log_points", "letters", "upper", "digits", "stops", "symbols", "blanks", "doubled_marks", "word_length", "adjacent_repeats",
    "distinct_words", "marked_words", "lone_marks", "ends_with_stop", "seen_in_document",
)


def _describe(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of lines at ``at`` (lines + 1): features, code points, words and a hash of each."""
    begins, sizes = at[:-1], np.diff(at)

    def count_of(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask, begins, dtype=np.int64)

    points = sizes - count_of(TAIL[raw])
    mark = STOP[raw] | SYMBOL[raw]
    doubled = np.zeros(len(raw), bool)
    doubled[1:] = mark[1:] & (raw[1:] == raw[:-1])
    doubled[begins] = False
    hashes, place, _ = W.find_words(raw, at)
    count = np.diff(place)
    owner = np.repeat(np.arange(len(sizes)), count)
    per = np.maximum(count, 1)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    order = np.lexsort((hashes, owner))
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    blank = W.SPACES[raw]
    last = np.zeros(len(raw), bool)  # last byte of a word
    last[:-1] = ~blank[:-1] & blank[1:]
    last[at[1:] - 1] = ~blank[at[1:] - 1]
    first = np.zeros(len(raw), bool)
    first[1:] = ~blank[1:] & blank[:-1]
    first[begins] = ~blank[begins]
    blanks, letters = count_of(blank), count_of(LETTER[raw])
    shown = points - blanks
    visible = np.maximum(shown, 1)
    stop_at = np.maximum.accumulate(np.where(blank, -1, np.arange(len(raw))))
    final = stop_at[at[1:] - 1]
    sums = np.zeros(len(hashes) + 1, W.U64)
    np.cumsum(hashes, out=sums[1:])
    x = np.stack([
        np.log1p(points), letters / visible, count_of(UPPER[raw]) / np.maximum(letters, 1), count_of(DIGIT[raw]) / visible,
        count_of(STOP[raw]) / visible, count_of(SYMBOL[raw]) / visible, blanks / np.maximum(points, 1), count_of(doubled) / visible, shown / per,
        np.bincount(owner[same], minlength=len(sizes)) / per, np.bincount(owner[order][fresh], minlength=len(sizes)) / per,
        count_of(last & SYMBOL[raw]) / per, count_of(first & last & mark) / per, (final >= begins) & STOP[raw[final]], np.zeros(len(sizes)),
    ], 1)
    return x.astype(np.float32), points, count, W.mix(sums[place[1:]] - sums[place[:-1]] + count.astype(W.U64))


def lines(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts' lines that hold a word: features, code points, offsets of each text's lines, and byte ranges."""
    edge = np.unique(np.concatenate((offsets, np.flatnonzero(raw == 10) + 1)))
    if not len(raw):
        return np.zeros((0, len(FEATURES)), np.float32), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64), np.zeros((0, 2), np.int64)
    parts, lo = [], 0
    while lo < len(edge) - 1:  # whole lines of about a slice at a time
        hi = min(len(edge) - 1, max(lo + 1, int(np.searchsorted(edge, edge[lo] + _SLICE, "right")) - 1))
        parts.append(_describe(raw[edge[lo] : edge[hi]], edge[lo : hi + 1] - edge[lo]))
        lo = hi
    x, points, count, hashes = (np.concatenate(p) for p in zip(*parts))
    held = count > 0
    x, points, hashes = x[held], points[held], hashes[held]
    ranges = np.stack((edge[:-1][held], edge[1:][held]), 1)
    owner = np.searchsorted(offsets, ranges[:, 0], "right") - 1
    order = np.lexsort((hashes, owner))
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    again[:-1] |= again[1:]
    x[order, -1] = again
    return x, points, np.searchsorted(owner, np.arange(len(offsets))), ranges


def _scan(m: np.ndarray, longest: int, backward: bool) -> np.ndarray:
    """Products of up to ``longest`` matrices (4 x lines) that end, or begin, at each line; each up to a factor."""
    m, step = m.copy(), 1
    while step < longest:
        a, b = m[:, :-step], m[:, step:]
        product = np.stack((a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3], a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3]))
        product /= np.maximum(product.max(0), 1e-300)
        if backward:
            m[:, :-step] = product
        else:
            m[:, step:] = product
        step *= 2
    return m


def forward_backward(e: np.ndarray, at: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of every line, and the probabilities (4 x lines) of its and the former line's state (0 for first lines).

    ``e`` is the evidence for good; ``t`` holds bad-bad, bad-good, good-bad, good-good and a first line's good (against bad).
    """
    n = len(e)
    if not n:
        return np.zeros(0), np.zeros((4, 0))
    first = np.zeros(n, bool)
    first[at[:-1][np.diff(at) > 0]] = True
    e = np.clip(e, -50, 50)
    good, bad = np.exp(np.minimum(e, 0)), np.exp(np.minimum(-e, 0))
    w = np.exp(np.clip(t, -50, 50))
    m = np.stack((w[0] * bad, w[1] * good, w[2] * bad, w[3] * good))
    m[:, first] = np.stack((bad, w[4] * good, bad, w[4] * good))[:, first]
    m /= m.max(0)
    longest = int(np.diff(at).max())
    ahead = _scan(m, longest, False)[:2]
    ahead = ahead / ahead.sum(0)
    products = _scan(m, longest, True)
    behind = np.ones((2, n))
    behind[:, :-1] = np.stack((products[0, 1:] + products[1, 1:], products[2, 1:] + products[3, 1:]))
    behind /= behind.max(0)
    both = ahead * behind
    pairs = np.zeros((4, n))
    before = ahead[:, :-1]
    pairs[:, 1:] = np.stack([before[k // 2] * m[k, 1:] * behind[k % 2, 1:] for k in range(4)])
    pairs[:, first] = 0
    return both[1] / both.sum(0), pairs / np.maximum(pairs.sum(0), 1e-300)


def _odds(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _line_means(p: np.ndarray, weight: np.ndarray, at: np.ndarray, empty: float) -> np.ndarray:
    """Log odds of each text's mean, weighted by length; of ``empty`` where there is no line."""
    out, full = np.full(len(at) - 1, empty), np.flatnonzero(np.diff(at))
    if len(full):
        w = weight.astype(np.float64)
        out[full] = np.add.reduceat(p * w, at[full]) / np.add.reduceat(w, at[full])
    out = np.clip(out, 1e-3, 1 - 1e-3)
    return np.log(out / (1 - out))


@dataclass
class Model:
    edges: np.ndarray = field(default_factory=lambda: np.zeros((len(FEATURES), BINS - 1), np.float32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(3 * len(FEATURES) * (BINS + 1)))
    bias: float = 0.0
    transitions: np.ndarray = field(default_factory=lambda: np.zeros(5))
    link: tuple[float, float] = (0.0, 0.0)
    empty: float = 0.5

    def codes(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Places in ``weights`` of each line's own bins, the former line's and the next line's (a bin of its own if none)."""
        n, width = x.shape[0], BINS + 1
        own = np.stack([np.searchsorted(self.edges[f], x[:, f]) for f in range(x.shape[1])], 1).astype(np.int32) if n else np.zeros(x.shape, np.int32)
        full = np.diff(at) > 0
        former, later = np.full_like(own, BINS), np.full_like(own, BINS)
        former[1:], later[:-1] = own[:-1], own[1:]
        former[at[:-1][full]], later[at[1:][full] - 1] = BINS, BINS
        base = np.arange(x.shape[1], dtype=np.int32) * width
        return np.concatenate([role * x.shape[1] * width + base + c for role, c in enumerate((own, former, later))], 1)

    def marginals(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        return forward_backward(self.bias + self.weights[self.codes(x, at)].sum(1), at, self.transitions)[0]

    def score(self, p: np.ndarray, points: np.ndarray, at: np.ndarray) -> np.ndarray:
        return _odds(self.link[0] + self.link[1] * _line_means(p, points, at, self.empty))


def _climb(model: Model, codes: np.ndarray, y: np.ndarray, at: np.ndarray, chained: bool) -> None:
    """Raise the likelihood of the line labels by Adam steps on weights, bias and, if ``chained``, transitions."""
    first = np.zeros(len(y), bool)
    first[at[:-1][np.diff(at) > 0]] = True
    state = y.astype(int)
    moves = np.zeros((4, len(y)))
    moves[2 * state[:-1] + state[1:], np.arange(1, len(y))] = 1
    moves[:, first] = 0
    size, flat = len(model.weights), codes.reshape(-1)
    theta = np.concatenate((model.weights, [model.bias], model.transitions))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        p, pairs = forward_backward(theta[size] + theta[codes].sum(1), at, theta[size + 1 :])
        error = y - p
        grad = np.concatenate((
            np.bincount(flat, np.repeat(error, codes.shape[1]), size), [error.sum()], (moves - pairs).sum(1), [error[first].sum()],
        )) / len(y) - RIDGE * theta
        if not chained:
            grad[size + 1 :] = 0
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    model.weights, model.bias, model.transitions = theta[:size], float(theta[size]), theta[size + 1 :]


def fit(documents: list[bytes], good: list[int]) -> Model:
    """Fit on documents' lines (``pack``); with labels of one kind, or none, the score is constant."""
    share = sum(good) / len(good) if good else 0.5
    model = Model(empty=min(max(share, 1e-3), 1 - 1e-3))
    parts = [np.frombuffer(d, np.float32).reshape(-1, len(FEATURES) + 1) for d in documents]
    if not good or len(set(good)) < 2 or not sum(map(len, parts)):
        model.link = (float(np.log(model.empty / (1 - model.empty))), 0.0)
        return model
    label = np.asarray(good, bool)
    at = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    table = np.concatenate(parts)
    x, points = table[:, :-1], table[:, -1]
    half = np.arange(1, (BINS + 1) // 2) / ((BINS + 1) // 2)  # many lines share a value, such as 0: cut the distinct ones as well
    cuts = [np.concatenate((np.quantile(c, half), np.quantile(np.unique(c), half))) for c in x.T]
    model.edges = np.sort(np.stack(cuts), 1).astype(np.float32)
    codes, owner = model.codes(x, at), np.repeat(np.arange(len(label)), np.diff(at))
    y = label[owner].astype(float)
    own = codes[:, : x.shape[1]]
    _climb(model, own, y, at, False)
    p = _odds(model.bias + model.weights[own].sum(1))
    worst = np.zeros(len(y), bool)
    full = np.flatnonzero(np.diff(at))
    worst[np.lexsort((p, owner))[at[full]]] = True
    y = (label[owner] | ((p >= 0.5) & ~worst)).astype(float)
    _climb(model, codes, y, at, True)
    z = np.stack((np.ones(len(label)), _line_means(model.marginals(x, at), points, at, model.empty)), 1)
    b = np.array([0.0, 1.0])
    for _ in range(30):  # Newton steps of a ridge logistic regression
        q = _odds(z @ b)
        b += np.linalg.solve((z * (q * (1 - q))[:, None]).T @ z + 0.1 * np.eye(2), z.T @ (label - q) - 0.1 * b)
    model.link = tuple(map(float, b))
    return model


def _slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + _SLICE, "right")) - 1))
        yield lo, hi
        lo = hi


def _pack(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Each row's features and code points of up to ``most`` lines in a row, the first of which a hash of the id chooses."""
    for batch in batches:
        raw, offsets = W.text_buffer(batch.column(0))
        start, made = batch.column(2).to_numpy(zero_copy_only=False), []
        for lo, hi in _slices(offsets):
            x, points, at, _ = lines(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            table = np.concatenate((x, points[:, None].astype(np.float32)), 1)
            for i in range(hi - lo):
                n = at[i + 1] - at[i]
                begin = at[i] + (int(start[lo + i]) % (n - most + 1) if n > most else 0)
                made.append(table[begin : min(begin + most, at[i + 1])].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary()), batch.column(1)], ["x", "y"])


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, train: Column | None, max_rows: int, max_lines: int
) -> Model:
    """Fit on the first ``max_rows`` documents of each label, by hash of the id, of those that have a text and a label."""
    y = F.col(label_col).cast("int")
    known = labels.select(F.col(id_col).cast("long").alias("i"), y.alias("y")).where("i IS NOT NULL AND y IN (0, 1)")
    if train is not None:
        known = known.where(train)
    known = known.groupBy("i").agg(F.min("y").alias("y"), F.max("y").alias("_other")).where("y = _other").drop("_other")
    texts = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).where("t IS NOT NULL")
    there = known.join(texts.select("i").distinct(), "i")
    samples = []
    for value in (0, 1):
        some = there.where(F.col("y") == value).orderBy(F.xxhash64("i"), "i").limit(max_rows)
        own = texts.join(F.broadcast(some), "i").orderBy(F.xxhash64("i", "t")).limit(max_rows)
        start = F.pmod(F.xxhash64(F.lit("start"), "i"), F.lit(1 << 30))
        samples.append(own.select("t", "y", start.alias("s")).mapInArrow(lean(_pack, most=max_lines), "x binary, y int"))
    return fit_in_task(samples, fit)


def _score(batches: Iterator[pa.RecordBatch], model, spans: bool) -> Iterator[pa.RecordBatch]:
    own: Model = model.value
    kind = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("good", pa.float64())])
    for batch in batches:
        raw, offsets = W.text_buffer(batch.column(1))
        scores, found = np.zeros(batch.num_rows), []
        for lo, hi in _slices(offsets):
            part, inner = raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            x, points, at, ranges = lines(part, inner)
            p = own.marginals(x, at)
            scores[lo:hi] = own.score(p, points, at)
            if spans:
                before = np.concatenate(([0], np.cumsum(~TAIL[part])))  # code points before each byte
                for i in range(hi - lo):
                    some = slice(at[i], at[i + 1])
                    places = before[ranges[some]] - before[inner[i]]
                    found.append([{"begin": int(b), "end": int(e), "good": float(q)} for (b, e), q in zip(places, p[some])])
        marked = pa.array(found if spans else [None] * batch.num_rows, pa.list_(kind))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), marked], ["doc_id", "score", "lines"])


def quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    train: Column | None = None,
    spans: bool = True,
    max_rows: int = MAX_ROWS,
    max_lines: int = MAX_LINES,
) -> DataFrame:
    """``(doc_id, score, lines)``, a row per row of ``docs``: P(good) of the text, and code point ranges and P(good) of its lines.

    The fit is one task over at most ``max_rows`` documents of each label and ``max_lines`` lines in a row of each; ``train`` is
    a condition on the label rows' id ``i``.  Label rows without id, with another label than 0 and 1 or without a text are not
    learned from, nor are ids that carry both labels; a repeated label row counts once, every row of a repeated id may be taken.
    Every line of every text is scored, whatever its length; lines without a word are none.  A text without lines, empty or
    null, scores as the share of good ones among the rows learned from does.  With labels of one kind, or none, the score is
    that share (0.5).  Without ``spans`` the lines are null.  Other columns are not looked at.
    """
    model = learn(docs, labels, id_col, text_col, label_col, train, max_rows, max_lines)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(lean(_score, model=sent, spans=spans), LINE_SCHEMA).withColumnRenamed("doc_id", id_col)
