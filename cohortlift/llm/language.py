"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on windows of labelled texts; every byte gets language
probabilities, and those of a text's letters are averaged.  Texts are cut into windows that the network reads on its own,
so all windows of a batch advance together; a window's bytes are labelled from its own context.

The fit is one task, over at most ``max_rows`` labelled rows for each of at most ``max_langs`` languages and
``max_chars`` characters of each; labelling covers every byte of every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlift.llm import words as W
from cohortlift.llm.fitting import fit_in_task
from cohortlift.llm.scratch import lean

HIDDEN, WINDOW, STEPS, BATCH, RATE = 8, 64, 350, 192, 0.02
MAX_ROWS, MAX_LANGS, MAX_CHARS = 600, 64, 4000
_AT_ONCE = 1024
#: Letters: ASCII letters and the bytes of multi-byte characters.
LETTERS = np.zeros(256, bool)
for _low, _high in ((65, 90), (97, 122), (128, 255)):
    LETTERS[_low : _high + 1] = True
_HAS_LETTER = r"\p{L}"


@dataclass
class Direction:
    """A gated recurrent unit: byte inputs ``x`` (256 x 3h), recurrent weights ``u`` (3h x h) and bias of the candidate."""

    x: np.ndarray
    u: np.ndarray
    b: np.ndarray

    def run(self, codes: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """States (steps, h, windows) of ``codes`` (steps, windows).

        Gates are piecewise linear, 1/2 + x/4 within 0 and 1, and the candidate is x within -1 and 1: several times
        faster than the smooth functions, on which labelling would spend most of its time.
        """
        steps, n = codes.shape
        h = self.u.shape[1]
        scale = np.repeat(np.float32((0.25, 1)), (2 * h, h))[:, None]
        x_of = np.ascontiguousarray((self.x.T * scale))
        x_of[: 2 * h] += np.float32(0.5)
        u = self.u * scale
        states, tape = np.empty((steps, h, n), np.float32), []
        state, x, a = np.zeros((h, n), np.float32), np.empty((3 * h, n), np.float32), np.empty((3 * h, n), np.float32)
        for t in range(steps):
            np.take(x_of, codes[t], axis=1, out=x, mode="clip")
            np.matmul(u, state, out=a)
            zr = a[: 2 * h] + x[: 2 * h] if keep else np.add(a[: 2 * h], x[: 2 * h], out=x[: 2 * h])
            np.maximum(zr, 0, out=zr)
            np.minimum(zr, 1, out=zr)
            z, r = zr[:h], zr[h:]
            inner = a[2 * h :] + self.b
            c = r * inner
            c += x[2 * h :]
            np.maximum(c, -1, out=c)
            np.minimum(c, 1, out=c)
            before, state = state, states[t]
            np.subtract(before, c, out=state)
            state *= z
            state += c
            if keep:
                tape.append((before, z, r, inner, c))
        return states, tape

    def back(self, codes: np.ndarray, tape: list, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gradients of the weights, given those of the states."""
        h = self.u.shape[1]
        gx, gu, gb = np.zeros_like(self.x), np.zeros_like(self.u), np.zeros_like(self.b)
        carry = np.zeros_like(grad[0])
        for t in range(len(tape) - 1, -1, -1):
            before, z, r, inner, c = tape[t]
            d = grad[t] + carry
            dc = d * (1 - z) * (np.abs(c) < 1)
            dz = d * (before - c) * np.float32(0.25) * ((z > 0) & (z < 1))
            dr = dc * inner * np.float32(0.25) * ((r > 0) & (r < 1))
            da = np.concatenate((dz, dr, dc * r))
            dx = np.concatenate((dz, dr, dc))
            np.add.at(gx, codes[t], dx.T)
            gu += da @ before.T
            gb += (dc * r).sum(1, keepdims=True)
            carry = d * z + self.u.T @ da
        return gx, gu, gb


@dataclass
class Network:
    langs: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray  # languages x 2h
    bias: np.ndarray  # languages x 1

    def parameters(self) -> list[np.ndarray]:
        return [d for s in (self.forward, self.backward) for d in (s.x, s.u, s.b)] + [self.out, self.bias]

    def label(self, codes: np.ndarray) -> np.ndarray:
        """Probabilities (languages, steps, windows) of every byte of ``codes`` (steps, windows)."""
        f, _ = self.forward.run(codes)
        b, _ = self.backward.run(codes[::-1])
        h = f.shape[1]
        scores = self.out[:, :h] @ f.transpose(1, 0, 2).reshape(h, -1)
        scores += self.out[:, h:] @ b[::-1].transpose(1, 0, 2).reshape(h, -1)
        scores += self.bias
        scores -= scores.max(0)
        np.exp(scores, out=scores)
        scores /= scores.sum(0)
        return scores.reshape(len(scores), *codes.shape)


def fit(texts: list[str], langs: list[str], seed: int = 3, steps: int = STEPS) -> Network | None:
    """Train on windows, as many of each language; None without labelled text."""
    names = sorted(set(langs))
    raw = {k: np.frombuffer(" ".join(t for t, lang in zip(texts, langs) if lang == k).encode(), np.uint8) for k in names}
    names = [k for k in names if len(raw[k]) > 1]
    if not names:
        return None
    rng = np.random.default_rng(seed)
    h, k = HIDDEN, len(names)
    make = lambda: Direction(
        rng.normal(0, 0.3, (256, 3 * h)).astype(np.float32), rng.normal(0, 0.3, (3 * h, h)).astype(np.float32), np.zeros((h, 1), np.float32)
    )
    net = Network(names, make(), make(), rng.normal(0, 0.3, (k, 2 * h)).astype(np.float32), np.zeros((k, 1), np.float32))
    if k == 1:
        return net
    parameters = net.parameters()
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    for step in range(1, steps + 1):
        own = rng.integers(0, k, BATCH)
        codes = np.empty((WINDOW, BATCH), np.int64)
        for i, o in enumerate(own):
            text = raw[names[o]]
            at = rng.integers(0, max(1, len(text) - WINDOW))
            codes[:, i] = np.resize(text[at : at + WINDOW], WINDOW)
        f, f_tape = net.forward.run(codes, keep=True)
        b, b_tape = net.backward.run(codes[::-1], keep=True)
        both = np.concatenate((f, b[::-1]), 1)
        scores = np.einsum("kh,thn->tkn", net.out, both) + net.bias
        scores = np.exp(scores - scores.max(1, keepdims=True))
        scores /= scores.sum(1, keepdims=True)
        scores[:, own, np.arange(BATCH)] -= 1
        scores *= (LETTERS[codes] / (WINDOW * BATCH))[:, None, :].astype(np.float32)
        g_out, g_bias = np.einsum("tkn,thn->kh", scores, both), scores.sum((0, 2))[:, None]
        g = np.einsum("kh,tkn->thn", net.out, scores)
        grads = [*net.forward.back(codes, f_tape, g[:, :h]), *net.backward.back(codes[::-1], b_tape, g[::-1, h:]), g_out, g_bias]
        norm = np.sqrt(sum(float((x * x).sum()) for x in grads))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, x, m, v in zip(parameters, grads, first, second):
            x = x * np.float32(min(1.0, 1.0 / max(norm, 1e-9)))
            m += np.float32(0.1) * (x - m)
            v += np.float32(0.01) * (x * x - v)
            p -= np.float32(rate) * (m / np.float32(1 - 0.9**step)) / (np.sqrt(v / np.float32(1 - 0.99**step)) + np.float32(1e-8))
    return net


def pooled(net: Network, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean probabilities (texts x languages) of the bytes of letters; all bytes of all texts are labelled."""
    texts = len(offsets) - 1
    totals, letters = np.zeros((texts, len(net.langs))), np.zeros(texts)
    windows = -(-np.diff(offsets) // WINDOW)
    owner = np.repeat(np.arange(texts), windows)
    begin = np.repeat(offsets[:-1], windows) + WINDOW * (np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows))
    for lo in range(0, len(owner), _AT_ONCE):
        doc, at = owner[lo : lo + _AT_ONCE], begin[lo : lo + _AT_ONCE]
        place = at + np.arange(WINDOW)[:, None]
        inside = place < offsets[doc + 1]
        codes = np.where(inside, raw[np.minimum(place, len(raw) - 1)], 32).astype(np.intp)
        mine = (LETTERS[codes] & inside).astype(np.float32)
        p = net.label(codes)
        first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        letters[doc[first]] += np.add.reduceat(mine.sum(0), first)
        totals[doc[first]] += np.add.reduceat(np.einsum("ktn,tn->kn", p, mine), first, axis=1).T
    return totals / np.maximum(letters, 1)[:, None]


def _predict(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    net: Network | None = model.value
    for batch in batches:
        raw, offsets = W.text_buffer(batch.column(1))
        has = np.asarray(batch.column(2).fill_null(False).to_numpy(zero_copy_only=False), bool)
        lang, score = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
        if net is not None:
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + (8 << 20), "right")) - 1)
                p = pooled(net, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                best = p.argmax(1)
                for i in np.flatnonzero(has[lo:hi]):
                    lang[lo + i], score[lo + i] = net.langs[best[i]], min(1.0, float(p[i, best[i]]))
                lo = hi
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang), pa.array(score)], ["doc_id", "lang_pred", "score"])


def learn(docs: DataFrame, max_rows: int, max_langs: int, max_chars: int) -> Network | None:
    """Of ``docs`` (id, text, lang): fit on the first rows of each language by hash of id and text."""
    langs = docs.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_langs).collect()
    text, order = F.substring("text", 1, max_chars), F.xxhash64("id", "text")
    samples = []
    for row in langs:
        # A share of the hashes holds about four times the rows wanted, so that tasks pass on few rows however many there are.
        share = min(1 << 30, (max_rows << 32) // row["n"] + 1)
        own = docs.where((F.col("lang") == row["lang"]) & (F.pmod(order, F.lit(1 << 30)) < share))
        samples.append(own.orderBy(order).limit(max_rows).select(text.alias("text"), "lang"))
    return fit_in_task(samples, fit)


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    train: Column | None = None,
    max_rows: int = MAX_ROWS,
    max_langs: int = MAX_LANGS,
    max_chars: int = MAX_CHARS,
) -> DataFrame:
    """``(doc_id, lang_pred, score)``, a row per row of ``docs``; ``train`` is a condition on the id ``id``.

    Learned from are rows with a language and a letter.  A text that is null or has no letter is ``und`` with score 0, and
    so is every text if there is nothing to learn from.  Other columns are not looked at.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    has = F.coalesce(F.col("text").rlike(_HAS_LETTER), F.lit(False)).alias("has")
    known = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(_HAS_LETTER))
    if train is not None:
        known = known.where(train)
    net = learn(known, max_rows, max_langs, max_chars)
    sent = docs.sparkSession.sparkContext.broadcast(net)
    out = rows.select("id", "text", has).mapInArrow(lean(_predict, model=sent), "doc_id long, lang_pred string, score double")
    return out.withColumnRenamed("doc_id", id_col)
