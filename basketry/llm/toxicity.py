"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

The network reads windows of words that overlap by half, and cover every text whole. A word comes in as its hashed word
vector and the sum of the hashed vectors of its character sequences. Both directions' states are pooled by attention into
one logit for each window. A document's score is a logistic function of its windows' logits.

Training takes a bounded sample of labelled documents (``SAMPLE`` of each label, in the order of a hash) to the driver. Only
the document is labelled, so it learns on the windows that say most, chosen anew by the network itself between rounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.words import ALNUM, U, Trimmed, Words, bounded_batches, chunks, mixed

SAMPLE, SAMPLE_CHARS = 800, 30_000  # documents of each label, and the most characters of one
SPAN, STEP, LANE = 32, 16, 4096
CAUTION = 2.0  # what rejecting a harmless document weighs, against missing a toxic one
HIDDEN, WORD_BUCKETS, CHAR_BUCKETS, WORD_SIZE, CHAR_SIZE = 8, 1 << 14, 1 << 16, 6, 6
INNER, HEADS = (3, 5), (4, 6, 8)  # byte sequences anywhere in a word, and at its head
Params = dict[str, np.ndarray]


def held_out(doc_id: Column, fold: int = 0) -> Column:
    """Whether crc32 of the id as text leaves this remainder by 5; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == fold, F.lit(False))


@dataclass
class Inputs:
    """Distinct words of a shard: their bucket, and their character sequences' buckets (``owner``: the word); and windows of places in ``word`` (-1: none) with their rows."""

    word: np.ndarray
    grams: np.ndarray
    owner: np.ndarray
    windows: np.ndarray
    row: np.ndarray


def _grams(w: Words, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte sequences of the words ``first`` with their edges marked, and the words' numbers."""
    sizes = w.ends[first] - w.starts[first]
    length = sizes + 2
    at = np.cumsum(length) - length
    text = np.full(int(length.sum()) + max(HEADS), 1, np.uint8)
    inside = np.repeat(at + 1, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    text[inside] = w.data[np.repeat(w.starts[first], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)]
    owner, left = np.repeat(np.arange(len(first)), length), np.repeat(at + length, length) - np.arange(length.sum())
    buckets, owners = [], []
    for n in (*INNER, *HEADS):
        place = np.flatnonzero(left >= n) if n in INNER else at[length >= n]
        h = np.full(len(place), n, U)
        for i in range(n):
            h = h * U(0x100000001B3) + text[place + i]
        buckets.append((mixed(h) % U(CHAR_BUCKETS)).astype(np.int32))
        owners.append(owner[place])
    return np.concatenate(buckets), np.concatenate(owners)


def inputs(w: Words) -> Inputs:
    """Windows of ``SPAN`` words, a new one every ``STEP``; the last one ends with the text or after it."""
    distinct, first, which = np.unique(w.hashes, return_index=True, return_inverse=True)
    n = np.diff(w.bounds)
    count = np.where(n == 0, 0, 1 + np.maximum(0, -(-(n - SPAN) // STEP)))
    row = np.repeat(np.arange(w.rows), count)
    start = w.bounds[row] + STEP * (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count))
    places = start[:, None] + np.arange(SPAN)
    known = places < w.bounds[row + 1][:, None]
    windows = np.where(known, which[np.minimum(places, max(len(which) - 1, 0))] if len(which) else 0, -1)
    grams, owner = _grams(w, first)
    return Inputs((distinct % U(WORD_BUCKETS)).astype(np.int32), grams, owner, windows, row)


def _vectors(p: Params, x: Inputs) -> np.ndarray:
    chars = np.stack([np.bincount(x.owner, weights=p["char"][x.grams, i], minlength=len(x.word)) for i in range(CHAR_SIZE)], axis=1)
    return np.concatenate([p["word"][x.word], chars.astype(np.float32)], axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(p: Params, vectors: np.ndarray, windows: np.ndarray, keep: bool) -> tuple[np.ndarray, dict]:
    """Logits of windows, and what training needs."""
    batch, h = len(windows), HIDDEN
    mask = (windows >= 0).astype(np.float32)
    states, memory = np.empty((batch, SPAN, 2 * h), np.float32), []
    for d in (0, 1):
        table = np.vstack([vectors @ p["in"][d] + p["bias"][d], np.zeros((1, 3 * h), np.float32)])
        state, steps = np.zeros((batch, h), np.float32), []
        for t in range(SPAN) if d == 0 else range(SPAN - 1, -1, -1):
            gx, gh, m = table[windows[:, t]], state @ p["back"][d], mask[:, t, None]
            zr = _sigmoid(gx[:, : 2 * h] + gh[:, : 2 * h])
            z, r = zr[:, :h], zr[:, h:]
            n = np.tanh(gx[:, 2 * h :] + r * gh[:, 2 * h :])
            new = state + m * (1 - z) * (n - state)
            if keep:
                steps.append((t, state, z, r, n, gh[:, 2 * h :], m))
            state = new
            states[:, t, d * h : (d + 1) * h] = state
        memory.append(steps)
    score = np.where(mask > 0, states @ p["attention"], np.float32(-1e9))
    weight = np.exp(score - score.max(axis=1, keepdims=True))
    weight /= weight.sum(axis=1, keepdims=True)
    pooled = np.einsum("bt,bth->bh", weight, states)
    return pooled @ p["out"] + p["end"][0], {"states": states, "weight": weight, "pooled": pooled, "memory": memory}


def _backward(p: Params, vectors: np.ndarray, windows: np.ndarray, kept: dict, dlogit: np.ndarray) -> tuple[Params, np.ndarray]:
    """Gradients of the dense parameters, and of the word vectors."""
    h, states, weight = HIDDEN, kept["states"], kept["weight"]
    g = {k: np.zeros_like(p[k]) for k in ("in", "back", "bias", "attention", "out", "end")}
    g["out"], g["end"] = kept["pooled"].T @ dlogit, np.array([dlogit.sum()], np.float32)
    dpooled = dlogit[:, None] * p["out"]
    dweight = np.einsum("bth,bh->bt", states, dpooled)
    dscore = weight * (dweight - (weight * dweight).sum(axis=1, keepdims=True))
    g["attention"] = np.einsum("bt,bth->h", dscore, states)
    dstates = weight[:, :, None] * dpooled[:, None] + dscore[:, :, None] * p["attention"]
    dvectors = np.zeros((len(vectors) + 1, vectors.shape[1]), np.float32)
    for d in (0, 1):
        carry = np.zeros((len(windows), h), np.float32)
        for t, state, z, r, n, ghn, m in reversed(kept["memory"][d]):
            dnew = carry + dstates[:, t, d * h : (d + 1) * h]
            dn, dz = dnew * m * (1 - z), -dnew * m * (n - state)
            dan = dn * (1 - n * n)
            dar, daz = dan * ghn * r * (1 - r), dz * z * (1 - z)
            dgx, dgh = np.concatenate([daz, dar, dan], axis=1), np.concatenate([daz, dar, dan * r], axis=1)
            carry = dnew * (1 - m * (1 - z)) + dgh @ p["back"][d].T
            at = windows[:, t]
            g["back"][d] += state.T @ dgh
            g["in"][d] += np.where(m > 0, vectors[at], 0).T @ dgx
            g["bias"][d] += (dgx * m).sum(axis=0)
            np.add.at(dvectors, at, dgx @ p["in"][d].T)
    return g, dvectors[:-1]


def _lift(ones: np.ndarray, zeros: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How much likelier buckets are in label 1, as smoothed log odds of the documents that have them."""
    a, b = max(y.sum(), 1), max((1 - y).sum(), 1)
    return np.clip(np.log((ones + 2) / (a + 4)) - np.log((zeros + 2) / (b + 4)) - np.log((b + 4) / (a + 4)), -1, 4).astype(np.float32)


def _start(x: Inputs, y: np.ndarray, rng: np.random.Generator) -> Params:
    def small(*shape: int) -> np.ndarray:
        return (0.1 * rng.standard_normal(shape)).astype(np.float32)

    h, size = HIDDEN, WORD_SIZE + CHAR_SIZE
    p = {"word": small(WORD_BUCKETS, WORD_SIZE), "char": small(CHAR_BUCKETS, CHAR_SIZE) * 0.2, "in": small(2, size, 3 * h), "back": small(2, h, 3 * h),
         "bias": np.zeros((2, 3 * h), np.float32), "attention": small(2 * h), "out": small(2 * h), "end": np.zeros(1, np.float32)}
    order = np.argsort(x.owner, kind="stable").astype(np.int32)
    at = np.searchsorted(x.owner[order], np.arange(len(x.word) + 1))
    words, chars = np.zeros((2, WORD_BUCKETS)), np.zeros((2, CHAR_BUCKETS))
    bounds = np.searchsorted(x.row, np.arange(len(y) + 1))
    for doc in range(len(y)):  # a document at a time: its distinct buckets count once
        own = np.unique(x.windows[bounds[doc] : bounds[doc + 1]])
        own = own[own >= 0]
        words[int(y[doc]), np.unique(x.word[own])] += 1
        n = at[own + 1] - at[own]
        entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(at[own], n)
        chars[int(y[doc]), np.unique(x.grams[order[entry]])] += 1
    p["word"][:, 0], p["char"][:, 0] = _lift(words[1], words[0], y), 0.3 * _lift(chars[1], chars[0], y)
    return p


def _best(logit: np.ndarray, row: np.ndarray, rows: int, n: int) -> np.ndarray:
    """The n windows of each row with the highest logits."""
    order = np.lexsort((-logit, row))
    ordered = row[order]
    return order[np.arange(len(order)) - np.searchsorted(ordered, np.arange(rows))[ordered] < n]


def _features(logit: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Of each row's windows: the highest logit, the mean of the four highest (of fewer, with nothing for the others), the log of the windows' expected number, and their share."""
    out = np.full((rows, 4), -6.0)
    out[:, 3] = 0
    p = _sigmoid(logit)
    n, total = np.bincount(row, minlength=rows), np.bincount(row, p, rows)
    np.maximum.at(out[:, 0], row, np.clip(logit, -6, 6))
    top = _best(logit, row, rows, 4)
    out[:, 1] = (np.bincount(row[top], np.clip(logit[top], -6, 6) + 6, rows)) / 4 - 6
    out[:, 2] = np.where(n > 0, np.log(total + 1e-2), -5)
    out[:, 3] = total / np.maximum(n, 1)
    return out


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.02) -> np.ndarray:
    """Weights of a logistic regression (the last is the constant) by Newton steps."""
    x = np.c_[x, np.ones(len(x))]
    beta, own = np.zeros(x.shape[1]), ridge * len(x) * np.diag([1.0] * (x.shape[1] - 1) + [1e-6]) / 10
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        beta += np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + own + 1e-9 * np.eye(len(beta)), x.T @ (weight * (y - p)) - own @ beta)
    return beta


def train(texts: list[str], labels: list[int], seed: int = 0, rounds: int = 3, epochs: int = 3, rate: float = 0.01) -> Params | None:
    """The network and the weights of a document's score; None if there are no documents of one of the labels."""
    y = np.array(labels, float)
    if not 0 < y.sum() < len(y):
        return None
    (w,) = chunks(pa.array(texts, pa.large_string()), ALNUM, 1 << 60)
    x, rng = inputs(w), np.random.default_rng(seed)
    if not len(x.row):
        return None
    learns = np.ones(len(y), bool)
    if min(y.sum(), (1 - y).sum()) >= 40:  # enough to keep a quarter for the document's score
        learns[::4] = False
    of_learners = learns[x.row]
    p = _start(Inputs(x.word, x.grams, x.owner, x.windows[of_learners], x.row[of_learners]), y, rng)
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in p.items()}
    lift = p["word"][x.word, 0] + 0.3 * np.bincount(x.owner, weights=p["char"][x.grams, 0], minlength=len(x.word))
    logit, step = np.where(x.windows >= 0, np.append(lift, 0)[x.windows], -9).max(axis=1), 0
    for _ in range(rounds):
        best = _best(logit, x.row, len(y), 3)
        more = rng.choice(len(x.row), min(len(x.row), 1000), replace=False)
        chosen = np.union1d(best, more[y[x.row[more]] == 0])
        chosen = chosen[of_learners[chosen]]
        for _ in range(epochs):
            rng.shuffle(chosen)
            for part in np.array_split(chosen, max(1, len(chosen) // 128)):
                step += 1
                words, local = np.unique(x.windows[part], return_inverse=True)
                known = words[words >= 0]
                local = local.reshape(len(part), SPAN) - (len(words) - len(known))
                own = _own(x, known)
                v = _vectors(p, own)
                out, kept = _forward(p, v, local, True)
                g, dv = _backward(p, v, local, kept, ((_sigmoid(out) - y[x.row[part]]) / len(part)).astype(np.float32))
                _adam(p, moments, g, own, dv, step, rate)
        logit = score_windows(p, _vectors(p, x), x.windows)
    judged = ~learns if not learns.all() else learns
    p["document"] = _logistic(_features(logit, x.row, len(y))[judged], y[judged], np.where(y > 0, 1.0, CAUTION)[judged])
    return p


def _own(x: Inputs, words: np.ndarray) -> Inputs:
    """The inputs of some distinct words only."""
    number = np.full(len(x.word), -1)
    number[words] = np.arange(len(words))
    of = number[x.owner]
    return Inputs(x.word[words], x.grams[of >= 0], of[of >= 0], x.windows[:0], x.row[:0])


def _adam(p: Params, moments: dict, g: Params, own: Inputs, dv: np.ndarray, step: int, rate: float) -> None:
    def move(k: str, at, grad: np.ndarray) -> None:
        m, s = moments[k]
        m[at] = 0.9 * m[at] + 0.1 * grad
        s[at] = 0.99 * s[at] + 0.01 * grad * grad
        p[k][at] -= rate * (m[at] / (1 - 0.9**step)) / (np.sqrt(s[at] / (1 - 0.99**step)) + 1e-6)

    for k, grad in g.items():
        move(k, slice(None), grad)
    for k, bucket, grad in (("word", own.word, dv[:, :WORD_SIZE]), ("char", own.grams, dv[own.owner, WORD_SIZE:])):
        at, which = np.unique(bucket, return_inverse=True)
        total = np.stack([np.bincount(which, grad[:, i], len(at)) for i in range(grad.shape[1])], axis=1).astype(np.float32)
        move(k, at, total)


def score_windows(p: Params, vectors: np.ndarray, windows: np.ndarray) -> np.ndarray:
    return np.concatenate([_forward(p, vectors, windows[i : i + LANE], False)[0] for i in range(0, len(windows), LANE)] or [np.zeros(0, np.float32)])


def score_rows(p: Params | None, w: Words) -> np.ndarray:
    """A score between 0 and 1 for each row."""
    if p is None:
        return np.zeros(w.rows)
    x = inputs(w)
    f = _features(score_windows(p, _vectors(p, x), x.windows) if len(x.row) else np.zeros(0), x.row, w.rows)
    return 1 / (1 + np.exp(-np.clip(np.c_[f, np.ones(len(f))] @ p["document"], -30, 30)))


def sampled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, fold: int = 0) -> DataFrame:
    """``doc_id, text, toxic``: at most ``sample`` labelled texts of each label, the first by a hash of their ids and texts.

    None of them is held out, null or longer than ``SAMPLE_CHARS`` characters (longer texts are scored whole, but none is
    learnt from); repeated rows count once; of several labels of a document the highest counts. The sample is drawn from
    the labelled rows that stand in ``docs``, by ids and hashes; only the chosen texts move.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id"), fold))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    texts = docs.where(f"doc_id IS NOT NULL AND text IS NOT NULL AND char_length(text) <= {SAMPLE_CHARS}").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), F.col("text").cast("string").alias("text"))
    found = texts.select("doc_id", "key").join(known, "doc_id").distinct()
    order = [F.xxhash64("doc_id"), "doc_id", "key"]
    chosen = found.where("toxic = 1").orderBy(*order).limit(sample).union(found.where("toxic = 0").orderBy(*order).limit(sample))
    rows = texts.join(F.broadcast(chosen), ["doc_id", "key"])  # 2 * sample rows at most
    return rows.groupBy("doc_id", "key", "toxic").agg(F.first("text").alias("text")).select("doc_id", "text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, fold: int = 0) -> Params | None:
    """The network trained on ``sampled`` texts, which come to the driver: 2 * ``sample`` of bounded length at most."""
    got = sorted(((r.doc_id, r.text, r.toxic) for r in sampled(docs, labels, sample, fold).collect()), key=lambda r: (r[0], r[1]))
    return train([r[1] for r in got], [r[2] for r in got])


def _scored(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = [score_rows(model.value, w) for w in chunks(batch.column(2), ALNUM)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(scores) if scores else np.zeros(0))], ["doc_id", "held_out", "score"])


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row for each row of ``docs`` (``doc_id``, ``text``); ``labels``: ``doc_id, toxic``.

    Words are ASCII letters (lower-cased), digits and other characters above ASCII. Ids with remainder 0 are held out and
    never train. Texts without words score as texts without a suspicious window; null texts count as empty; without
    documents of both labels to learn from, all scores are 0. Of several labels of a document the highest counts. Null ids
    and repeated rows stay; other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    scored = own.mapInArrow(Trimmed(partial(_scored, model=model)), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _harmless(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text")).cast(pa.string())
        scores = [score_rows(model.value, w) for w in chunks(texts, ALNUM)]
        yield batch.filter(pa.array(np.concatenate(scores) < 0.5 if scores else np.zeros(0, bool)))


def drop_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that are not predicted to be toxic, with all their columns unchanged."""
    bounded_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample))
    return docs.mapInArrow(Trimmed(partial(_harmless, model=model)), docs.schema)
