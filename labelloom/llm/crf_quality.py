"""Document quality from a linear-chain conditional random field over lines.

Each line is good or bad. Its features are shape statistics cut into bins, its own and those of the lines
before and after it; two neighbouring labels share a transition weight. Only documents carry labels, so
lines start with the label of their document, and lines of bad documents that the fitted model finds
clean are relabelled before the model is fitted again. A document's quality is the mean probability of
"good" over its lines by forward-backward, weighted by line length; a one-dimensional logistic fit turns
it into a score.

The model is fitted on at most ``TRAIN_DOCS`` labelled documents of each class with at most
``TRAIN_LINES`` lines, those with the least hash of their id. Scoring reads every whole text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.llm.common import tidied

TRAIN_DOCS = 1200
TRAIN_LINES = 200
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_DIGITS = bytes(range(48, 58))
_PLAIN = b" .,'\"-;:?()"
#: Upper bin edges of each statistic of a line.
_EDGES = [np.array(e) for e in (
    (0.05, 0.15, 0.3, 0.6, 0.9),  # upper-case share of ASCII letters
    (0.01, 0.05, 0.15, 0.4),  # digits
    (0.001, 0.01, 0.03, 0.08, 0.15, 0.3),  # unusual symbols
    (0.01, 0.04, 0.08, 0.15),  # usual punctuation without the space
    (1, 2, 4, 8, 16, 32, 64, 128, 512),  # words
    (2.5, 3.5, 4.5, 5.5, 7, 9, 13),  # bytes a word
    (0.2, 0.4, 0.6, 0.8, 0.9, 0.99),  # distinct words
    (0.02, 0.06, 0.12, 0.25, 0.5),  # share of the most frequent word
    (0.05, 0.15, 0.3, 0.5, 0.8),  # words of at most three bytes
    (12, 16, 22, 30, 60),  # longest word
    (1.5, 2.5, 4.5, 9.5),  # occurrences of the line in its document
    (0.02, 0.1, 0.3, 0.6),  # words without any letter
    (0.5,),  # ends like a sentence
)]
FEATURES = len(_EDGES)
BINS = 1 + max(len(e) for e in _EDGES)


def line_statistics(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(bins as lines x FEATURES, lengths in bytes) of the lines that are not blank."""
    lines = [s for s in (line.strip() for line in data.split(b"\n")) if s]
    if not lines:
        return np.zeros((0, FEATURES), np.uint8), np.zeros(0, np.int64)
    times = Counter(lines)
    rows = []
    for line in lines:
        n = len(line)
        letters = n - len(line.translate(None, _LETTERS))
        upper = n - len(line.translate(None, _UPPER))
        digits = n - len(line.translate(None, _DIGITS))
        plain = n - len(line.translate(None, _PLAIN))
        words = line.split()
        k = len(words)
        counts = Counter(words)
        rows.append((
            upper / max(letters, 1), digits / n, (n - letters - digits - plain) / n, (plain - k + 1) / n, k, n / k,
            len(counts) / k, max(counts.values()) / k if k > 3 else 0.0, sum(len(w) <= 3 for w in words) / k,
            max(map(len, words)), times[line], sum(w.translate(None, _LETTERS) == w for w in words) / k,
            line[-1:] in b".!?",
        ))
    values = np.array(rows, np.float64)
    bins = np.stack([np.searchsorted(e, values[:, j], "right") for j, e in enumerate(_EDGES)], axis=1)
    return bins.astype(np.uint8), np.array([len(line) for line in lines])


@dataclass
class Model:
    #: (line before, line itself, line behind) x FEATURES x BINS; BINS - 1 of a missing neighbour is not used.
    weights: np.ndarray
    #: Weights of a missing line before and behind.
    edges: np.ndarray
    #: [from, to] log weights; label 1 is good.
    transitions: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    empty: float = 0.5

    def score(self, quality: np.ndarray) -> np.ndarray:
        q = np.clip(quality, 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-(self.slope * np.log(q / (1 - q)) + self.shift)))


class Chains:
    """Lines of many documents, laid out so that all documents advance one line at a time."""

    def __init__(self, bins: list[np.ndarray]) -> None:
        sizes = np.array([b.shape[0] for b in bins], np.int64)
        self.order = np.argsort(-sizes, kind="stable")
        self.sizes = sizes[self.order]
        self.longest = int(self.sizes.max(initial=0))
        self.active = np.searchsorted(-self.sizes, -np.arange(self.longest), "left")
        #: Row of each (line, document): lines of equal position stand together.
        self.offset = np.r_[0, np.cumsum(self.active)]
        flat = np.concatenate([bins[i] for i in self.order]) if bins else np.zeros((0, FEATURES), np.uint8)
        doc = np.repeat(np.arange(sizes.size), self.sizes)
        line = np.arange(doc.size) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.row = self.offset[line] + doc if doc.size else np.zeros(0, np.int64)
        self.doc = np.empty_like(doc)
        self.doc[self.row] = doc
        self.bins = np.empty_like(flat)
        self.bins[self.row] = flat
        first, last = line == 0, line + 1 == self.sizes[doc]
        before, behind = np.r_[0, self.row[:-1]] if doc.size else self.row, np.r_[self.row[1:], 0] if doc.size else self.row
        self.before, self.behind = np.empty_like(self.row), np.empty_like(self.row)
        self.before[self.row] = np.where(first, -1, before)
        self.behind[self.row] = np.where(last, -1, behind)

    def unary(self, model: Model) -> np.ndarray:
        """Log weight of "good" against "bad" of each line."""
        f = np.arange(FEATURES)
        own, prev, succ = (model.weights[k][f, self.bins].sum(axis=1) for k in (1, 0, 2))
        has_prev, has_next = self.before >= 0, self.behind >= 0
        # A neighbour's bins are weighted by that neighbour's table.
        return own + np.where(has_prev, prev[self.before], model.edges[0]) + np.where(has_next, succ[self.behind], model.edges[1])

    def log_odds(self, s: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward log odds of "good"; their sum is that of the marginal."""
        e = np.exp(m)
        forward, backward = s.copy(), np.zeros_like(s)
        for t in range(1, self.longest):
            a = self.active[t]
            r = np.clip(forward[self.offset[t - 1] : self.offset[t - 1] + a], -30, 30)
            r = np.exp(r)
            forward[self.offset[t] : self.offset[t] + a] += np.log((r * e[1, 1] + e[0, 1]) / (r * e[1, 0] + e[0, 0]))
        for t in range(self.longest - 2, -1, -1):
            a = self.active[t + 1]
            at = slice(self.offset[t + 1], self.offset[t + 1] + a)
            r = np.exp(np.clip(s[at] + backward[at], -30, 30))
            backward[self.offset[t] : self.offset[t] + a] = np.log((r * e[1, 1] + e[1, 0]) / (r * e[0, 1] + e[0, 0]))
        return forward, backward

    def quality(self, model: Model, lengths: list[np.ndarray]) -> np.ndarray:
        """Length-weighted probability of "good" per document; NaN where there are no lines."""
        forward, backward = self.log_odds(self.unary(model), model.transitions)
        good = 1 / (1 + np.exp(-np.clip(forward + backward, -30, 30)))
        weight = np.empty(good.size)
        if good.size:
            weight[self.row] = np.concatenate([lengths[i] for i in self.order])
        n = len(lengths)
        total, part = np.bincount(self.doc, weight, n), np.bincount(self.doc, weight * good, n)
        out = np.full(n, np.nan)
        out[self.order] = np.divide(part, total, out=np.full(n, np.nan), where=total > 0)
        return out


def fit(bins: list[np.ndarray], lengths: list[np.ndarray], good: np.ndarray, rounds: int = 2, steps: int = 80) -> Model:
    """Fit the field by Adam on the penalised likelihood, then the logistic map of quality to score."""
    chains = Chains(bins)
    model = Model(np.zeros((3, FEATURES, BINS)), np.zeros(2), np.zeros((2, 2)))
    of_line = good[chains.order][chains.doc] if chains.doc.size else np.zeros(0)
    y = of_line.astype(float)
    # Both classes count alike, whatever their number of lines.
    share = np.clip(y.mean() if y.size else 0.5, 0.02, 0.98)
    inner = np.flatnonzero(chains.behind >= 0)
    then = chains.behind[inner]
    f = np.arange(FEATURES)
    for _ in range(rounds if y.size else 0):
        weight = np.where(of_line > 0, 0.5 / share, 0.5 / (1 - share))
        moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (model.weights, model.edges, model.transitions)]
        for step in range(1, steps + 1):
            s = chains.unary(model)
            forward, backward = chains.log_odds(s, model.transitions)
            p = 1 / (1 + np.exp(-np.clip(forward + backward, -30, 30)))
            gap = (p - y) * weight
            g_w = np.zeros_like(model.weights)
            sides = (np.where(chains.behind >= 0, gap[chains.behind], 0.0), gap, np.where(chains.before >= 0, gap[chains.before], 0.0))
            for k, side in enumerate(sides):
                for j in f:
                    g_w[k, j] = np.bincount(chains.bins[:, j], side, BINS)
            g_e = np.array([gap[chains.before < 0].sum(), gap[chains.behind < 0].sum()])
            left = np.stack([np.zeros(inner.size), np.clip(forward[inner], -30, 30)], axis=1)
            right = np.stack([np.zeros(then.size), np.clip(s[then] + backward[then], -30, 30)], axis=1)
            joint = left[:, :, None] + model.transitions[None] + right[:, None, :]
            joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            g_m = (joint * weight[inner, None, None]).sum(axis=0)
            np.subtract.at(g_m, (y[inner].astype(int), y[then].astype(int)), weight[inner])
            n = y.size
            for param, grad, (m1, m2) in zip(
                (model.weights, model.edges, model.transitions), (g_w, g_e, g_m), moments, strict=True
            ):
                grad = grad / n + 1e-3 * param
                m1 += 0.1 * (grad - m1)
                m2 += 0.01 * (grad * grad - m2)
                param -= 0.15 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
        # Clean lines of bad documents become good; the worst line of a bad document stays bad.
        forward, backward = chains.log_odds(chains.unary(model), model.transitions)
        odds = forward + backward
        worst = np.full(len(bins), np.inf)
        np.minimum.at(worst, chains.doc, odds)
        y = np.where((of_line == 0) & (odds > 0) & (odds > worst[chains.doc]), 1.0, of_line)
    quality = chains.quality(model, lengths)
    known = ~np.isnan(quality)
    q = np.clip(quality[known], 1e-6, 1 - 1e-6)
    x, t = np.log(q / (1 - q)), good[known].astype(float)
    rate = np.clip(t.mean() if t.size else 0.5, 0.02, 0.98)
    w = np.where(t > 0, 0.5 / rate, 0.5 / (1 - rate))
    a, b = 1.0, 0.0
    for _ in range(50 if t.size else 0):  # Newton steps of a weighted, lightly penalised logistic fit
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(w * (p - t) * x).sum() + 0.1 * (a - 1), (w * (p - t)).sum() + 0.1 * b])
        v = w * p * (1 - p)
        h = np.array([[(v * x * x).sum() + 0.1, (v * x).sum()], [(v * x).sum(), v.sum() + 0.1]])
        move = np.linalg.solve(h, g)
        a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -1, 1)
    model.slope, model.shift = max(float(a), 1e-3), float(b)
    model.empty = float(np.mean(good)) if good.size else 0.5
    return model


def held_out(key: str) -> Column:
    """True for the fifth of the ids that no model may learn from."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          per_class: int = TRAIN_DOCS, max_lines: int = TRAIN_LINES) -> Model:
    """Fit on labelled rows that are not held out. Rows without a label of 0 or 1 are passed over.

    At most ``per_class`` documents of each class come to the driver, as bins of at most ``max_lines`` lines.
    Without any usable label the model scores every document 0.5.
    """
    usable = labels.where(F.col(label).isin(0, 1) & ~held_out(key)).groupBy(key).agg(F.min(label).cast("int").alias("good"))
    chosen = None
    for value in (0, 1):
        part = usable.where(F.col("good") == value).orderBy(F.xxhash64(key), key).limit(per_class)
        chosen = part if chosen is None else chosen.unionAll(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, good, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if data.count(b"\n") < max_lines:
                    bins, lengths = line_statistics(data)
                    out.append((doc, good, bins.tobytes(), lengths.tolist()))
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            types = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["key", "good", "bins", "lengths"]
            )

    sample = (
        docs.where(F.col(text).isNotNull()).select(key, F.col(text).cast("binary").alias("data")).join(F.broadcast(chosen), key)
        .select(F.col(key).cast("long").alias("key"), "good", "data")
        .mapInArrow(run, "key long, good int, bins binary, lengths array<long>").collect()
    )
    sample.sort(key=lambda r: (r["key"], bytes(r["bins"])))
    return fit(
        [np.frombuffer(bytes(r["bins"]), np.uint8).reshape(-1, FEATURES) for r in sample],
        [np.array(r["lengths"], np.int64) for r in sample], np.array([r["good"] for r in sample], np.int64),
    )


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) for every row of ``docs``; null, empty and blank texts get the share of good training rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [line_statistics(t.as_py() or b"") for t in batch.column(1)]
            quality = Chains([b for b, _ in found]).quality(model, [n for _, n in found])
            out = np.where(np.isnan(quality), model.empty, model.score(np.nan_to_num(quality, nan=0.5)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], names=["key", "score"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").cast("binary").alias("data"))
    return rows.mapInArrow(run, "key long, score double").withColumnRenamed("key", key)


def keep(docs: DataFrame, model: Model, least: float, text: str = "text") -> DataFrame:
    """Rows of ``docs`` with a score of at least ``least``, with all their columns; texts without lines are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [line_statistics((t.as_py() or "").encode()) for t in batch.column(batch.schema.get_field_index(text))]
            quality = Chains([b for b, _ in found]).quality(model, [n for _, n in found])
            good = np.isnan(quality) | (model.score(np.nan_to_num(quality, nan=0.5)) >= least)
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(tidied(run), docs.schema)
