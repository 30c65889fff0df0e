"""Quality classifier: histogram gradient-boosted trees over statistics of a document's whole text.

Trees are grown by level on binned features with logistic loss and then flattened into arrays, so that a batch of
documents goes down all trees at once with numpy indexing. The fit uses at most ``sample_rows`` labelled documents
(those of smallest hash of doc_id); scoring reads every row.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_text

FEATURES = (
    "log_chars", "log_words", "word_length", "upper", "lower", "digit", "space", "not_ascii", "exclaim", "bar", "symbol",
    "stop", "comma", "other_punct", "control", "entropy", "distinct_words", "repeated_next", "log_lines", "distinct_lines",
    "line_length", "longest_word", "capital_words", "upper_words",
)
#: The bound on the labelled rows that a fit collects.
SAMPLE_ROWS = 20_000
FOLDS = 5

_CLASS = np.full(256, 13, dtype=np.int64)
_CLASS[0x41:0x5B], _CLASS[0x61:0x7B], _CLASS[0x30:0x3A] = 0, 1, 2
_CLASS[[0x20, 0x09, 0x0A, 0x0D]], _CLASS[0x80:], _CLASS[ord("!")], _CLASS[ord("|")] = 3, 4, 5, 6
_CLASS[[ord(c) for c in "#$%&*@^~<>{}[]\\=+_`"]], _CLASS[[ord("."), ord("?")]], _CLASS[[ord(","), ord(";"), ord(":")]] = 7, 8, 9
_CLASS[[ord(c) for c in "'\"()-/"]] = 10
_CLASS[:9] = _CLASS[[11, 12, *range(14, 32), 127]] = 11


def statistics(text: str | None) -> list[float]:
    """The features of one text, all of it; null is as empty. Every value is finite."""
    raw = (text or "").encode("utf-8", "replace")
    n = max(len(raw), 1)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = np.bincount(_CLASS, weights=counts, minlength=14) / n
    used = counts[counts > 0] / n
    words, lines = raw.split(), raw.split(b"\n")
    w, k = max(len(words), 1), max(len(lines), 1)
    return [
        np.log1p(len(raw)), np.log1p(len(words)), sum(map(len, words)) / w,
        share[0], share[1], share[2], share[3], share[4], share[5], share[6], share[7], share[8], share[9], share[10] + share[13], share[11],
        float(-(used * np.log2(used)).sum()), len(set(words)) / w, sum(map(operator.eq, words, words[1:])) / w,
        np.log1p(k), len(set(lines)) / k, np.log1p(len(raw) / k), np.log1p(max(map(len, words), default=0)),
        sum(map(bytes.istitle, words)) / w, sum(map(bytes.isupper, words)) / w,
    ]


def _matrix(texts) -> np.ndarray:
    return np.array([statistics(t) for t in texts], dtype=np.float64).reshape(-1, len(FEATURES))


@dataclass
class Forest:
    """All trees in shared arrays: node i asks ``x[feature[i]] <= threshold[i]``; a leaf leads to itself."""

    bias: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    children: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x))
        for at in range(0, len(x), 4096):
            part = x[at : at + 4096]
            rows = np.arange(len(part))[:, None]
            node = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            for _ in range(self.depth):
                node = self.children[node, (part[rows, self.feature[node]] > self.threshold[node]).astype(np.int8)]
            out[at : at + 4096] = 1 / (1 + np.exp(-np.clip(self.bias + self.value[node].sum(axis=1), -30, 30)))
        return out


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 2.0, least: float = 5.0) -> Forest:
    """Boosted trees by histograms. ``least``: the smallest sum of second derivatives on either side of a split."""
    nothing = np.zeros(0, dtype=np.int64)
    if not len(y) or y.min() == y.max():
        bias = 0.0 if not len(y) else float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        return Forest(bias, nothing, nothing, nothing.astype(float), nothing.reshape(0, 2), nothing.astype(float), 0)
    f = x.shape[1]
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(f)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(f)], axis=1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(len(y), base)
    cells = binned + np.arange(f) * bins  # one column of histogram cells a feature
    feature, threshold, children, value, roots = [], [], [], [], []

    def node() -> int:
        feature.append(0), threshold.append(np.inf), children.append([len(children)] * 2), value.append(0.0)
        return len(feature) - 1

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        roots.append(node())
        where = np.zeros(len(y), dtype=np.int64)
        level = [roots[-1]]
        for d in range(depth + 1):
            m = len(level)
            live = where >= 0
            g_all, h_all = np.bincount(where[live], grad[live], m), np.bincount(where[live], hess[live], m)
            for i, k in enumerate(level):
                value[k] = rate * g_all[i] / (h_all[i] + l2)
            if d == depth:
                break
            keys = (where[live, None] * (f * bins) + cells[live]).ravel()
            g = np.bincount(keys, np.repeat(grad[live], f), m * f * bins).reshape(m, f, bins).cumsum(axis=2)
            h = np.bincount(keys, np.repeat(hess[live], f), m * f * bins).reshape(m, f, bins).cumsum(axis=2)
            gr, hr = g_all[:, None, None] - g, h_all[:, None, None] - h
            gain = np.where((h >= least) & (hr >= least), g * g / (h + l2) + gr * gr / (hr + l2) - (g_all**2 / (h_all + l2))[:, None, None], -1.0)
            best = gain.reshape(m, -1).argmax(axis=1)
            fresh, move = [], np.full((m, 2), -1)
            cut_f, cut_b = best // bins, best % bins
            for i, k in enumerate(level):
                if gain[i, cut_f[i], cut_b[i]] > 1e-6 and cut_b[i] < len(edges[cut_f[i]]):
                    feature[k], threshold[k], children[k] = int(cut_f[i]), float(edges[cut_f[i]][cut_b[i]]), [node(), node()]
                    move[i] = len(fresh), len(fresh) + 1
                    fresh += children[k]
            side = np.zeros(len(y), dtype=np.int64)
            side[live] = binned[live, cut_f[where[live]]] > cut_b[where[live]]
            for i in np.flatnonzero(move[:, 0] < 0):
                margin[where == i] += value[level[i]]
            where = np.where(live, move[where, side], -1)
            level = fresh
            if not level:
                break
        for i, k in enumerate(level):
            margin[where == i] += value[k]
    return Forest(base, np.array(roots), np.array(feature), np.array(threshold), np.array(children), np.array(value), depth)


def fold(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo FOLDS; null for a null doc_id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def fit_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Forest:
    """Fit on labelled documents outside fold 0, at most ``sample_rows`` of them. A document labelled more than once counts
    with its largest label, and of rows that share a doc_id the one of the least text by its hash (a null text is empty), so
    that the forest depends on the rows alone and not on how they are dealt. Null labels and ids are left out, and so are
    labels without a document. With no labels, or of one class only, every score is that class's smoothed share."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (fold(F.col("doc_id")) != 0))
    there = known.join(docs.select("doc_id"), "doc_id", "left_semi")  # before the sample: labels without a document are no part of it
    chosen = there.groupBy("doc_id").agg(F.max("quality").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    given = F.coalesce("text", F.lit(""))
    texts = docs.select("doc_id", given.alias("text")).join(F.broadcast(chosen), "doc_id")  # at most sample_rows rows of two numbers
    # one row an id before anything is collected; repeats meet in the task that reads them
    once = texts.groupBy("doc_id").agg(F.max("label").alias("label"), F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    got = map_text(once, "text", ["doc_id", "label"], "x array<double>", lambda: lambda t: [_matrix(t).tolist()]).toPandas().sort_values("doc_id")
    return fit_forest(np.array(got["x"].tolist()).reshape(-1, len(FEATURES)), got["label"].to_numpy(dtype=float))


def score_quality(docs: DataFrame, forest: Forest, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of each row (doc_id, if not given; none may be named score) and its ``score`` between 0 and 1. Null texts are scored as empty
    ones; repeated rows score alike; an empty table gives an empty result."""
    columns = columns or ["doc_id"]
    return map_text(docs, "text", columns, "score double", lambda: lambda t: [forest.score(_matrix(t))])
