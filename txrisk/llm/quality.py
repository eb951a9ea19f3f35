"""Quality rules: gradient-boosted trees over document statistics.

Every text's statistics come from vectorised passes over the bytes of many texts. The trees
(logistic loss, histogram splits) are fitted on at most ``sample`` labelled documents and
flattened into arrays of feature, threshold, children and value, so a batch is scored by a
few array look-ups a tree. A feature listed in ``FALLING`` can only lower the score as it
grows: a split on it is taken only if its left side keeps the larger value, and the values
below are bounded by the middle of the two.

Defined cases: a null or empty text has all counts 0 and fails the base rule; lines are equal
byte for byte; without labels of both kinds the base rule alone decides; a document with
several labels counts as good if one says so; rows with a null doc_id are scored, never
learnt from; repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm.shared import crc32_mod, ship, table
from txrisk.llm.textvec import ASCII_SPACE, LOWER, Slice, Words, distinct_by_row, hash_spans, shingles, slices, words
from txrisk.llm.toxicity import labelled


@dataclass(frozen=True)
class GBTConfig:
    sample: int = 20_000
    trees: int = 60
    depth: int = 3
    bins: int = 48
    rate: float = 0.2
    l2: float = 1.0
    min_rows: int = 10
    folds: int = 5
    held_out: int = 0


FEATURES = ("log_words", "word_length", "symbols", "dup_lines", "repeats", "upper", "digits", "punctuation", "new_words", "words_a_line", "wide_bytes")
FALLING = ("symbols", "dup_lines", "repeats")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[list(b"!?.,;:-_/\\()[]{}'\"@+=~^`")] = True


def _per_row(s: Slice, flag: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0], np.cumsum(flag)])
    return c[s.off[1:]] - c[s.off[:-1]]


def _dup_lines(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word that equal an earlier one, and all lines with a word, by text."""
    nl = np.flatnonzero(s.buf == 10)
    row = np.concatenate([np.arange(s.rows), np.searchsorted(s.off, nl, "right") - 1])
    start = np.concatenate([s.off[:-1], nl + 1])
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    last = np.append(row[1:] != row[:-1], True) if row.size else np.zeros(0, bool)
    end = np.where(last, s.off[row + 1], np.append(start[1:], 0) - 1)
    c = np.concatenate([[0], np.cumsum(~ASCII_SPACE[s.buf])])
    full = c[end] > c[start]
    row, start, end = row[full], start[full], end[full]
    n = np.bincount(row, minlength=s.rows)
    one, _ = distinct_by_row(row, hash_spans(s.buf, start, end), s.rows)
    return n - np.bincount(one, minlength=s.rows), n


def _repeat_words(s: Slice, w: Words) -> np.ndarray:
    """Words that lie in a 3-word window found twice or more in the text."""
    row, h, first = shingles(w, 3, whole_if_short=False)
    order = np.lexsort((h, row)) if s.rows > 1 else np.argsort(h, kind="stable")
    r, v = row[order], h[order]
    same = (r[1:] == r[:-1]) & (v[1:] == v[:-1])
    again = np.zeros(r.size, bool)
    again[1:] |= same
    again[:-1] |= same
    at = order[again]
    place = at - first[row[at]] + w.first[row[at]]
    inside = np.zeros(w.hash.size, bool)
    for j in range(3):
        inside[place + j] = True
    return np.bincount(w.row[inside], minlength=s.rows)


def statistics(s: Slice) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Base counts by name, and the (rows, FEATURES) matrix."""
    w = words(s)
    n = np.diff(w.first)
    code_point = (s.buf & 0xC0) != 0x80
    chars = _per_row(s, code_point & ~ASCII_SPACE[s.buf])
    symbols = _per_row(s, _SYMBOL[s.buf])
    dup, lines = _dup_lines(s)
    repeat = _repeat_words(s, w)
    lower = Slice(s.lo, s.hi, LOWER[s.buf], s.off, s.null)
    kinds, _ = distinct_by_row(w.row, words(lower).hash, s.rows)
    size, count = np.maximum(chars, 1), np.maximum(n, 1)
    x = np.stack([
        np.log1p(n), chars / count, symbols / count, dup / np.maximum(lines, 1), repeat / count,
        _per_row(s, _UPPER[s.buf]) / size, _per_row(s, _DIGIT[s.buf]) / size, _per_row(s, _PUNCT[s.buf]) / size,
        np.bincount(kinds, minlength=s.rows) / count, n / np.maximum(lines, 1), _per_row(s, s.buf >= 0xC0) / size,
    ], axis=1)
    base = {"n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeat}
    return {k: v.astype(np.int64) for k, v in base.items()}, x


@dataclass
class Forest:
    """Trees as arrays of one shape (trees, nodes); a leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(x.shape[0], self.start)
        rows = np.arange(x.shape[0])
        for t in range(self.feature.shape[0]):
            at = np.zeros(x.shape[0], np.int64)
            for _ in range(self.depth):
                go_left = x[rows, self.feature[t, at]] <= self.threshold[t, at]
                at = np.where(go_left, self.left[t, at], self.right[t, at])
            z += self.value[t, at]
        return 1 / (1 + np.exp(-z))


def fit(x: np.ndarray, y: np.ndarray, cfg: GBTConfig) -> Forest | None:
    if y.size == 0 or y.min() == y.max():
        return None
    d = x.shape[1]
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, cfg.bins + 1)[1:-1], method="lower")) for j in range(d)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(d)], axis=1)
    falling = [FEATURES[j] in FALLING for j in range(d)]
    p = y.mean()
    start = float(np.log(p / (1 - p)))
    nodes = 2 ** (cfg.depth + 1) - 1
    shape = (cfg.trees, nodes)
    feature, threshold, value = np.zeros(shape, np.int64), np.full(shape, np.inf), np.zeros(shape)
    left = np.tile(np.arange(nodes), (cfg.trees, 1))
    right = left.copy()
    z = np.full(y.size, start)
    weight = lambda g, h: -g / (h + cfg.l2)
    gain = lambda g, h: g * g / (h + cfg.l2)
    for t in range(cfg.trees):
        q = 1 / (1 + np.exp(-z))
        grad, hess = q - y, q * (1 - q)
        todo = [(0, np.arange(y.size), -np.inf, np.inf, 0)]
        while todo:
            node, rows, lo, hi, depth = todo.pop()
            g, h = grad[rows].sum(), hess[rows].sum()
            own = float(np.clip(weight(g, h), lo, hi))
            best = (1e-6, -1, -1)
            if depth < cfg.depth and rows.size >= 2 * cfg.min_rows:
                for j in range(d):
                    k = edges[j].size + 1
                    b = binned[rows, j]
                    gl = np.cumsum(np.bincount(b, grad[rows], k))[:-1]
                    hl = np.cumsum(np.bincount(b, hess[rows], k))[:-1]
                    nl = np.cumsum(np.bincount(b, minlength=k))[:-1]
                    got = gain(gl, hl) + gain(g - gl, h - hl) - gain(g, h)
                    ok = (nl >= cfg.min_rows) & (rows.size - nl >= cfg.min_rows)
                    if falling[j]:
                        ok &= weight(gl, hl) >= weight(g - gl, h - hl)
                    got = np.where(ok, got, 0)
                    if got.size and got.max() > best[0]:
                        best = (float(got.max()), j, int(got.argmax()))
            if best[1] < 0:
                value[t, node] = cfg.rate * own
                z[rows] += cfg.rate * own
                continue
            _, j, cut = best
            side = binned[rows, j] <= cut
            feature[t, node], threshold[t, node] = j, edges[j][cut]
            left[t, node], right[t, node] = 2 * node + 1, 2 * node + 2
            l_lo, l_hi, r_lo, r_hi = lo, hi, lo, hi
            if falling[j]:
                a, b2 = rows[side], rows[~side]
                mid = (np.clip(weight(grad[a].sum(), hess[a].sum()), lo, hi) + np.clip(weight(grad[b2].sum(), hess[b2].sum()), lo, hi)) / 2
                l_lo, r_hi = mid, mid
            todo += [(2 * node + 1, rows[side], l_lo, l_hi, depth + 1), (2 * node + 2, rows[~side], r_lo, r_hi, depth + 1)]
    return Forest(feature, threshold, left, right, value, start, cfg.depth)


def train(docs: DataFrame, labels: DataFrame, cfg: GBTConfig) -> Forest | None:
    def take(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for s in slices(b.column("text")):
                _, x = statistics(s)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(s.rows + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
                yield pa.record_batch([b.column("doc_id").slice(s.lo, s.rows), b.column("y").slice(s.lo, s.rows), flat], names=["doc_id", "y", "x"])

    rows = labelled(docs, labels, "quality", cfg.sample, cfg.folds, cfg.held_out)
    got = rows.select("doc_id", "y", "text").mapInArrow(take, "doc_id long, y int, x array<double>").toArrow().sort_by("doc_id")
    x = np.array(got.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    return fit(x, got.column("y").to_numpy().astype(float), cfg)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality(docs: DataFrame, labels: DataFrame, cfg: GBTConfig | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts, base_failed, kept and score of every row of ``docs``."""
    cfg = cfg or GBTConfig()
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    forest = train(docs, labels, cfg)

    def judge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for s in slices(b.column("text")):
                base, x = statistics(s)
                score = forest.score(x) if forest is not None else np.ones(s.rows)
                failed = (base["n_words"] < 50) | (100 * base["n_repeat_words"] > 50 * base["n_words"])
                cols = [b.column("doc_id").slice(s.lo, s.rows), *(pa.array(base[k]) for k in BASE), pa.array(failed), pa.array(~failed & (score >= 0.5)), pa.array(score)]
                yield pa.record_batch(cols, names=["doc_id", *BASE, "base_failed", "kept", "score"])

    schema = "doc_id long, " + ", ".join(f"{k} long" for k in BASE) + ", base_failed boolean, kept boolean, score double"
    return docs.mapInArrow(judge, schema)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
