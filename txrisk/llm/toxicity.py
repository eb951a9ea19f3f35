"""Toxicity: a factorization machine over hashed terms.

A term is a run of letters and digits, A-Z lower-cased, or the first 4 or 6 bytes of a longer
one (so an inflected insult is known by its stem), known by a 64-bit hash. A document is the
set of its terms, and its log-odds are
``b + sum(w_i) + sum over pairs (i < j) of <v_i, v_j> / m`` (m known terms in it), so a pair such
as an insult next to a group's name can weigh more than its parts. The machine is fitted on
at most ``sample`` labelled documents (those with the smallest hash of their id), over the
``terms`` terms that tell the labels apart best: terms are counted by label in Spark, and the
driver gets the best ones and one bit for each of them a document. Scoring is one pass over
whole texts.

Defined cases: a null, empty or unknown-only text has the score of the bias alone; a document
with several labels counts as toxic if one says so; null labels are not learnt from; without
labels of both kinds every score is 0; rows with a null doc_id are scored and never learnt
from; repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm.shared import crc32_mod, ship, stored, table
from txrisk.llm.textvec import LOWER, NOT_TERM, Slice, U, distinct_by_row, hash_spans, mix, slices, sorted_unique, words


HEADS = (4, 6)


@dataclass(frozen=True)
class FMConfig:
    sample: int = 20_000  # labelled documents fitted on, at most
    terms: int = 1024
    min_docs: int = 4
    factors: int = 8
    steps: int = 2000
    rate: float = 0.02
    l2: float = 2e-5
    l2_factors: float = 1e-3
    folds: int = 5
    held_out: int = 0  # documents with crc32(id) mod folds of this are never learnt from


@dataclass
class FM:
    term: np.ndarray  # ascending hashes
    bias: float
    w: np.ndarray
    v: np.ndarray

    def margin(self, row: np.ndarray, feature: np.ndarray, rows: int) -> np.ndarray:
        out = self.bias + np.bincount(row, self.w[feature], rows)
        m = np.maximum(np.bincount(row, minlength=rows), 1)
        for k in range(self.v.shape[1]):
            x = self.v[feature, k]
            s, s2 = np.bincount(row, x, rows), np.bincount(row, x * x, rows)
            out += 0.5 * (s * s - s2) / m
        return out


def terms(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each text's distinct terms and their heads."""
    w = words(s, NOT_TERM, lower=True)
    row, h = [w.row], [w.hash]
    for k in HEADS:
        long = w.end - w.start > k
        row.append(w.row[long])
        h.append(mix(hash_spans(LOWER[s.buf], w.start[long], w.start[long] + k) ^ U(k)))
    return distinct_by_row(np.concatenate(row), np.concatenate(h), s.rows)


def labelled(docs: DataFrame, labels: DataFrame, column: str, sample: int, folds: int, held_out: int) -> DataFrame:
    """(doc_id, text, y) of the bounded training sample. Only its ids are broadcast."""
    y = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(column).cast("int").alias("y"))
    y = y.where(crc32_mod(F.col("doc_id"), folds) != held_out)
    ids = y.orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(sample)
    return docs.join(F.broadcast(ids), "doc_id")


def training_terms(rows: DataFrame) -> DataFrame:
    """(doc_id, y, terms) of the sample, kept: they are read for the counts and for the bits."""

    def take(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for s in slices(b.column("text")):
                row, h = terms(s)
                first = np.searchsorted(row, np.arange(s.rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(h.view(np.int64)))
                yield pa.record_batch([b.column("doc_id").slice(s.lo, s.rows), b.column("y").slice(s.lo, s.rows), lists], names=["doc_id", "y", "terms"])

    return stored(rows.select("doc_id", "y", "text").mapInArrow(take, "doc_id long, y int, terms array<long>"), "terms")


def choose(sample: DataFrame, cfg: FMConfig) -> np.ndarray:
    """The terms with the largest chi-square statistic, ascending by hash."""
    total, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if toxic in (0, total):
        return np.zeros(0, np.uint64)
    p = toxic / total
    counted = sample.select("y", F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n"), F.sum("y").alias("pos")).where(F.col("n") >= cfg.min_docs)
    off = F.col("pos") - F.col("n") * F.lit(p)
    score = off * off / (F.col("n") * F.lit(p) * F.lit(1 - p)) / (F.lit(1.0) - F.col("n") / F.lit(total + 1))
    unsigned = F.col("term").bitwiseXOR(F.lit(-(1 << 63)).cast("long"))
    best = counted.withColumn("score", score).where("score > 0").orderBy(F.desc("score"), unsigned).limit(cfg.terms)
    return sorted_unique(np.array([r.term for r in best.select("term").collect()], np.int64).view(np.uint64))


def known_terms(sample: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels and the 0/1 matrix of the sample: a bit a term and document comes to the driver."""

    def pack(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            bits = []
            for k in range(b.num_rows):
                h = b.column("terms")[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
                bits.append(np.packbits(np.isin(vocabulary, h)).tobytes())
            yield pa.record_batch([b.column("doc_id"), b.column("y"), pa.array(bits, pa.binary())], names=["doc_id", "y", "bits"])

    got = sample.select("doc_id", "y", "terms").mapInArrow(pack, "doc_id long, y int, bits binary").toArrow().sort_by([("doc_id", "ascending"), ("bits", "ascending")])
    flat = np.frombuffer(b"".join(got.column("bits").to_pylist()), np.uint8).reshape(got.num_rows, (vocabulary.size + 7) // 8)
    x = np.unpackbits(flat, axis=1, count=vocabulary.size) if vocabulary.size else np.zeros((got.num_rows, 0), np.uint8)
    return got.column("y").to_numpy().astype(np.float64), x


def fit(y: np.ndarray, x: np.ndarray, vocabulary: np.ndarray, cfg: FMConfig) -> FM | None:
    """Mini-batch Adam on the logistic loss; None without both labels."""
    if y.size == 0 or y.min() == y.max():
        return None
    rng = np.random.default_rng(0)
    d, k = vocabulary.size, cfg.factors
    theta = [np.array([np.log(y.mean() / (1 - y.mean()))]), np.zeros(d), rng.normal(0, 0.01, (d, k))]
    m1, m2 = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    step = 0
    while step < cfg.steps:
        order = rng.permutation(y.size)
        for lo in range(0, y.size, 256):
            i = order[lo : lo + 256]
            a = x[i].astype(np.float64)
            b, w, v = theta
            m = np.maximum(a.sum(axis=1, keepdims=True), 1)
            s = a @ v
            z = b[0] + a @ w + 0.5 * ((s * s) - (a @ (v * v))).sum(axis=1) / m[:, 0]
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[i]) / i.size
            gm = g[:, None] / m
            grads = [np.array([g.sum()]), a.T @ g + cfg.l2 * w, a.T @ (gm * s) - v * (a.T @ gm) + cfg.l2_factors * v]
            step += 1
            for t, gr, u1, u2 in zip(theta, grads, m1, m2, strict=True):
                u1 += 0.1 * (gr - u1)
                u2 += 0.001 * (gr * gr - u2)
                t -= cfg.rate * (u1 / (1 - 0.9**step)) / (np.sqrt(u2 / (1 - 0.999**step)) + 1e-8)
    return FM(vocabulary, float(theta[0][0]), theta[1], theta[2])


def train(docs: DataFrame, labels: DataFrame, cfg: FMConfig) -> FM | None:
    sample = training_terms(labelled(docs, labels, "toxic", cfg.sample, cfg.folds, cfg.held_out))
    vocabulary = choose(sample, cfg)
    return fit(*known_terms(sample, vocabulary), vocabulary, cfg)


def toxicity(docs: DataFrame, labels: DataFrame, cfg: FMConfig | None = None, id_col: str = "doc_id", text_col: str = "text", learn_from: DataFrame | None = None) -> DataFrame:
    """(doc_id, score, predicted) of every row; ``learn_from`` (doc_id, text) if not ``docs``."""
    cfg = cfg or FMConfig()
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    model = train(docs if learn_from is None else learn_from.select("doc_id", "text"), labels, cfg)

    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for s in slices(b.column("text")):
                p = np.zeros(s.rows)
                if model is not None:
                    row, h = terms(s)
                    p = np.full(s.rows, model.bias)
                    if model.term.size:
                        at = np.minimum(np.searchsorted(model.term, h), model.term.size - 1)
                        ok = model.term[at] == h
                        p = model.margin(row[ok], at[ok], s.rows)
                    p = 1 / (1 + np.exp(-np.clip(p, -500, 500)))
                yield pa.record_batch([b.column("doc_id").slice(s.lo, s.rows), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.mapInArrow(score, "doc_id long, score double, predicted int")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = FMConfig()
    out = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), cfg)
    return out.select("doc_id", F.coalesce(crc32_mod(F.col("doc_id"), cfg.folds) == cfg.held_out, F.lit(False)).alias("held_out"), "score", "predicted")
