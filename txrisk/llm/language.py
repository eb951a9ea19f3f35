"""Language identification in two steps: family first, then pairwise linear SVMs inside it.

A text is the histogram of its hashed byte trigrams (A-Z lower-cased, everything but letters
and bytes of non-ASCII characters as a space), square-rooted and scaled to length 1. One
linear SVM a family against the rest chooses the family; inside it one linear SVM for each
pair of languages votes, and the summed margins break ties. They are fitted on at most
``per_language`` documents of each language (those with the smallest hash of their id), fewer
where there are so many languages that ``sample`` documents would be passed; every language
with a document to learn from is learnt, with one at least.

Defined cases: a null text and a text without a letter give ``und`` with score 0; documents
with a null lang or doc_id are not learnt from; a language outside ``FAMILIES`` is a family of
its own; very long texts are counted whole; ties go to the first family or language by name;
without anything to learn from every text gives ``und``; repeated rows are predicted
each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txrisk.llm.shared import crc32_mod, ship, table
from txrisk.llm.textvec import LOWER, Slice, slices

#: Families of common languages by ISO 639-1 code.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk",
    "indo-aryan": "hi bn ur mr pa gu ne si",
    "semitic": "ar he mt am",
    "celtic": "ga cy gd br",
    "hellenic": "el",
    "sinitic": "zh",
    "japonic": "ja",
    "koreanic": "ko",
}
_FAMILY = {code: f for f, codes in FAMILIES.items() for code in codes.split()}

_SPACED = LOWER.copy()
_SPACED[[c for c in range(128) if not chr(c).isalpha()]] = 32
_ASCII_LETTER = np.array([c < 128 and chr(c).isalpha() for c in range(256)])
_LETTER = regex.compile(r"\p{L}")
ROWS = 512
PARTS = 64  # into which each language's ids are dealt for their ranking


@dataclass(frozen=True)
class LangConfig:
    per_language: int = 600
    sample: int = 16_000  # documents fitted on, of all languages together
    dims: int = 4096
    steps: int = 1500
    l2: float = 1e-4
    folds: int = 4
    held_out: int = 2


def family(lang: str) -> str:
    return _FAMILY.get(lang.split("-")[0].lower(), f"other:{lang}")


def histogram(s: Slice, dims: int) -> np.ndarray:
    """(rows, dims) of scaled trigram counts."""
    b = _SPACED[s.buf].astype(np.uint32)
    out = np.zeros((s.rows, dims), np.float32)
    if b.size < 3:
        return out
    code = (b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA77) ^ b[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F) >> np.uint32(15)
    row = np.repeat(np.arange(s.rows), np.diff(s.off))[: code.size]
    inside = np.arange(code.size) + 2 < s.off[row + 1]
    inside &= (b[:-2] != 32) | (b[1:-1] != 32)
    counts = np.bincount(row[inside] * dims + (code[inside] & np.uint32(dims - 1)), minlength=s.rows * dims)
    out = np.sqrt(counts.reshape(s.rows, dims)).astype(np.float32)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def has_letter(s: Slice) -> np.ndarray:
    c = np.concatenate([[0], np.cumsum(_ASCII_LETTER[s.buf])])
    found = c[s.off[1:]] > c[s.off[:-1]]
    for i in np.flatnonzero(~found):
        found[i] = _LETTER.search(s.text(i)) is not None
    return found


def linear_svm(x: np.ndarray, y: np.ndarray, cfg: LangConfig) -> tuple[np.ndarray, float]:
    """Averaged sub-gradient descent on the hinge loss; y is +1 or -1, classes weigh the same."""
    rng = np.random.default_rng(1)
    weight = np.where(y > 0, 0.5 / max((y > 0).mean(), 1e-9), 0.5 / max((y < 0).mean(), 1e-9))
    w, b = np.zeros(x.shape[1]), 0.0
    mean_w, mean_b = np.zeros_like(w), 0.0
    for t in range(1, cfg.steps + 1):
        i = rng.integers(0, y.size, 64)
        bad = y[i] * (x[i] @ w + b) < 1
        push = (y[i] * weight[i] * bad) / i.size
        rate = 2.0 / np.sqrt(t)
        w += rate * (push @ x[i] - cfg.l2 * w)
        b += 0.1 * rate * push.sum()
        if t > cfg.steps // 2:
            mean_w += w
            mean_b += b
    n = cfg.steps - cfg.steps // 2
    return mean_w / n, mean_b / n


@dataclass
class LangModel:
    families: list[str]
    family_w: np.ndarray  # (dims, families)
    family_b: np.ndarray
    languages: dict[str, list[str]]
    pairs: dict[str, tuple[list[tuple[int, int]], np.ndarray, np.ndarray]] = field(default_factory=dict)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sigmoid = lambda z: 1 / (1 + np.exp(-4 * z))
        z = x @ self.family_w + self.family_b
        best = z.argmax(axis=1)
        lang = np.empty(x.shape[0], object)
        sure = sigmoid(z.max(axis=1)) if len(self.families) > 1 else np.ones(x.shape[0])
        for f, name in enumerate(self.families):
            rows = np.flatnonzero(best == f)
            langs = self.languages[name]
            if len(langs) == 1 or not rows.size:
                lang[rows] = langs[0]
                continue
            duels, w, b = self.pairs[name]
            m = x[rows] @ w + b
            votes, margins = np.zeros((rows.size, len(langs))), np.zeros((rows.size, len(langs)))
            for k, (i, j) in enumerate(duels):
                votes[:, i] += m[:, k] >= 0
                votes[:, j] += m[:, k] < 0
                margins[:, i] += m[:, k]
                margins[:, j] -= m[:, k]
            win = (votes + 1e-3 * np.tanh(margins)).argmax(axis=1)
            lang[rows] = np.array(langs, object)[win]
            sure[rows] *= sigmoid(margins[np.arange(rows.size), win] / (len(langs) - 1))
        return lang, np.clip(sure, 0, 1)


def fit(x: np.ndarray, lang: np.ndarray, cfg: LangConfig) -> LangModel | None:
    known = sorted(set(lang.tolist()))
    if not known:
        return None
    fam = np.array([family(v) for v in lang], object)
    families = sorted(set(fam.tolist()))
    heads = [linear_svm(x, np.where(fam == f, 1.0, -1.0), cfg) if len(families) > 1 else (np.zeros(x.shape[1]), 0.0) for f in families]
    model = LangModel(families, np.stack([w for w, _ in heads], axis=1), np.array([b for _, b in heads]), {})
    for f in families:
        langs = [v for v in known if family(v) == f]
        model.languages[f] = langs
        duels = [(i, j) for i in range(len(langs)) for j in range(i + 1, len(langs))]
        fits = []
        for i, j in duels:
            rows = (lang == langs[i]) | (lang == langs[j])
            fits.append(linear_svm(x[rows], np.where(lang[rows] == langs[i], 1.0, -1.0), cfg))
        if duels:
            model.pairs[f] = (duels, np.stack([w for w, _ in fits], axis=1), np.array([b for _, b in fits]))
    return model


def train(docs: DataFrame, cfg: LangConfig) -> LangModel | None:
    """``docs``: doc_id, text, lang. The sample's ids (at most ``sample``, or one a language)
    are found without reading a text and broadcast to the scan. A language's ids are ranked in
    ``PARTS`` parts first, so no task gets all of a frequent one. The driver gets the bins that
    are not 0."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (crc32_mod(F.col("doc_id"), cfg.folds) != cfg.held_out))
    each = max(1, min(cfg.per_language, cfg.sample // max(1, usable.select("lang").distinct().count())))
    hashed = usable.select("doc_id", "lang", F.xxhash64("doc_id").alias("h")).withColumn("part", F.pmod("h", F.lit(PARTS)))

    def first(rows: DataFrame, *by: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy("h", "doc_id"))
        return rows.withColumn("rank", rank).where(F.col("rank") <= each).drop("rank")

    ids = first(first(hashed, "lang", "part"), "lang").select("doc_id", "lang")

    def take(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for s in slices(b.column("text"), max_rows=ROWS):
                x = histogram(s, cfg.dims)
                at = np.flatnonzero(has_letter(s))
                bins = [np.flatnonzero(x[i]) for i in at.tolist()]
                ids = pa.array(at + s.lo)
                packed = [pa.array([k.astype("<u4").tobytes() for k in bins], pa.binary()), pa.array([x[i, k].tobytes() for i, k in zip(at.tolist(), bins, strict=True)], pa.binary())]
                yield pa.record_batch([b.column("doc_id").take(ids), b.column("lang").take(ids), *packed], names=["doc_id", "lang", "bins", "x"])

    picked = docs.join(F.broadcast(ids), ["doc_id", "lang"]).select("doc_id", "lang", "text")
    got = picked.mapInArrow(take, "doc_id long, lang string, bins binary, x binary").toArrow().sort_by("doc_id")
    x = np.zeros((got.num_rows, cfg.dims), np.float32)
    for i, (bins, v) in enumerate(zip(got.column("bins"), got.column("x"), strict=True)):
        x[i, np.frombuffer(bins.as_py(), "<u4")] = np.frombuffer(v.as_py(), np.float32)
    return fit(x, np.array(got.column("lang").to_pylist(), object), cfg)


def identify(docs: DataFrame, model: LangModel | None, cfg: LangConfig) -> DataFrame:
    def predict(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for s in slices(b.column("text"), max_rows=ROWS):
                lang, score = np.full(s.rows, "und", object), np.zeros(s.rows)
                ok = np.flatnonzero(has_letter(s) & ~s.null)
                if model is not None and ok.size:
                    lang[ok], score[ok] = model.predict(histogram(s, cfg.dims)[ok])
                yield pa.record_batch([b.column("doc_id").slice(s.lo, s.rows), pa.array(lang.tolist(), pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(predict, "doc_id long, lang_pred string, score double")


def language_id(docs: DataFrame, cfg: LangConfig | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, lang_pred, score) of every row; lang is read for training only."""
    cfg = cfg or LangConfig()
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    return identify(docs, train(docs, cfg), cfg)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = LangConfig()
    out = language_id(table(spark, sf_dir, "documents"), cfg)
    return out.select("doc_id", F.coalesce(crc32_mod(F.col("doc_id"), cfg.folds) == cfg.held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")
