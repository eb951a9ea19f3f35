"""Best-fit packing of token sequences under several capacities (vector best fit).

Every document becomes pieces of at most ``max_tokens`` ids; only the first piece of a
longer document is short, the others fill a sequence alone. Short pieces are dealt into
groups of bounded size by a hash of their place, and each group is packed on its own in
decreasing length: a piece goes to the open sequence whose residual vector (tokens,
documents, attention cost), as shares of the capacities, is left with the smallest
weighted norm, or with the largest weighted dot product of demand and residual, among
those with room in every dimension. A group loses about one sequence against packing all
at once, under 0.1 % of its sequences at the default size.

Defined cases: a null or empty text is the end id alone; a row with a null doc_id is packed
as any other and keeps its null; repeated rows are packed as often as they occur; an empty
table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm.bpe import default_tokenizer, encoder
from txrisk.llm.shared import ship, stored, table
from txrisk.llm.textvec import slices


@dataclass(frozen=True)
class Capacity:
    """Room of one sequence. ``attention`` bounds the sum of squared piece lengths; the
    defaults of the last two never bind, so the fewest sequences can be reached."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048


@dataclass(frozen=True)
class PackConfig:
    capacity: Capacity = Capacity()
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"  # or "dot"
    group_rows: int = 8192  # pieces packed together; the last group may be smaller


def best_fit(length: np.ndarray, cfg: PackConfig) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece, bins numbered from 0."""
    cap = np.array([cfg.capacity.tokens, cfg.capacity.documents, cfg.capacity.attention], float)
    weight = np.array(cfg.weights)[:, None]
    order = np.argsort(-length, kind="stable")
    where, offset = np.empty(length.size, np.int64), np.empty(length.size, np.int64)
    # of the bins that can still take the shortest piece: their numbers and residual shares
    room, number = np.empty((3, 0)), np.empty(0, np.int64)
    used: list[int] = []
    least = np.array([length[order[-1]], 1, float(length[order[-1]]) ** 2]) / cap if length.size else None
    for i in order.tolist():
        n = int(length[i])
        need = np.array([[n / cap[0]], [1 / cap[1]], [n * n / cap[2]]])
        left = room - need
        fits = (left >= -1e-12).all(axis=0)
        if fits.any():
            score = (weight * left * left).sum(axis=0) if cfg.rule == "norm" else -(weight * room * need).sum(axis=0)
            k = int(np.argmin(np.where(fits, score, np.inf)))
            room[:, k] = left[:, k]
        else:
            room = np.concatenate([room, 1.0 - need], axis=1)
            number = np.append(number, len(used))
            used.append(0)
            k = number.size - 1
        b = int(number[k])
        where[i], offset[i] = b, used[b]
        used[b] += n
        if (room[:, k] < least - 1e-12).any():  # nothing fits any more
            room, number = np.delete(room, k, axis=1), np.delete(number, k)
    return where, offset


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, place long"


def pieces(docs: DataFrame, tokenizer: str | None = None, max_tokens: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece, made in the scan's own tasks; ``place`` tells equal rows apart."""
    ship(docs.sparkSession)
    path = tokenizer or default_tokenizer()
    names = [x.split()[0] for x in PIECES.split(", ")]

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = encoder(path)
        place = TaskContext.get().partitionId() << 40
        for b in it:
            for s in slices(b.column(1)):
                ids, first = enc.encode(s)
                ids = np.insert(ids, first[1:], end_id).astype("<u4")
                first = first + np.arange(first.size)
                n = np.diff(first)
                k = -(-n // max_tokens)
                row = np.repeat(np.arange(s.rows), k)
                piece = np.arange(row.size) - np.repeat(np.cumsum(k) - k, k)
                head = n - (k - 1) * max_tokens
                start = np.where(piece == 0, 0, head[row] + (piece - 1) * max_tokens)
                size = np.where(piece == 0, head[row], max_tokens)
                view = memoryview(ids).cast("B")
                a = (first[row] + start) * 4
                crc = [zlib.crc32(view[x:y]) for x, y in zip(a.tolist(), (a + size * 4).tolist(), strict=True)]
                cols = [b.column(0).slice(s.lo, s.rows).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(size), pa.array(crc, pa.int64()), pa.array(place + np.arange(row.size))]
                place += row.size
                yield pa.record_batch(cols, names=names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, PIECES)


def pack(found: DataFrame, cfg: PackConfig | None = None) -> DataFrame:
    """Add sequence_id and offset to stored pieces."""
    cfg = cfg or PackConfig()
    full = found.where(F.col("length") == cfg.capacity.tokens)
    short = found.where(F.col("length") < cfg.capacity.tokens)
    groups = max(1, -(-short.count() // cfg.group_rows))
    out = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def fill(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        where, offset = best_fit(rows["length"].to_numpy(), cfg)
        rows["sequence_id"] = where * groups + int(key[0])
        rows["offset"] = offset
        return rows[[x.split()[0] for x in out.split(", ")]]

    packed = short.withColumn("__g", F.pmod(F.xxhash64("place"), F.lit(groups))).groupBy("__g").applyInPandas(fill, out)
    # full pieces take negative numbers, so the two kinds never meet
    alone = full.select("doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.col("place")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone)


def best_fit_packing(docs: DataFrame, tokenizer: str | None = None, cfg: PackConfig | None = None) -> DataFrame:
    """Texts to packed pieces. The pieces (about 50 bytes each, no ids) are stored first, so a
    repeated task cannot deal them differently and the texts are encoded once."""
    cfg = cfg or PackConfig()
    return pack(stored(pieces(docs, tokenizer, cfg.capacity.tokens), "pieces"), cfg)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"))
