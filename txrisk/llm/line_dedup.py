"""Line dedup with a once-seen and a twice-seen Bloom filter.

1. Each task fills two filters with the line keys it reads: a key found in the once filter
   goes into the twice filter too. Filters of tasks merge as (once | once', twice | twice' |
   once & once'), region by region, in tasks of their own; a key seen twice anywhere has all
   its bits in the merged twice filter, which is the only thing broadcast.
2. Only keys found there are shuffled, as 128-bit digests with their doc_id, once a document:
   exact document counts and the largest doc_id follow from two grouped passes. Lines that
   hold more than half of a partition's even share of these rows are fewer than twice the
   partitions: they are broadcast and met where the rows are read, so no task gets a hot line.
3. The keys each document loses are joined to it and its text is rewritten.

The filter takes ``BITS_A_DOC`` bits a document, at most ``MAX_BITS`` (128 MB): beyond that
more lines than the repeated ones are shuffled, with the same result.

Defined cases: a null or empty text is one empty line, which is never dropped (its key is too
short), a null text becomes empty; a line repeated inside a document counts once; rows that
share a doc_id are one document; a row with a null doc_id is neither counted nor changed; an
empty table gives an empty table; other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm.shared import ship, stored, table
from txrisk.llm.textvec import Slice, slices

BITS_A_DOC = 64
MIN_BITS, MAX_BITS = 1 << 20, 1 << 30
HASHES = 2
REGION = 1 << 20  # bits of a filter region

_SPACE = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class LineConfig:
    min_chars: int = 20
    min_docs: int = 3


def line_keys(raw: bytes, min_chars: int) -> list[bytes | None]:
    """The key of every line of a text; None if it is too short to count."""
    out: list[bytes | None] = []
    for line in raw.split(b"\n"):
        key = line.strip(_SPACE).lower()  # bytes.lower() changes A-Z alone
        long = len(key) >= min_chars and (len(key) >= 4 * min_chars or key.isascii() or len(key.decode()) >= min_chars)
        out.append(key if long else None)
    return out


def _digests(s: Slice, i: int, min_chars: int) -> list[int]:
    keys = line_keys(s.buf[s.off[i] : s.off[i + 1]].tobytes(), min_chars)
    return list({xxhash.xxh3_128_intdigest(k) for k in keys if k is not None})


def _places(digest: np.ndarray, bits: int) -> np.ndarray:
    """(n, HASHES) bit places of the high halves of digests."""
    a, b = digest & np.uint64(0xFFFFFFFF), digest >> np.uint64(32) | np.uint64(1)
    return ((a[:, None] + b[:, None] * np.arange(HASHES, dtype=np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


def _get(filter_: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (filter_[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _set(filter_: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(filter_, at >> 3, (1 << (at & 7)).astype(np.uint8))


def _ones(filter_: np.ndarray) -> np.ndarray:
    byte = np.flatnonzero(filter_)
    bit = np.unpackbits(filter_[byte], bitorder="little").reshape(-1, 8)
    r, c = np.nonzero(bit)
    return byte[r] * 8 + c


def filter_bits(n_docs: int) -> int:
    return min(MAX_BITS, max(MIN_BITS, 1 << (BITS_A_DOC * max(1, n_docs) - 1).bit_length()))


def twice_seen(texts: DataFrame, bits: int, cfg: LineConfig) -> np.ndarray:
    """The merged twice-seen filter over column ``text``."""

    def fill(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits >> 3, np.uint8), np.zeros(bits >> 3, np.uint8)
        for b in it:
            for s in slices(b.column("text")):
                found = [d & 0xFFFFFFFFFFFFFFFF for i in range(s.rows) for d in _digests(s, i, cfg.min_chars)]
                digest, n = np.unique(np.array(found, np.uint64), return_counts=True)
                at = _places(digest, bits)
                again = _get(once, at).all(axis=1) | (n > 1)
                _set(once, at.ravel())
                _set(twice, at[again].ravel())
        a, b2 = _ones(once), _ones(twice)
        for r in np.flatnonzero(np.bincount(a // REGION, minlength=bits // REGION)).tolist():
            lo, hi = r * REGION, (r + 1) * REGION
            x = a[np.searchsorted(a, lo) : np.searchsorted(a, hi)] - lo
            y = b2[np.searchsorted(b2, lo) : np.searchsorted(b2, hi)] - lo
            yield pa.record_batch([pa.array([r], pa.int64()), pa.array([x.astype("<u4").tobytes()]), pa.array([y.astype("<u4").tobytes()])], names=["region", "once", "twice"])

    def merge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region, once, twice = None, np.zeros(0, bool), np.zeros(0, bool)

        def out():
            return pa.record_batch([pa.array([region], pa.int64()), pa.array([np.packbits(twice, bitorder="little").tobytes()])], names=["region", "bits"])

        for b in it:
            for r, x, y in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if r != region:
                    if region is not None:
                        yield out()
                    region, once, twice = r, np.zeros(REGION, bool), np.zeros(REGION, bool)
                x, y = np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")
                twice[x[once[x]]] = True
                twice[y] = True
                once[x] = True
        if region is not None:
            yield out()

    regions = bits // REGION
    parts = texts.mapInArrow(fill, "region long, once binary, twice binary")
    merged = parts.repartition(regions, "region").sortWithinPartitions("region").mapInArrow(merge, "region long, bits binary")
    seen = np.zeros(bits >> 3, np.uint8)
    for row in merged.collect():  # bits / 8 bytes in all, MAX_BITS at most
        seen[row.region * (REGION >> 3) : (row.region + 1) * (REGION >> 3)] = np.frombuffer(row.bits, np.uint8)
    return seen


def repeated_lines(docs: DataFrame, cfg: LineConfig) -> DataFrame:
    """(doc_id, keys): the digests of the lines each document loses."""
    spark = docs.sparkSession
    bits = filter_bits(docs.count())
    texts = docs.select("doc_id", "text").where("doc_id is not null")
    seen = spark.sparkContext.broadcast(twice_seen(texts.select("text"), bits, cfg).tobytes())

    def suspects(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = np.frombuffer(seen.value, np.uint8)
        for b in it:
            for s in slices(b.column("text")):
                per_row = [_digests(s, i, cfg.min_chars) for i in range(s.rows)]
                row = np.repeat(np.arange(s.rows), [len(x) for x in per_row])
                flat = [d for x in per_row for d in x]
                k1 = np.array([d & 0xFFFFFFFFFFFFFFFF for d in flat], np.uint64)
                k2 = np.array([d >> 64 for d in flat], np.uint64)
                hit = _get(twice, _places(k1, bits)).all(axis=1) if k1.size else np.zeros(0, bool)
                ids = b.column("doc_id").slice(s.lo, s.rows).take(pa.array(row[hit]))
                yield pa.record_batch([ids, pa.array(k1[hit].view(np.int64)), pa.array(k2[hit].view(np.int64))], names=["doc_id", "k1", "k2"])

    found = stored(texts.mapInArrow(suspects, "doc_id long, k1 long, k2 long").distinct(), "lines")
    repeats = found.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= cfg.min_docs)
    confirmed = stored(repeats, "repeats")
    share = found.count() / (2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    hot, rest = F.broadcast(confirmed.where(F.col("n") > share)), confirmed.where(F.col("n") <= share)
    key = ["k1", "k2"]
    lost = found.join(hot, key).union(found.join(hot.select(*key), key, "left_anti").join(rest, key))
    return lost.where("doc_id < keeper").groupBy("doc_id").agg(F.collect_list("k1").alias("k1s"), F.collect_list("k2").alias("k2s"))


def line_dedup(docs: DataFrame, cfg: LineConfig | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated lines taken out of its text, and ``n_lines``, ``n_dropped``."""
    cfg = cfg or LineConfig()
    ship(docs.sparkSession)
    drops = repeated_lines(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), cfg)
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rest = [F.col(f"d.`{c}`") for c in names if c not in (text_col,)]
    both = docs.select(*names).alias("d").join(drops.alias("x"), F.col(f"d.`{id_col}`").cast("long") == F.col("x.doc_id"), "left")
    packed = both.select(F.struct(*rest).alias("rest") if rest else F.lit(1).alias("rest"), F.col(f"d.`{text_col}`").alias("text"), F.col("x.k1s").alias("k1s"), F.col("x.k2s").alias("k2s"))

    def rewrite(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            texts, lines, gone = [], [], []
            for text, k1s, k2s in zip(b.column("text").to_pylist(), b.column("k1s").to_pylist(), b.column("k2s").to_pylist(), strict=True):
                raw = (text or "").encode()
                n = raw.count(b"\n") + 1
                left = n
                if k1s:
                    lose = {(x & 0xFFFFFFFFFFFFFFFF) | (y & 0xFFFFFFFFFFFFFFFF) << 64 for x, y in zip(k1s, k2s, strict=True)}
                    parts = zip(raw.split(b"\n"), line_keys(raw, cfg.min_chars), strict=True)
                    keep = [p for p, k in parts if k is None or xxhash.xxh3_128_intdigest(k) not in lose]
                    left, raw = len(keep), b"\n".join(keep)
                texts.append(raw.decode())
                lines.append(n)
                gone.append(n - left)
            yield pa.record_batch([b.column("rest"), pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(gone, pa.int64())], names=["rest", "text", "n_lines", "n_dropped"])

    from pyspark.sql import types as T

    schema = T.StructType([packed.schema["rest"], T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    done = packed.select("rest", "text", "k1s", "k2s").mapInArrow(rewrite, schema)
    cols = [F.col("text").alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c) for c in names]
    return done.select(*cols, "n_lines", "n_dropped")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


#: The contract in DuckDB SQL, over all rows.
ORACLE = r"""
WITH t AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT doc_id, line, pos, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM t),
r AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE r.key IS NOT NULL AND k.doc_id <> r.keeper) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY pos) FILTER (WHERE r.key IS NULL OR k.doc_id = r.keeper), '')) AS kept_sha256
FROM k LEFT JOIN r ON k.key = r.key GROUP BY k.doc_id
"""
