"""Benchmark decontamination: SimHash over item-sized windows, multi-index Hamming blocks,
exact weighted-shingle similarity.

An item's fingerprint is the 128-bit SimHash of its 5-word shingles. Documents are read in
windows of an item's size: with a step g (1, 2, 4 or 8 shingles, a quarter of the item at
most) and a width of the item's n shingles rounded up to a multiple of g past n + g - 1, some
window covers any stretch of n shingles. An item occurring with similarity 0.8 then differs
from that window's fingerprint in a known share of bits; the radius is that plus three
standard deviations. The 128 bits are cut into eight blocks with error bounds whose sum
excludes a greater distance in all of them at once, so each fingerprint within the radius of
an item agrees with it in some block up to that block's bound: a table over a block's 65 536
values tells the items, and the full distance is counted for those alone.

Candidates are verified on whole shingle sets: over the item-sized stretches of the document
around the window, the similarity is sum of weights of common shingles (by the smaller count)
over that of all, a shingle's weight being ln(1 + items / items that hold it), by counts over the whole
benchmark (one that no item holds weighs as one that a single item holds).

The benchmark's distinct texts are read in blocks of about ``BLOCK_CHARS`` characters and
``BLOCK_ITEMS`` texts (64 kB of masks each), each broadcast and matched against all
documents. The weights of the shingles that two items or more hold go with every block, 16
bytes each: a stretch may hold shingles of other blocks' items.

Defined cases: items of fewer than 5 words are no evidence and never match; null or empty
texts match nothing; rows with a null doc_id or item_id are matched and carry the null;
repeated rows give repeated matches; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import acos, ceil, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm.shared import ship, stored, table
from txrisk.llm.textvec import U, distinct_by_row, mix, shingles, slices, words

BITS, BLOCKS = 128, 8
BLOCK_CHARS, BLOCK_ITEMS = 8_000_000, 2000
SLICE = 1 << 19


@dataclass(frozen=True)
class LeakConfig:
    words: int = 5
    similarity: float = 0.8


def _step(n: int) -> int:
    return 1 if n < 8 else 2 if n < 16 else 4 if n < 32 else 8


def _shape(n: int) -> tuple[int, int]:
    """(step, width) of the windows for an item of n shingles."""
    g = _step(n)
    return g, ceil((n + g - 1) / g) * g


def radius(n: int, width: int, similarity: float) -> int:
    """Bits in which a window may differ: the mean for an occurrence of that similarity in
    the window's middle, and three standard deviations."""
    common = 2 * similarity / (1 + similarity)
    p = acos(min(1.0, common * sqrt(n / width))) / pi
    return min(BITS // 2 - 4, ceil(BITS * p + 3 * sqrt(BITS * p * (1 - p))))


def fingerprint_bits(h: np.ndarray) -> np.ndarray:
    """(shingles, 128) bits of the shingle hashes."""
    two = np.stack([mix(h ^ U(0x51ED270B35C1F2A7)), mix(h ^ U(0xC3A5C85C97CB3127))], axis=1)
    return np.unpackbits(two.view(np.uint8), axis=1)


def simhash(h: np.ndarray) -> np.ndarray:
    """The two halves of one fingerprint."""
    return np.packbits(2 * fingerprint_bits(h).sum(axis=0, dtype=np.int64) > h.size).view(np.uint64)


@dataclass
class Group:
    """Items that share a window shape, 64 of them at most."""

    step: int
    width: int
    item: list[int]
    prints: np.ndarray  # (items, 2)
    radius: np.ndarray
    tables: np.ndarray  # (BLOCKS, 65536) masks of items, as narrow as their number allows


_ERRORS = np.bitwise_count(np.arange(1 << 16, dtype=np.uint16))


def index(items: list[tuple[int, np.ndarray]], cfg: LeakConfig) -> list[Group]:
    shapes: dict[tuple[int, int], list[int]] = {}
    for k, (_, h) in enumerate(items):
        if h.size:
            shapes.setdefault(_shape(h.size), []).append(k)
    out = []
    for (g, width), members in sorted(shapes.items()):
        for lo in range(0, len(members), 64):
            part = members[lo : lo + 64]
            prints = np.stack([simhash(items[k][1]) for k in part])
            r = np.array([radius(items[k][1].size, width, cfg.similarity) for k in part])
            kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if np.iinfo(t).bits >= len(part))
            tables = np.zeros((BLOCKS, 1 << 16), kind)
            value = np.arange(1 << 16, dtype=np.uint16)
            for m in range(len(part)):
                # bounds t_b with sum(t_b + 1) = r + 1: not all blocks can be over theirs
                base, extra = divmod(int(r[m]) + 1, BLOCKS)
                for b, own in enumerate(prints[m].view(np.uint16)):
                    bound = base - 1 + (b < extra)
                    near = _ERRORS[value ^ own] <= bound if bound >= 0 else np.zeros(1 << 16, bool)
                    tables[b][near] |= kind(1 << m)
            out.append(Group(g, width, part, prints, r, tables))
    return out


class BitSums:
    """Running sums of the bits of a slice's shingles, 8 or 4 counters in a 64-bit word: a
    difference of two is exact while each counter of it stays below 256 or 65 536."""

    def __init__(self, h: np.ndarray):
        self.bits, self.done = fingerprint_bits(h), {}

    def windows(self, step: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, fingerprint halves) of the windows that start at the multiples of ``step``.

        They run over the ends of texts: what a window holds of a neighbour counts as the
        rest of its own text would, and is left out when its stretches are verified."""
        kind = np.uint8 if width < 256 else np.uint16
        if kind not in self.done:
            lanes = np.ascontiguousarray(self.bits.astype(kind, copy=False).view(np.uint64).T)
            sums = np.zeros((lanes.shape[0], lanes.shape[1] + 1), np.uint64)
            np.cumsum(lanes, axis=1, out=sums[:, 1:])
            self.done[kind] = np.ascontiguousarray(sums.T)
        sums = self.done[kind]
        n = sums.shape[0] - 1
        start = np.arange(0, n, step)
        whole = len(range(0, n - width + 1, step))
        ones = np.empty((start.size, sums.shape[1]), np.uint64)
        np.subtract(sums[width::step][:whole], sums[::step][:whole], out=ones[:whole])
        np.subtract(sums[-1], sums[start[whole:]], out=ones[whole:])
        prints = np.packbits(ones.view(kind) > width // 2, axis=1)
        for i, a in enumerate(start[whole:].tolist(), whole):  # cut off at the end
            prints[i] = np.packbits(ones[i].view(kind) > (n - a) // 2)
        halves = prints.view(np.uint64)
        return start, np.ascontiguousarray(halves[:, 0]), np.ascontiguousarray(halves[:, 1])


def candidates(sums: BitSums, g: Group) -> Iterator[tuple[int, np.ndarray]]:
    """(member, starts) of the windows within the radius of each item of the group."""
    start, one, two = sums.windows(g.step, g.width)
    parts = [*one.view(np.uint16).reshape(-1, 4).T, *two.view(np.uint16).reshape(-1, 4).T]
    mask = g.tables[0][parts[0]]
    for b in range(1, BLOCKS):
        mask |= g.tables[b][parts[b]]
    for m in range(len(g.item)):
        at = np.flatnonzero(mask & mask.dtype.type(1 << m))
        apart = np.bitwise_count(one[at] ^ g.prints[m, 0])
        apart += np.bitwise_count(two[at] ^ g.prints[m, 1])
        near = apart <= g.radius[m]
        if near.any():
            yield m, start[at[near]]


class Weights:
    """Weights of shingles; ``key`` has the ascending ones that two items or more hold."""

    def __init__(self, key: np.ndarray, n: np.ndarray, n_items: int):
        self.key, self.value, self.rare = key, np.log(1 + n_items / n), log(1 + max(n_items, 1))

    def of(self, h: np.ndarray) -> np.ndarray:
        if not self.key.size:
            return np.full(h.size, self.rare)
        at = np.minimum(np.searchsorted(self.key, h), self.key.size - 1)
        return np.where(self.key[at] == h, self.value[at], self.rare)


def best_match(doc: np.ndarray, item: Counter, size: int, total: float, weights: Weights, starts: np.ndarray, width: int, least: float) -> tuple[float, int] | None:
    """The best stretch of ``size`` shingles that lies in one of the windows."""
    at = np.unique(np.concatenate([np.arange(max(0, min(s, doc.size - size)), max(0, min(s + width - 1, doc.size - size)) + 1) for s in starts.tolist()]))
    lo, hi = int(at[0]), int(min(at[-1] + size, doc.size))
    part = doc[lo:hi]
    keys = np.array(sorted(item), np.uint64)
    pos = np.minimum(np.searchsorted(keys, part), keys.size - 1)
    hit = keys[pos] == part
    c = np.concatenate([[0], np.cumsum(hit)])
    hits = c[np.minimum(at + size, doc.size) - lo] - c[at - lo]
    # a first exact bound: even if all hits counted with the largest weight
    at, hits = at[hits > 0], hits[hits > 0]
    best, weight = None, None
    top = float(weights.of(keys).max())
    for s, n in sorted(zip(at.tolist(), hits.tolist(), strict=True), key=lambda x: (-x[1], x[0])):
        if n * top < least * total or (best is not None and n * top <= best[0] * total):
            break
        weight = weight or dict(zip(part.tolist(), weights.of(part).tolist(), strict=True))
        own = Counter(doc[s : s + size].tolist())
        common = sum(weight[k] * min(v, item[k]) for k, v in own.items() if k in item)
        all_ = total + sum(weight[k] * v for k, v in own.items()) - common
        if common >= least * all_ - 1e-12 and (best is None or common / all_ > best[0]):
            best = (common / all_, s)
    return best


FOUND = "doc_id long, item_id long, start_word long, n_words long, similarity double"


def leaks(docs: DataFrame, benchmark: DataFrame, cfg: LeakConfig | None = None, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each document and item that it holds: the best stretch and its similarity."""
    cfg = cfg or LeakConfig()
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    items = stored(benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("text")), "benchmark")
    texts = items.groupBy("text").agg(F.collect_list(F.struct("item_id")).alias("ids"))
    chars, n_texts, n_items = texts.agg(F.sum(F.length("text")), F.count("*"), F.sum(F.size("ids"))).first()
    blocks = max(1, -(-int(chars or 0) // BLOCK_CHARS), -(-n_texts // BLOCK_ITEMS))
    shared = holders(items, cfg).where("n > 1").toArrow()
    key, n = (shared.column(i).to_numpy() for i in range(2))
    order = np.argsort(key.view(np.uint64))
    weights = spark.sparkContext.broadcast(Weights(key.view(np.uint64)[order], n[order], int(n_items or 0)))
    out = None
    for k in range(blocks):
        own = texts.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).orderBy("text").toArrow()
        found = _match(docs, own, weights, cfg)
        out = found if out is None else out.union(found)
    return out


def holders(items: DataFrame, cfg: LeakConfig) -> DataFrame:
    """(h, n): the items that hold each shingle."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for s in slices(b.column(0)):
                row, h, _ = shingles(words(s, lower=True), cfg.words, whole_if_short=False)
                yield pa.record_batch([pa.array(distinct_by_row(row, h, s.rows)[1].view(np.int64))], names=["h"])

    return items.select("text").mapInArrow(run, "h long").groupBy("h").agg(F.count("*").alias("n"))


def _match(docs: DataFrame, own: pa.Table, weights, cfg: LeakConfig) -> DataFrame:
    names = [[x["item_id"] for x in ids] for ids in own.column("ids").to_pylist()]
    hashes: list[np.ndarray] = []
    for s in slices(own.column("text")):
        _, h, first = shingles(words(s, lower=True), cfg.words, whole_if_short=False)
        hashes += [h[first[i] : first[i + 1]] for i in range(s.rows)]
    sets = [Counter(h.tolist()) for h in hashes]
    totals = [float(weights.value.of(h).sum()) for h in hashes]
    groups = index(list(enumerate(hashes)), cfg)
    shared = docs.sparkSession.sparkContext.broadcast((names, sets, totals, groups))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, sets, totals, groups = shared.value
        for b in it:
            ids = b.column("doc_id")
            for s in slices(b.column("text"), SLICE):
                _, h, first = shingles(words(s, lower=True), cfg.words, whole_if_short=False)
                if not h.size:
                    continue
                sums, out = BitSums(h), []
                for g in groups:
                    for m, starts in candidates(sums, g):
                        k = g.item[m]
                        size = sum(sets[k].values())
                        head = np.searchsorted(first, starts, "right") - 1
                        last = np.searchsorted(first, np.minimum(starts + g.width, h.size) - 1, "right") - 1
                        for r in sorted({x for a, z in zip(head.tolist(), last.tolist(), strict=True) for x in range(a, z + 1)}):
                            doc = h[first[r] : first[r + 1]]
                            own = starts[(head <= r) & (last >= r)] - first[r]
                            got = best_match(doc, sets[k], size, totals[k], weights.value, own, g.width, cfg.similarity) if doc.size else None
                            if got:
                                out += [(ids[s.lo + r].as_py(), name, got[1], min(size, doc.size) + cfg.words - 1, got[0]) for name in names[k]]
                if out:
                    cols = list(zip(*out, strict=True))
                    yield pa.record_batch([pa.array(list(c), t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.float64()], strict=True)], names=[x.split()[0] for x in FOUND.split(", ")])

    return docs.mapInArrow(run, FOUND)


def decontaminate(docs: DataFrame, benchmark: DataFrame, cfg: LeakConfig | None = None, id_col: str = "doc_id", **names) -> DataFrame:
    """``docs`` without the documents that hold an item; a null doc_id is never removed."""
    bad = stored(leaks(docs, benchmark, cfg, id_col=id_col, **names), "leaks").select(F.col("doc_id").alias("__leak")).distinct()
    return docs.join(bad, F.col(id_col).cast("long") == F.col("__leak"), "left_anti")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
