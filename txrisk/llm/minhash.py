"""MinHash near-dedup: one-permutation hashing, optimal densification, banded buckets,
star-shaped candidate edges, links confirmed on full shingle sets.

A text's distinct k-word shingles are hashed once; the hash space is cut into ``BINS`` bins
and each keeps its least value. An empty bin takes the value of the first non-empty bin in
a random order of its own, the same for all texts, so any two signatures still agree on a
bin with the sets' Jaccard similarity. ``ROWS`` bins make a band; at similarity 0.8 a pair
shares none of the 40 bands with probability 1.3e-7.

Equal sets (128-bit digest) are one class, and only its smallest doc_id goes on. A bucket
of n classes gives n - 1 edges, to its best connected member. Edges are confirmed on whole
texts, grouped by the hub (a large hub is split into blocks of ``HUB_BLOCK``); the test also
notes by which hashes the two sets differ. What a star cannot see are links between two of
a hub's members in different components. With M the hashes a member lacks of the hub's set
and A those it has besides, two members share |hub| - |M1 or M2| + |A1 and A2| hashes, so
such pairs are tested exactly on these short lists, in pairs of blocks of ``BLOCK`` members;
only the links come out, and no text moves again. No candidate of any bucket goes untested
unless its ends are already joined.

Defined cases: null, empty and wordless texts have an empty set and link with nothing; a
text of fewer than k words has its whole sequence as one shingle; rows that share a doc_id
are judged as one document; a row with a null doc_id is kept, unlinked, with a null
component; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm.components import connected_components
from txrisk.llm.shared import ship, stored, table
from txrisk.llm.textvec import U, Slice, distinct_by_row, mix, shingles, slices, words

BANDS, ROWS = 40, 5
BINS = BANDS * ROWS
HUB_BLOCK = 1024
BLOCK = 512
EMPTY = U(2**64 - 1)


@dataclass(frozen=True)
class MinHashConfig:
    words: int = 5
    percent: int = 80  # a link: 100 * intersection >= percent * union


def _orders() -> np.ndarray:
    """Row b: the order in which empty bin b looks at the other bins."""
    rng = np.random.default_rng(20240607)
    return np.argsort(rng.random((BINS, BINS)), axis=1)


def sets_of(s: Slice, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, first) of each text's distinct shingles, hashes ascending in a row."""
    row, h, _ = shingles(words(s, lower=True), k)
    row, h = distinct_by_row(row, h, s.rows)
    return row, h, np.searchsorted(row, np.arange(s.rows + 1))


def signatures(row: np.ndarray, h: np.ndarray, rows: int, orders: np.ndarray) -> np.ndarray:
    """(rows, BINS) densified one-permutation minima; a row without shingles stays EMPTY."""
    bin_ = ((h >> U(32)) * U(BINS) >> U(32)).astype(np.int64)
    sig = np.full(rows * BINS, EMPTY)
    np.minimum.at(sig, row * BINS + bin_, mix(h ^ U(0xA0761D6478BD642F)) >> U(1))
    sig = sig.reshape(rows, BINS)
    filled = sig.copy()
    r, b = np.nonzero((sig == EMPTY) & (sig != EMPTY).any(axis=1)[:, None])
    for step in range(BINS):
        if not r.size:
            break
        value = sig[r, orders[b, step]]
        got = value != EMPTY
        filled[r[got], b[got]] = value[got]
        r, b = r[~got], b[~got]
    return filled


def band_keys(sig: np.ndarray) -> np.ndarray:
    parts = sig.reshape(-1, BANDS, ROWS)
    key = mix(np.arange(1, BANDS + 1, dtype=np.uint64))[None, :].repeat(parts.shape[0], axis=0)
    for j in range(ROWS):
        key = mix((key ^ parts[:, :, j]) * U(0x9E3779B97F4A7C15))
    return key


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, d1, d2, keys): set size, digest of the set, band keys (empty set: none)."""

    def sketch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = _orders()
        for b in it:
            for s in slices(b.column("text")):
                row, h, first = sets_of(s, k)
                n = np.diff(first)
                total = []
                for salt in (U(0x2545F4914F6CDD1D), U(0xD6E8FEB86659FD93)):
                    c = np.concatenate([[U(0)], np.cumsum(mix(h ^ salt))])
                    total.append(c[first[1:]] - c[first[:-1]])
                has = np.flatnonzero(n)
                keys = band_keys(signatures(row, h, s.rows, orders)[has])
                offs = np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))])
                cols = [b.column("doc_id").slice(s.lo, s.rows), pa.array(n), *(pa.array(t.view(np.int64)) for t in total)]
                cols.append(pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(keys.ravel().view(np.int64))))
                yield pa.record_batch(cols, names=["doc_id", "n", "d1", "d2", "keys"])

    return docs.mapInArrow(sketch, "doc_id long, n long, d1 long, d2 long, keys array<long>")


TESTS = "u long, v long, linked boolean, n long, hub_n long, lacks array<long>, adds array<long>"


def confirm(pairs: DataFrame, texts: DataFrame, cfg: MinHashConfig) -> DataFrame:
    """Every pair (u, v), v the hub, tested on the full sets of the whole texts.

    Each text is joined once to its places (as member or hub), then rows meet by (hub,
    block): a hub's own text comes first and its set is kept while its members pass."""
    blocks = pairs.groupBy("v").agg(F.ceil(F.count("*") / HUB_BLOCK).alias("n"))
    members = pairs.join(blocks, "v").select("v", F.pmod(F.xxhash64("u"), F.col("n")).alias("block"), F.col("u").alias("doc_id"), F.lit(1).alias("place"))
    hubs = blocks.select("v", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("block"), F.col("v").alias("doc_id"), F.lit(0).alias("place"))
    rows = texts.join(members.union(hubs).hint("merge"), "doc_id").select("v", "block", "place", "doc_id", "text")
    rows = rows.repartition("v", "block").sortWithinPartitions("v", "block", "place")
    names = [x.split()[0] for x in TESTS.split(", ")]

    def check(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hub = None, np.zeros(0, np.uint64)
        for b in it:
            v, block, place, ids = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            for s in slices(b.column("text")):
                _, h, first = sets_of(s, cfg.words)
                out: list[tuple] = []
                for i in range(s.rows):
                    at, own = s.lo + i, h[first[i] : first[i + 1]]
                    if place[at] == 0:
                        now, hub = (v[at], block[at]), own
                    elif (v[at], block[at]) == now and hub.size:
                        near = np.minimum(np.searchsorted(hub, own), hub.size - 1)
                        both = hub[near] == own
                        there = np.zeros(hub.size, bool)
                        there[near[both]] = True
                        linked = 100 * int(both.sum()) >= cfg.percent * (own.size + hub.size - int(both.sum()))
                        out.append((ids[at], v[at], linked, own.size, hub.size, hub[~there].view(np.int64), own[~both].view(np.int64)))
                cols = list(zip(*out, strict=True)) if out else [()] * len(names)
                types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                yield pa.record_batch([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=names)

    return rows.mapInArrow(check, TESTS)


def stars(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, u, size) of the buckets with two members or more, and the star edges (u, v).

    A bucket's hub v is the member that meets most others over all its buckets: in a group
    of copies that is the text they were made from, to which most of them link."""
    buckets = classes.select(F.explode("keys").alias("key"), F.col("rep").alias("u"))
    shared = buckets.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(buckets.join(shared, "key"), "buckets")
    degree = members.groupBy("u").agg(F.sum("size").alias("degree"))
    hubs = members.join(degree, "u").groupBy("key").agg(F.max(F.struct("degree", (-F.col("u")).alias("minus"))).alias("hub"))
    edges = members.join(hubs, "key").select("u", (-F.col("hub.minus")).alias("v")).where("u <> v")
    return members, stored(edges.distinct(), "pairs")


def _shared(one: np.ndarray, sorted_: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """How many of ``one``'s hashes each owner has."""
    lo, hi = np.searchsorted(sorted_, one, "left"), np.searchsorted(sorted_, one, "right")
    n = hi - lo
    at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return np.bincount(owner[at], minlength=rows)


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes ascending, the list each one is from)."""
    n = np.diff(lists.offsets.to_numpy())
    h = lists.flatten().to_numpy(zero_copy_only=False)
    order = np.argsort(h, kind="stable")
    return h[order], np.repeat(np.arange(n.size), n)[order]


def links_across(rows: pa.RecordBatch, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between members of one pair of blocks that lie in different components."""
    second, u, comp, n = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("second", "u", "component", "n"))
    hub_n = int(rows.column("hub_n")[0].as_py())
    same = rows.column("a")[0] == rows.column("b")[0]
    lacks, adds = rows.column("lacks"), rows.column("adds")
    all_l, own_l = _flat(lacks)
    all_a, own_a = _flat(adds)
    n_l = np.diff(lacks.offsets.to_numpy())
    us, vs = [], []
    for i in range(u.size) if same else np.flatnonzero(second == 0).tolist():
        other = (comp != comp[i]) & ((np.arange(u.size) > i) if same else (second == 1))
        if not other.any():
            continue
        l_i = lacks[i].values.to_numpy(zero_copy_only=False)
        a_i = adds[i].values.to_numpy(zero_copy_only=False)
        both = hub_n - (n_l[i] + n_l - _shared(l_i, all_l, own_l, u.size)) + _shared(a_i, all_a, own_a, u.size)
        j = np.flatnonzero(other & (100 * both >= percent * (n[i] + n - both)))
        us.append(u[j])
        vs.append(np.full(j.size, u[i]))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *us]), np.concatenate([none, *vs])


def unresolved(tests: DataFrame, component: DataFrame, cfg: MinHashConfig) -> DataFrame:
    """Links (u, v) between members of one hub that the stars left in different components.

    A hub's members are cut into blocks of about ``BLOCK`` and worked off by pairs of
    blocks, so a task holds two blocks however many members there are."""
    label = component.select(F.col("doc_id").alias("u"), "component")
    tests = tests.withColumnRenamed("v", "hub")
    held = tests.select("hub", "u").join(label, "u", "left").select("hub", "u", F.coalesce("component", "u").alias("component"))
    split = held.groupBy("hub").agg(F.count("*").alias("size"), F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    open_ = held.join(split.select("hub", F.ceil(F.col("size") / BLOCK).alias("blocks")), "hub")
    open_ = open_.withColumn("own", F.pmod(F.xxhash64("u"), F.col("blocks")))
    rows = tests.join(open_, ["hub", "u"]).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select("hub", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), (F.col("own") > F.col("other")).cast("int").alias("second"), "u", "component", "n", "hub_n", "lacks", "adds")
    rows = rows.repartition("hub", "a", "b").sortWithinPartitions("hub", "a", "b")

    def pairs(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def done() -> pa.RecordBatch:
            group = pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
            u, v = links_across(group, cfg.percent)
            return pa.record_batch([pa.array(u), pa.array(v)], names=["u", "v"])

        for b in it:
            key = [b.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
            cuts = [0, *new.tolist(), b.num_rows]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                if y == x:
                    continue
                if kept and [kept[0].column(i)[0] for i in range(3)] != [b.column(i)[x] for i in range(3)]:
                    yield done()
                    kept = []
                kept.append(b.slice(x, y - x))
        if kept:
            yield done()

    return rows.mapInArrow(pairs, "u long, v long")


def near_duplicates(docs: DataFrame, cfg: MinHashConfig | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``."""
    cfg = cfg or MinHashConfig()
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketch = stored(sketches(docs, cfg.words), "sketches")
    known = docs.where("doc_id is not null")
    one = sketch.where("n > 0 and doc_id is not null").groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "keys")).alias("c"))
    classes = stored(one.select("d1", "d2", F.col("c.doc_id").alias("rep"), F.col("c.keys").alias("keys")), "classes")

    members, pairs = stars(classes)
    # the ids grow with the corpus: a shuffle at any size, and one only of all texts
    ids = members.select(F.col("u").alias("doc_id")).distinct()
    texts = stored(known.join(ids.hint("merge"), "doc_id"), "texts")
    tests = stored(confirm(pairs, texts, cfg), "tests")
    links = tests.where("linked").select("u", "v")
    more = unresolved(tests, connected_components(links), cfg)
    component = connected_components(links.union(more))

    named = classes.select("d1", "d2", "rep").join(component.select(F.col("doc_id").alias("rep"), "component"), "rep", "left")
    named = named.select("d1", "d2", F.coalesce("component", "rep").alias("component"))
    out = sketch.select("doc_id", F.col("n").alias("n_shingles"), "d1", "d2").join(named, ["d1", "d2"], "left")
    linked = F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), linked))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), MinHashConfig(words=2))


#: The contract in DuckDB SQL over all rows: all pairs that share a shingle, then a recursive closure.
ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]]
      ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || chr(10) || ws[i + 1]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
r AS (SELECT doc_id AS u, doc_id AS v FROM w UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.m AS component_id, w.doc_id = c.m AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT u, min(v) AS m FROM r GROUP BY u) c ON c.u = w.doc_id
"""
