"""Spelling variants: words that are one edit from a much more frequent word.

The words and their counts come from one pass over the texts. Pairs of near words are the
accepted pairs of V o E o V: V accepts the vocabulary (minimised), E changes exactly one code
point. An accepting path reads equal code points, one edit at the first place where the words
differ, then equal code points again; so every pair has one path.

The composition is partitioned by its state before the edit. Words are grouped by their first
three code points; a group's initial state is the one that V has reached after them, and it
yields the pairs that differ later. Pairs that differ within the first three code points agree
in their last three, as words have seven at least: the same composition of the reversed words,
grouped by those, yields them (pairs that the first kind yields are left out there). A group
of more than ``group_words`` words is split: the edits at its next places, up to twice the
depth, are looked up by (place, word without that code point), where at most one word and one
variant a letter meet, and the words are grouped again by twice the depth. So no task holds
more than a bounded group, and no pairs are written: a group returns each word's number of
near words and the best of them.

Forms are followed by pointer doubling. A form has ten times the count of its word, so the
longest chain follows from the largest count.

Defined cases: a null or empty text has no words; a null doc_id counts as an empty one in the
hash; very long texts and words are taken whole; rows that repeat count again; of near words
with equal counts the smallest in code-point order is the form; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm.shared import ship, stored, table
from txrisk.llm.textvec import LOWER, Slice, slices


@dataclass(frozen=True)
class SpellingConfig:
    least_length: int = 7
    least_count: int = 2
    times: int = 10  # a form has at least this many times its word's count
    every: int = 31  # one run in so many (by its hash) loses a code point
    depth: int = 3  # code points of the initial state; twice as many and one are a word's least
    group_words: int = 20_000


# --- the vocabulary ----------------------------------------------------------------------

ASCII_LETTER = np.array([chr(c).isalpha() and c < 128 for c in range(256)])
#: First byte of the code points U+00C0 to U+00FF, in UTF-8.
LATIN = 0xC3
SCALAR_BYTES = 64


def _crc_table() -> np.ndarray:
    """The table of CRC-32 (polynomial 0xEDB88320)."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, t >> 1 ^ np.uint32(0xEDB88320), t >> 1)
    return t


CRC = _crc_table()


def crc_after(prefix: np.ndarray, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of bytes, going on from the CRC-32 of what precedes it."""
    size = end - start
    order = np.argsort(-size, kind="stable")
    at, left = start[order], -size[order]
    state = ~prefix[order]
    for j in range(min(int(-left[0]), SCALAR_BYTES) if order.size else 0):
        m = int(np.searchsorted(left, -j))
        state[:m] = CRC[(state[:m] ^ buf[at[:m] + j]) & 0xFF] ^ state[:m] >> np.uint32(8)
    out = np.empty(size.size, np.uint32)
    out[order] = ~state
    for i in np.flatnonzero(size > SCALAR_BYTES).tolist():
        out[i] = zlib.crc32(buf[start[i] : end[i]].tobytes(), int(prefix[i]))
    return out


def words_of(s: Slice, ids: list[int | None], cfg: SpellingConfig) -> pa.Array:
    """The words of a slice's texts, long enough, one entry an occurrence."""
    buf = LOWER[s.buf]
    lead = buf == LATIN
    letter = ASCII_LETTER[buf] | lead
    letter[1:] |= lead[:-1]
    begin, stop = letter.copy(), letter.copy()
    begin[1:] &= ~letter[:-1]
    stop[:-1] &= ~letter[1:]
    full = np.flatnonzero(s.off[1:] > s.off[:-1])
    first, last = s.off[full], s.off[full + 1] - 1
    begin[first], stop[last] = letter[first], letter[last]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    wide = np.concatenate([[0], np.cumsum(lead)])
    points = end - start - (wide[end] - wide[start])
    keep = points >= cfg.least_length
    start, end, points = start[keep], end[keep], points[keep]
    row = np.searchsorted(s.off, start, "right") - 1
    head = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    h = crc_after(head[row], buf, start, end)
    cut = h % np.uint32(cfg.every) == 0
    shorter = []
    for i in np.flatnonzero(cut & (points > cfg.least_length)).tolist():
        w = buf[start[i] : end[i]].tobytes().decode()
        k = int(h[i]) % len(w)
        shorter.append(w[:k] + w[k + 1 :])
    start, size = start[~cut], (end - start)[~cut]
    off = np.concatenate([[0], np.cumsum(size)])
    data = buf[np.repeat(start - off[:-1], size) + np.arange(off[-1])] if start.size else buf[:0]
    whole = pa.LargeStringArray.from_buffers(start.size, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
    return pa.concat_arrays([whole, pa.array(shorter, pa.large_string())])


def vocabulary(docs: DataFrame, cfg: SpellingConfig = SpellingConfig(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the distinct words and their occurrences, counted before the shuffle."""
    ship(docs.sparkSession)

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            ids = b.column(0).to_pylist()
            for s in slices(b.column(1), 4 << 20):
                got = pc.value_counts(words_of(s, ids[s.lo : s.hi], cfg))
                yield pa.record_batch([got.field("values").cast(pa.string()), got.field("counts")], names=["word", "n"])

    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted = found.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= cfg.least_count)


# --- the composition ---------------------------------------------------------------------


class Acceptor:
    """Minimal acyclic acceptor of sorted distinct words. Word i is the i-th in order: a path's
    number is the sum of the words that its arcs pass by, so states carry no words."""

    def __init__(self, words: list[str]):
        self.final: list[bool] = []
        self.arcs: list[dict[str, tuple[int, int]]] = []  # letter -> (state, words passed by)
        self.size: list[int] = []
        known: dict[tuple, int] = {}
        path: list[list] = [[False, []]]  # open states of the last word: final, closed arcs
        letters: list[str] = []

        def close(depth: int) -> int:
            state = -1
            while len(path) > depth:
                final, arcs = path.pop()
                key = (final, *arcs)
                state = known.get(key, -1)
                if state < 0:
                    state = known[key] = len(self.final)
                    passed, out = int(final), {}
                    for c, to in arcs:
                        out[c] = (to, passed)
                        passed += self.size[to]
                    self.final.append(final)
                    self.arcs.append(out)
                    self.size.append(passed)
                if path:
                    path[-1][1].append((letters.pop(), state))
            return state

        last = ""
        for w in words:
            k, most = 0, min(len(w), len(last))
            while k < most and w[k] == last[k]:
                k += 1
            close(k + 1)
            for c in w[k:]:
                letters.append(c)
                path.append([False, []])
            path[-1][0] = True
            last = w
        self.start = close(0)


def one_edit_pairs(a: Acceptor) -> Iterator[tuple[int, int, int]]:
    """Accepted pairs of the composition as (word, word, how many in a row from these)."""
    final, arcs, size = a.final, a.arcs, a.size
    todo = [(a.start, 0)]  # equal so far: one state for both, and the number of its first word
    while todo:
        q, base = todo.pop()
        out = [(c, to, base + by) for c, (to, by) in arcs[q].items()]
        after = []  # pairs of states past the edit
        for i, (c, to, at) in enumerate(out):
            todo.append((to, at))
            if final[q] and final[to]:  # c added at the end
                yield base, at, 1
            for d, other, there in out[:i]:
                after.append((to, at, other, there))  # c for d
                if d in arcs[to]:  # c added before d
                    x, by = arcs[to][d]
                    after.append((x, at + by, other, there))
                if c in arcs[other]:  # d added before c
                    x, by = arcs[other][c]
                    after.append((to, at, x, there + by))
        while after:
            x, i, y, j = after.pop()
            if x == y:
                yield i, j, size[x]
                continue
            if final[x] and final[y]:
                yield i, j, 1
            small, large = (arcs[x], arcs[y]) if len(arcs[x]) <= len(arcs[y]) else (arcs[y], arcs[x])
            for c in small.keys() & large.keys():
                (s, m), (t, n) = arcs[x][c], arcs[y][c]
                after.append((s, i + m, t, j + n))


GROUP, LONG, SHORT = 0, 1, 2  # kinds of rows: a group's word; a word for, and without, a looked-up code point


class Best:
    """Number of near words and the best of them, for each word of a group."""

    def __init__(self, words: list[str], n: list[int], reverse: bool, depth: int):
        self.words, self.n, self.reverse, self.depth = words, n, reverse, depth
        self.near = [0] * len(words)
        self.best = [-1] * len(words)

    def pair(self, i: int, j: int) -> None:
        words, n, best = self.words, self.n, self.best
        if self.reverse and words[i][: self.depth] == words[j][: self.depth]:
            return  # the forward groups yield it
        for x, y in ((i, j), (j, i)):
            self.near[x] += 1
            b = best[x]
            if b < 0 or n[y] > n[b] or (n[y] == n[b] and words[y] < words[b]):
                best[x] = y

    def rows(self) -> Iterator[tuple[str, int, str, int]]:
        for w, near, b in zip(self.words, self.near, self.best, strict=True):
            if near:
                yield w, near, self.words[b], self.n[b]


def group_pairs(key: str, kind: list[int], tail: list[str], word: list[str], n: list[int], depth: int) -> Best:
    found = Best(word, n, key[0] == "r", depth)
    if kind[0] == GROUP:
        if len(word) > 1:
            for i, j, many in one_edit_pairs(Acceptor(tail)):
                for k in range(many):
                    found.pair(i + k, j + k)
        return found
    for i in range(len(word)):
        for j in range(i):
            # two variants differ in the looked-up code point; the word without it must differ there
            if kind[i] == LONG or tail[i] != tail[j]:
                found.pair(i, j)
    return found


def near_words(words: DataFrame, cfg: SpellingConfig = SpellingConfig()) -> DataFrame:
    """(word, n_near, best, best_n) of every word of ``words`` (word, n) that has a near word."""
    spark = words.sparkSession
    ship(spark)
    forward = words.select(F.lit("f").alias("side"), F.col("word").alias("body"), "word", "n")
    left = forward.unionByName(words.select(F.lit("r").alias("side"), F.reverse("word").alias("body"), "word", "n"))
    parts, depth = [], cfg.depth
    while True:
        left = left.withColumn("head", F.substring("body", 1, depth))
        group = F.concat_ws(" ", "side", F.lit(str(depth)), "head").alias("key")
        rows = [group, F.lit(GROUP).alias("kind"), F.substring("body", depth + 1, 2**31 - 1).alias("tail"), "word", "n"]
        big = stored(left.groupBy("side", "head").count().where(F.col("count") > cfg.group_words).select("side", "head"), "groups")
        if big.isEmpty():
            parts.append(left.select(*rows))
            break
        parts.append(left.join(big, ["side", "head"], "left_anti").select(*rows))
        hot = stored(left.join(big, ["side", "head"], "left_semi").drop("head"), "big-groups")
        place = F.sequence(F.lit(depth), F.least(F.lit(2 * depth - 1), F.length("body")))
        at = hot.withColumn("i", F.explode(place)).withColumn("c", F.expr("substring(body, i + 1, 1)"))
        rest = F.expr("concat(substring(body, 1, i), substring(body, i + 2, 2147483647))")
        lookup = lambda text: F.concat_ws(" ", "side", F.concat(F.lit("at"), "i"), text).alias("key")
        parts.append(at.where("i < length(body)").select(lookup(rest), F.lit(LONG).alias("kind"), F.col("c").alias("tail"), "word", "n"))
        parts.append(at.select(lookup(F.col("body")), F.lit(SHORT).alias("kind"), F.col("c").alias("tail"), "word", "n"))
        left = hot.where(F.length("body") >= 2 * depth)
        depth *= 2
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    out = "word string, near long, best string, best_n long"

    def search(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list, list, list] = ([], [], [], [])
        now, ready = None, []

        def close() -> None:
            if now is not None:
                ready.extend(group_pairs(now, *held, cfg.depth).rows())
                for column in held:
                    column.clear()

        def batch() -> pa.RecordBatch:
            columns = list(zip(*ready, strict=True))
            ready.clear()
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["word", "near", "best", "best_n"])

        for b in it:
            for key, *values in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if key != now:
                    close()
                    now = key
                for column, v in zip(held, values, strict=True):
                    column.append(v)
            if len(ready) > 20_000:
                yield batch()
        close()
        if ready:
            yield batch()

    # an explicit number of partitions: the rows are few bytes but much work
    dealt = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "key").sortWithinPartitions("key", "kind", "tail")
    found = dealt.mapInArrow(search, out).groupBy("word")
    first = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    return found.agg(F.sum("near").alias("n_near"), first.alias("b")).select("word", "n_near", F.col("b.best"), (-F.col("b.m")).alias("best_n"))


def spelling_variants(docs: DataFrame, cfg: SpellingConfig = SpellingConfig(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a word: its form (or null), the last form of the chain, and the counts."""
    words = stored(vocabulary(docs, cfg, id_col, text_col), "words")
    near = near_words(words, cfg)
    much = F.col("best_n") >= cfg.times * F.col("n")
    rated = words.join(near, "word", "left").select(
        "word", F.when(much, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(much, F.col("best_n")).alias("form_n"),
    )
    rated = stored(rated, "variants")
    # counts grow at least ``times``-fold along a chain, which bounds its length
    most, links = words.agg(F.max("n")).first()[0] or 0, 0
    while most >= cfg.times * cfg.least_count:
        most //= cfg.times
        links += 1
    last = rated.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(max(links - 1, 0).bit_length()):
        further = last.select(F.col("word").alias("root"), F.col("root").alias("further"))
        last = stored(last.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return rated.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
