"""Periodic runs of words by maximal pairs.

A run with period q that starts at s and has length q + l is a maximal pair: the words from s
and from s + q agree for exactly l words and the words before them differ. So runs need no
extension; they are the maximal pairs whose distance q is small against l.

The suffixes of every text are sorted by prefix doubling (all texts of a batch at once, only
suffixes that are still equal to others are sorted again), the lengths of common prefixes
come from the kept rounds, and the LCP-interval tree is walked bottom-up: children of an
interval with common prefix l are merged, the smaller list into the larger. Lists hold
positions in order with the class of the word on the left. Of the positions that share l words,
only neighbours can be the next copy one period on (two copies that are at most l / 3 apart
lie a multiple of the smallest period apart), so every merged position is paired with the two
next to it if their classes differ and the distance q fulfils 3 q <= l and q + l >= 6. A pair a
multiple of q apart spans the same stretch; the smallest distance of a stretch is kept.

Positions that cannot be in such a pair are not sorted in: the l words of a pair hold l - 4
places whose five words recur within q <= l / 3 words, so a place whose five words recur only
farther away than a third of its stretch of such places (and four) is left out.

Defined cases: a null or empty text has no words and no runs; a null doc_id stays null and its
text is read as it is; very long texts are read whole (their words in one task); repeated rows
are judged each; equal lengths of the longest run go to the smallest start, then period; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm.shared import ship, table
from txrisk.llm.textvec import mix

LEAST, POWER = 6, 4  # a run has at least so many words, and so many periods
SEED = LEAST - 1  # the shortest common prefix of a pair (period 1)
BATCH_WORDS = 1 << 18

Run = tuple[int, int, int]  # start, length, period


def sort_suffixes(word: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(order, ranks): all suffixes sorted; ``ranks[k]`` tells apart the first 2**k words.

    ``word`` differs between texts, and ``stop`` is where the text of each place ends."""
    n = word.size
    order = np.argsort(word, kind="stable")
    head = np.concatenate([[True], word[order[1:]] != word[order[:-1]]])
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    ranks, width = [rank.copy()], 1
    while True:
        alone = head & np.append(head[1:], True)
        slots = np.flatnonzero(~alone)  # of the order: places equal to others so far
        if not slots.size:
            return order, ranks
        at = order[slots]
        then = np.where(at + width < stop[at], rank[np.minimum(at + width, n - 1)], -1).astype(np.int64)
        key = rank[at].astype(np.int64) * (n + 1) + then + 1
        by = np.argsort(key, kind="stable")
        key = key[by]
        order[slots] = at[by]
        head[slots[1:]] |= key[1:] != key[:-1]
        new = np.maximum.accumulate(np.where(head[slots], slots, 0))
        rank[at[by]] = new
        ranks.append(rank.copy())
        width *= 2


def common_prefixes(a: np.ndarray, b: np.ndarray, stop: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """Words in common from places ``a`` and ``b`` (of one text, not equal)."""
    n = np.zeros(a.size, np.int64)
    last = stop.size - 1
    for k in range(len(ranks) - 1, -1, -1):
        x, y = a + n, b + n
        same = (x < stop[a]) & (y < stop[b])
        same &= ranks[k][np.minimum(x, last)] == ranks[k][np.minimum(y, last)]
        n[same] += 1 << k
    return n


def near_repeats(word: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Places that may be in a qualifying pair (see above), in order."""
    n = word.size - SEED + 1
    if n < 2:
        return np.zeros(0, np.int64)
    h = mix(word[:n].astype(np.uint64))
    for j in range(1, SEED):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) ^ word[j : n + j].astype(np.uint64))
    order = np.argsort(h, kind="stable")
    a, b = order[:-1], order[1:]
    again = (h[a] == h[b]) & (text[a] == text[b])
    far = np.zeros(n, np.int64)  # how far on the same five words come again, 0 for never
    far[a[again]] = (b - a)[again]
    while True:
        on = far > 0
        edge = np.flatnonzero(np.diff(np.concatenate([[False], on, [False]]).astype(np.int8)))
        # texts are not told apart here: a longer stretch only keeps more places
        room = np.repeat(edge[1::2] - edge[::2], edge[1::2] - edge[::2])
        place = np.flatnonzero(on)
        drop = place[3 * far[place] > room + SEED - 1]
        if not drop.size:
            break
        far[drop] = 0
    return np.unique(np.concatenate([place, place + far[place]]))


def maximal_pairs(place: np.ndarray, lcp: np.ndarray, left: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, distance, common words) of the pairs among sorted suffixes ``place`` that may be
    runs; ``lcp[i]`` is that of suffixes i and i + 1, ``left`` the class of the word before."""
    found = []
    ups = np.flatnonzero(lcp >= SEED)
    ups = ups[np.argsort(-lcp[ups], kind="stable")]
    lists: dict[int, list[int]] = {}  # by the first and by the last suffix of a block
    first: dict[int, int] = {}  # last suffix of a block -> first one
    suffix, before = place.tolist(), left.tolist()
    for i, n in zip(ups.tolist(), lcp[ups].tolist(), strict=True):
        lo = first.pop(i, i)  # the block that ends with i, and the one that begins with i + 1
        one = lists.pop(lo, None) or [suffix[i]]
        two = lists.pop(i + 1, None) or [suffix[i + 1]]
        hi = i + len(two)
        small, large = (one, two) if len(one) <= len(two) else (two, one)
        reach = n // 3
        for x in small:
            k = bisect_left(large, x)
            if k and (q := x - large[k - 1]) <= reach and q + n >= LEAST and before[x] != before[x - q]:
                found.append((x - q, q, n))
            if k < len(large) and (q := large[k] - x) <= reach and q + n >= LEAST and before[x] != before[x + q]:
                found.append((x, q, n))
        if len(small) == 1:
            large.insert(k, small[0])
        else:
            large += small
            large.sort()  # merges two runs in order
        lists[lo], first[hi] = large, lo
    return found


def runs_of(texts: list[list[bytes]]) -> list[list[Run]]:
    """All runs of every text (a list of words), by start and period."""
    out: list[list[Run]] = [[] for _ in texts]
    size = np.array([len(t) for t in texts], np.int64)
    begin = np.concatenate([[0], np.cumsum(size)])
    known: dict[bytes, int] = {}
    word = np.fromiter((known.setdefault(w, len(known)) for t in texts for w in t), np.int64, int(begin[-1]))
    text = np.repeat(np.arange(size.size), size)
    place = near_repeats(word, text)
    if not place.size:
        return out
    # sort the suffixes of the texts that hold such places
    kept = np.zeros(size.size, bool)
    kept[text[place]] = True
    here = kept[text]
    new = np.cumsum(here) - 1
    place, stop = new[place], (new[begin[1:] - 1] + 1)[text[here]]
    own = text[here]
    word = word[here] + own * (len(known) + 1)
    start = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1])
    order, ranks = sort_suffixes(word, stop)
    wanted = np.zeros(word.size, bool)
    wanted[place] = True
    order = order[wanted[order]]
    same = own[order[:-1]] == own[order[1:]]
    lcp = np.where(same, common_prefixes(order[:-1], order[1:], stop, ranks), 0)
    left = np.empty(word.size, np.int64)
    left[1:] = word[:-1]
    left[start] = -1 - np.arange(start.size)  # nothing on the left differs from every word
    best: dict[tuple[int, int], int] = {}
    for s, q, n in maximal_pairs(order, lcp, left):
        span = (s, q + n)
        best[span] = min(q, best.get(span, q))
    base = np.zeros(size.size, np.int64)
    base[own[start]] = start
    for (s, n), q in best.items():
        t = int(own[s])
        out[t].append((s - int(base[t]), n, q))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words that are searched: one text in ten (by a hash of its id) goes round in its tail."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times = -(-(n - a) // p)
    return words[:a] + (words[a : a + p] * times)[: n - a]


def collapsed(words: list[bytes], found: list[Run]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not found:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for s, n, q in found:
        drop[s + q] += 1
        drop[s + n] -= 1
    stay = (np.cumsum(drop[:-1]) == 0).tolist()
    return [w for w, k in zip(words, stay, strict=True) if k]


OUT = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def digest(words: list[bytes], found: list[Run]) -> tuple:
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    power = 1000 * best[1] // best[2] if found else None
    return len(found), *best, power, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, found))).hexdigest()


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", change=planted) -> DataFrame:
    """One row a text: its runs, the longest one, and digests of all runs and of the text
    without their repeats. ``change(words, doc_id)`` gives the words that are searched."""
    ship(docs.sparkSession)
    names = [x.split()[0] for x in OUT.split(", ")]
    schema = pa.schema([(n, pa.string() if n.endswith("sha256") else pa.int64()) for n in names])

    def search(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        texts: list[list[bytes]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            got = [digest(w, r) for w, r in zip(texts, runs_of(texts), strict=True)]
            return pa.record_batch([pa.array(c, f.type) for c, f in zip([ids, *zip(*got, strict=True)], schema, strict=True)], schema=schema)

        for b in it:
            for i, raw in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()), strict=True):
                words = (raw.as_py() or b"").split()  # bytes: the six ASCII white space characters
                ids.append(i)
                texts.append(change(words, i))
                held += len(words) + 1
                if held >= BATCH_WORDS:
                    yield flush()
                    ids, texts, held = [], [], 0
        if ids:
            yield flush()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(search, OUT)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"))
