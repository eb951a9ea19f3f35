"""The training-data operators: edge cases, brute force, round trips, held-out accuracy."""

import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402
from txrisk.llm import decontaminate as dc  # noqa: E402
from txrisk.llm import html_text, language, line_dedup, minhash, packing, passages, quality, token_files, toxicity  # noqa: E402
from txrisk.llm.bpe import Encoder, default_tokenizer  # noqa: E402
from txrisk.llm.elias_fano import EliasFano  # noqa: E402
from txrisk.llm.shared import workspace  # noqa: E402
from txrisk.llm.textvec import slices  # noqa: E402
from txrisk.session import ensure_checkpoint_dir  # noqa: E402

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `n_lines` string, `block` string"
RNG = np.random.default_rng(5)
VOCAB = [f"w{i}" for i in range(400)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(VOCAB, n))


BASE = prose(120)
EDGE = [
    (1, None, None, None, None, "x", "y"),
    (2, "", "en", "s", 0, None, None),
    (None, "a row without id", "en", "s", 1, None, None),
    (3, "word", "en", "s", 4, "", ""),
    (4, BASE, "en", "s", 1, None, None),
    (5, BASE, "en", "s", 1, None, None),
    (5, BASE, "en", "s", 1, None, None),
    (6, " ".join(BASE.split()[:118] + ["x", "y"]), None, "s", 1, None, None),
    (7, "long " * 40_000, "en", "s", 1, None, None),
    (8, "\n\n \t\n", "en", "s", 1, None, None),
    (9, "日本語 のテキスト 😀 é", "ja", "s", 1, None, None),
]
LABELS = [(4, 1, 0), (5, 0, 1), (5, 1, None), (None, 1, 1), (7, None, 0)]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, " ".join(BASE.split()[20:60])), (2, None), (3, "too short"), (None, prose(30))], "item_id long, text string")


def rows(df):
    return df.toPandas()


def test_edge_rows_and_empty_tables(edge, empty, labels, benchmark):
    operators = {
        "minhash": minhash.near_duplicates,
        "lines": line_dedup.line_dedup,
        "language": language.language_id,
        "quality": lambda d: quality.quality(d, labels),
        "toxicity": lambda d: toxicity.toxicity(d, labels),
    }
    for name, run in operators.items():
        assert len(rows(run(edge))) == len(EDGE), name
        assert len(rows(run(empty))) == 0, name
    assert rows(passages.repeated_passages(edge)).doc_id.tolist().count(4) == 1
    assert len(rows(passages.repeated_passages(empty))) == 0
    assert sorted(rows(dc.leaks(edge, benchmark)).doc_id.tolist()) == [4, 5, 5, 6]
    assert len(rows(dc.leaks(empty, benchmark))) == 0
    assert len(rows(dc.leaks(edge, benchmark.limit(0)))) == 0


def test_every_stage_keeps_columns_and_clean_rows(spark, edge, empty):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, edge, SMALL)
        assert out.columns == edge.columns, name
        assert 3 in rows(out).doc_id.tolist(), name
        assert len(rows(stage(spark, empty, SMALL))) == 0, name
    assert len(rows(corpus_pipeline.STAGES[-1][1](spark, empty, SMALL))) == 0


def brute_components(texts, k):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    part = {i: i for i in sets}
    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((part[i], part[j]))
                part = {x: a if y == b else y for x, y in part.items()}
    return {i: (len(sets[i]), part[i]) for i in sets}


@pytest.mark.parametrize("k", [2, 5])
def test_minhash_equals_brute_force_on_chains_of_edits(spark, k):
    rng = np.random.default_rng(k)
    texts, n = {}, 0
    for _ in range(12):
        words = prose(int(rng.integers(6, 150)), rng).split()
        for _ in range(int(rng.integers(1, 9))):
            texts[n] = " ".join(words)
            n += 1
            if rng.random() < 0.8:
                words = [w if rng.random() > 0.03 else str(rng.choice(VOCAB)) for w in words]
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = rows(minhash.near_duplicates(df, minhash.MinHashConfig(words=k)))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.itertuples()} == brute_components(texts, k)


def test_links_of_two_members_that_the_hub_does_not_have():
    hub = np.arange(100, dtype=np.int64)
    x = np.concatenate([hub[:70], np.arange(1000, 1030)])
    y = np.concatenate([hub[:70], np.arange(1000, 1028), [7, 5000]])
    table = pa.record_batch(
        [pa.array([0, 0]), pa.array([0, 0]), pa.array([0, 0]), pa.array([1, 2]), pa.array([1, 2]), pa.array([100, np.unique(y).size]), pa.array([100, 100]),
         pa.array([np.setdiff1d(hub, v) for v in (x, y)], pa.list_(pa.int64())), pa.array([np.setdiff1d(v, hub) for v in (x, y)], pa.list_(pa.int64()))],
        names=["a", "b", "second", "u", "component", "n", "hub_n", "lacks", "adds"],
    )
    u, v = minhash.links_across(table, 80)
    assert u.tolist() == [2] and v.tolist() == [1]


def test_compact_windows_hold_every_stretch_once():
    f = RNG.integers(1, 50, 60).astype(np.uint64) << np.uint64(32)
    left, c, right = passages.compact_windows(np.concatenate([[np.uint64(0)], f, [np.uint64(0)]]), 8)
    for i in range(1, 61):
        for j in range(i + 7, 61):
            assert ((left <= i) & (i <= c) & (c <= j) & (j <= right)).sum() == 1


def test_a_repeated_passage_is_found_and_clean_texts_are_not(spark):
    shared = prose(70)
    texts = [(i, f"{prose(90)} {shared if i % 3 == 0 else ''} {prose(60)}") for i in range(30)]
    got = rows(passages.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")))
    assert sorted(got.doc_id) == list(range(0, 30, 3))
    assert (got.n_words >= 70).all() and (got.n_links > 0).all() and (got.first_doc <= got.doc_id).all()


def test_leaks_equal_brute_force(spark):
    rng = np.random.default_rng(9)
    items = [(i, prose(int(rng.integers(5, 90)), rng)) for i in range(40)]
    docs = []
    for d in range(60):
        words = prose(int(rng.integers(0, 300)), rng).split()
        if d % 2:
            own = items[d % 40][1].split()
            if d % 4 == 1 and len(own) > 50:
                own[25] = "changed"
            words[len(words) // 2 : len(words) // 2] = own
        docs.append((d, " ".join(words)))
    sh = lambda t: [tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)]
    want = set()
    for d, t in docs:
        a = sh(t)
        for i, x in items:
            b = Counter(sh(x))
            n = sum(b.values())
            best = 0
            for s in range(max(1, len(a) - n + 1)):
                own = Counter(a[s : s + n])
                both = sum((own & b).values())
                best = max(best, both / max(1, n + sum(own.values()) - both))
            if best >= 0.8:
                want.add((d, i))
    got = rows(dc.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    assert set(zip(got.doc_id, got.item_id, strict=True)) == want


def test_elias_fano_round_trip():
    for n in (0, 1, 2, 300, 5000):
        v = np.sort(RNG.integers(0, 10**6, n))
        e = EliasFano.from_bytes(EliasFano.build(v).to_bytes())
        assert e.decode().tolist() == v.tolist()
        assert [e[i] for i in range(0, n, 7)] == v[::7].tolist()


def test_encoder_equals_the_library():
    texts = ["", "a b", " a", "a  b", "a \n b", "<|endoftext|> x", "¿ que", "a ", "it's ok\n\n z\t q", "日本 語　x  y", "x" * 3000]
    enc = Encoder(default_tokenizer())
    for s in slices(pa.array(texts)):
        ids, first = enc.encode(s)
        for i in range(s.rows):
            assert ids[first[i] : first[i + 1]].tolist() == enc.whole(texts[s.lo + i]).tolist()


def test_token_files_and_pieces_of_edge_rows(spark, edge, empty):
    path = workspace(spark, "t")
    token_files.write_tokens(edge, path)
    digest = rows(token_files.read_tokens(spark, path, digest=True)).sort_values("start")
    full = rows(token_files.read_tokens(spark, path))
    crc = [zlib.crc32(np.array(x, "<u4").tobytes()) for x in full.sort_values("start").ids]
    assert digest.ids_crc32.tolist() == crc and len(digest) == len(EDGE)
    assert (digest.start.to_numpy() == np.cumsum(digest.n_tokens) - digest.n_tokens).all()
    other = workspace(spark, "t")
    token_files.write_tokens(empty, other)
    assert token_files.read_tokens(spark, other).count() == 0
    p = rows(packing.best_fit_packing(edge)).sort_values(["sequence_id", "offset"])
    assert p.length.sum() == digest.n_tokens.sum()
    ends = p.offset + p.length
    assert (ends.groupby(p.sequence_id).max() <= 2048).all()
    assert (ends.groupby(p.sequence_id).shift(fill_value=0) == p.offset).all()


def test_every_capacity_holds():
    n = RNG.integers(1, 2048, 500)
    for rule in ("norm", "dot"):
        where, _ = packing.best_fit(n, packing.PackConfig(packing.Capacity(2048, 3, 2_000_000), (1, 1, 1), rule))
        by = pd.DataFrame({"w": where, "n": n, "q": n * n}).groupby("w")
        alone = by.n.count() == 1  # a piece over a capacity by itself still needs a place
        assert ((by.n.sum() <= 2048) & (by.n.count() <= 3) & ((by.q.sum() <= 2_000_000) | alone)).all()


def test_falling_features_never_raise_the_score():
    x = RNG.random((800, len(quality.FEATURES)))
    j = quality.FEATURES.index("symbols")
    y = (x[:, j] + 0.3 * RNG.standard_normal(800) < 0.5).astype(float)
    forest = quality.fit(x, y, quality.GBTConfig())
    line = np.repeat(x[:50], 20, axis=0)
    line[:, j] = np.tile(np.linspace(0, 1, 20), 50)
    assert (np.diff(forest.score(line).reshape(50, 20), axis=1) <= 1e-12).all()


@pytest.mark.parametrize(
    ("page", "text"),
    [(None, ""), ("", ""), ("plain  text", "plain text"), ("<p>a<p>b", "a b"), ("<script>x", ""), ("<p>one<b>bold</b> &lt;x&gt;</p><!-- c", "onebold <x>"),
     ("<nav>menu</nav><article><h1>T</h1><p>Long text of it</p></article><footer>f</footer>", "T Long text of it"),
     ("<div class=sidebar>x y</div><div><p>Text that is long.</p><p>More &amp; more text.</p></div><div id=comments><p>reader</p></div>", "Text that is long. More & more text.")],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas()
    lang = rows(language.op4_language_id(spark, sf)).merge(docs[["doc_id", "lang"]], on="doc_id").query("held_out and lang.notna()")
    assert (lang.lang == lang.lang_pred).mean() > 0.95
    base = rows(quality.op5_quality_rules(spark, sf)).set_index("doc_id")
    for r in docs.head(150).itertuples():
        w = (r.text or "").encode().split()
        c = Counter(zip(w, w[1:], w[2:], strict=False))
        mark = {k + j for k in range(len(w) - 2) if c[(w[k], w[k + 1], w[k + 2])] > 1 for j in range(3)}
        assert base.loc[r.doc_id, ["n_words", "n_repeat_words"]].tolist() == [len(w), len(mark)]


def near_copies(a, b, k=5, least=46):
    """Words of a and b in stretches (from one shared shingle to another) of 50 words and similarity 0.8."""
    sa, sb = ([tuple(t[i : i + k]) for i in range(len(t) - k + 1)] for t in (a, b))
    ha, hb = ([i for i, x in enumerate(s) if x in set(o)] for s, o in ((sa, sb), (sb, sa)))
    got_a, got_b = set(), set()
    for i in ha:
        for e in (x + 1 for x in ha if x + 1 - i >= least):
            left = set(sa[i:e])
            for u in hb:
                if sb[u] not in left:
                    continue
                for v in (x + 1 for x in hb if x + 1 - u >= least and sb[x] in left):
                    right = set(sb[u:v])
                    if {sa[i], sa[e - 1]} <= right and len(left & right) >= 0.8 * len(left | right):
                        got_a |= set(range(i, e + k - 1))
                        got_b |= set(range(u, v + k - 1))
    return got_a, got_b


def test_edited_passages_equal_brute_force(spark):
    rng = np.random.default_rng(21)
    texts, n = {}, 0
    for size, edits in ((60, [30]), (55, [25]), (70, [35]), (85, [40]), (66, [20, 47]), (58, [14, 28, 42]), (62, ["add", 30])):
        own = prose(size, rng).split()
        copy = list(own)
        if edits[0] == "add":
            copy[30:30] = ["new", "words"]
        for i in edits:
            if i != "add":
                copy[i] = "changed"
        for words in (own, copy):
            texts[n] = prose(25, rng).split() + words + prose(25, rng).split()
            n += 1
    want = {}
    for a in range(0, n, 2):
        want[a], want[a + 1] = near_copies(texts[a], texts[a + 1])
    got = {i: set() for i in texts}
    for r in rows(passages.repeated_passages(spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string"))).itertuples():
        got[r.doc_id] |= set(range(r.start_word, r.start_word + r.n_words))
    assert got == want and sum(bool(x) for x in want.values()) >= 10


def test_every_place_of_a_passage_in_the_smallest_document(spark):
    rng = np.random.default_rng(31)
    shared, alone = prose(70, rng), prose(60, rng)
    texts = [(0, f"{shared} {prose(30, rng)} {shared} {alone} {prose(30, rng)} {shared} {alone}"), (1, f"{prose(20, rng)} {shared}"), (2, prose(90, rng)), (3, f"{shared} {prose(40, rng)} {shared}")]
    got = rows(passages.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)))
    assert sorted(got[got.doc_id == 0].start_word) == [0, 100, 260] and (got[got.doc_id == 0].n_links == 2).all()
    assert len(got[got.doc_id == 3]) == 2 and len(got[got.doc_id == 1]) == 1 and got.n_words.between(70, 76).all()


@pytest.mark.parametrize("parts", [1, 8])
def test_siblings_of_a_similar_centre_are_linked(spark, parts):
    """Three versions of 100 words, each two of them similar: the star has two of the three links."""
    rng = np.random.default_rng(71)
    texts = []
    for g in range(8):
        for k, place in enumerate((None, 30, 70)):
            own = [f"g{g}x{w}" for w in range(100)]
            if place:
                own[place] = "changed"
            texts.append((10 * g + k, " ".join([prose(30, rng), *own, prose(30, rng)])))
    got = rows(passages.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string").repartition(parts)))
    assert set(got.doc_id) == {i for i, _ in texts} and len(got) == len(texts)
    assert (got.n_links == 2).all()


@pytest.mark.parametrize(("parts", "block"), [(1, 1024), (64, 1024), (8, 16)])
def test_siblings_of_a_centre_that_fails(spark, monkeypatch, parts, block):
    """60 passages of 52 words: the smallest document holds 45 of the words, which is too little,
    two others hold all. And a crowd of 300 with one line of 20 words, three of which share the
    text around it too."""
    monkeypatch.setattr(passages, "CLASS_BLOCK", block)
    rng = np.random.default_rng(51)
    within = lambda *parts: " ".join([prose(30, rng), *(" ".join(p) for p in parts), prose(30, rng)])
    texts, want = [], set()
    for g in range(60):
        whole = [f"g{g}x{w}" for w in rng.integers(0, 300, 52)]
        texts += [(10 * g, within(whole[:45])), (10 * g + 1, within(whole)), (10 * g + 2, within(whole))]
        want |= {10 * g + 1, 10 * g + 2}
    line = [f"line{w}" for w in range(20)]
    shared = [[f"s{v}" for v in rng.integers(0, 300, 18)] for _ in range(2)]
    for k in range(300):
        before, after = shared if k % 100 == 50 else [[f"c{k}v{v}" for v in rng.integers(0, 300, 18)] for _ in range(2)]
        texts.append((1000 + k, within(before, line, after)))
    want |= {1050, 1150, 1250}
    got = rows(passages.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string").repartition(parts)))
    assert set(got.doc_id) == want and len(got) == len(want)
    assert got.n_words.between(50, 62).all()


def test_places_shared_by_blocks_of_a_key():
    """Shared shingles of every two rows, and the partners chosen, against sets."""
    rng = np.random.default_rng(61)
    around = [rng.integers(0, 90, 60).astype(np.uint32) for _ in range(40)]
    row = np.repeat(np.arange(40), 60)
    held, number, good = passages._shared(np.zeros(40, np.int64), row, np.concatenate(around), 40)
    near = passages._near_rows(held, number, 40)
    for i in range(40):
        assert good[i] == (len({x for x in around[i].tolist() if any(x in around[j] for j in range(40) if j != i)}) >= passages.NEAR)
        for j in range(40):
            if i != j:
                assert near[i, j] == len(set(around[i].tolist()) & set(around[j].tolist()))


@pytest.mark.parametrize("wide", [True, False])
@pytest.mark.parametrize("size", [1, 3, 16, 17, 60])
def test_near_pairs_of_groups_equal_sets(size, wide):
    rng = np.random.default_rng(size)
    group = np.repeat(np.arange(120 // size), size)
    around = [rng.choice(90, rng.integers(45, 80), replace=False).astype(np.uint32 if wide else np.uint16) for _ in group]
    least = np.full(group.size, passages.NEAR)
    i, j = passages._near_pairs(group, pa.array([x.tobytes() for x in around], pa.binary()), np.full(group.size, wide), least)
    near = lambda a, b: group[a] == group[b] and len(set(around[a].tolist()) & set(around[b].tolist())) >= passages.NEAR
    want = {(a, b) for b in range(group.size) for a in range(b) if near(a, b)}
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == want and i.size == len(want) and (size == 1 or want)


def test_distinct_shingles_of_stretches():
    rng = np.random.default_rng(81)
    h = np.concatenate([rng.integers(0, 60, 300), np.arange(200), np.tile(np.arange(6), 50)]).astype(np.uint32)
    low = rng.integers(0, h.size, 200)
    high = np.minimum(low + rng.integers(1, 2 * passages.AROUND + 2, 200), h.size)
    assert passages._distinct(h, low, high).tolist() == [len(set(h[a:b].tolist())) for a, b in zip(low, high, strict=True)]


def test_16_bit_shingles_miss_no_pair(spark):
    """What a place's shingles lose by having 16 bits is taken off ``least``."""
    rng = np.random.default_rng(101)
    texts = [(i, prose(160, rng)) for i in range(40)]
    _, h, first = passages.shingles(passages.words(next(slices(pa.array([t for _, t in texts]))), lower=True), passages.WORDS, whole_if_short=False)
    at = 70
    places = []
    for i in range(40):
        x = int(h[first[i] + at])
        key = int((passages.mix((passages.mix(np.array([x], np.uint64) ^ passages._SALTS[0]) | passages.U(1 << 63))) & ~passages.U(7)).view(np.int64)[0])
        places += [(key, i, at, True, n) for n in (2, 200)]
    got = rows(passages.surroundings(spark.createDataFrame(places, "key long, doc_id long, at long, open boolean, n long"), spark.createDataFrame(texts, "doc_id long, text string")))
    assert len(got) == 80 and (got.wide == (got.n > passages.NARROW)).all()
    for r in got.itertuples():
        low, high = max(first[r.doc_id] + at - passages.AROUND, first[r.doc_id]), min(first[r.doc_id] + at + passages.AROUND + 1, first[r.doc_id + 1])
        own = h[low:high] >> passages.U(32 if r.wide else 48)
        assert np.frombuffer(r.around, np.uint32 if r.wide else np.uint16).tolist() == own.tolist()
        assert r.least == passages.NEAR - len(set((h[low:high] >> passages.U(32)).tolist())) + len(set(own.tolist()))


def test_members_of_a_large_key_without_company_leave(spark, monkeypatch):
    monkeypatch.setattr(passages, "CLASS_BLOCK", 16)
    rng = np.random.default_rng(91)
    line, shared = np.arange(20), np.arange(1000, 1030)
    around = [np.concatenate([line, shared if k < 3 else rng.integers(1 << 20, 1 << 32, 30)]).astype(np.uint32).tobytes() for k in range(100)]
    rows_ = [(7, k, 5, True, 100, True, 41, around[k]) for k in range(100)] + [(8, k, 5, True, 2, True, 41, around[50 + k]) for k in range(2)]
    got = rows(passages.in_blocks(spark.createDataFrame(rows_, passages.MEMBER)))
    assert sorted(zip(got.key, got.doc_id, got.blocks, strict=True)) == [(7, 0, 1), (7, 1, 1), (7, 2, 1), (8, 0, 1), (8, 1, 1)]


def test_bits_of_pairs_and_steps_between_ids():
    rng = np.random.default_rng(101)
    group = np.repeat(np.arange(7), [2, 9, 1, 30, 8, 17, 3])
    i, j = np.nonzero(np.triu(group[:, None] == group, 1) & (rng.random((70, 70)) < 0.4))
    first, begin, data = passages._bits(group, i, j)
    assert first.tolist() == [0, 2, 11, 12, 42, 50, 67, 70] and begin[-1] == data.size
    got = passages._unbits(first, data)
    assert sorted(zip(*(x.tolist() for x in got), strict=True)) == sorted(zip(i.tolist(), j.tolist(), strict=True))
    some = np.array([1, 5, 20, 45, 60])
    got = passages._unbits(first, data, some)
    assert sorted(zip(*(x.tolist() for x in got), strict=True)) == sorted((a, b) for a, b in zip(i.tolist(), j.tolist(), strict=True) if a in some)
    for far in (1 << 7, 1 << 15, 1 << 40, (1 << 63) - 1):
        place, other = rng.integers(0, 5, 300), rng.integers(-far, far, 300)
        doc, start, end, least, more, width = passages._spans(place, place * 2, place * 3, other)
        assert doc.to_pylist() == list(range(5)) and end.to_pylist() == [0, 3, 6, 9, 12]
        row, to = passages._others(least.to_numpy(), more, width.to_numpy())
        assert sorted(zip(row.tolist(), to.tolist(), strict=True)) == sorted(set(zip(place.tolist(), other.tolist(), strict=True)))


@pytest.mark.parametrize("size", [1 << 20, 6000])
def test_a_text_goes_once_to_the_cell_of_its_pairs(spark, monkeypatch, size):
    """40 documents with one passage and nothing else in common: 780 pairs, and 40 texts to read them
    in, or in blocks of a few documents a text for each block."""
    monkeypatch.setattr(passages, "CELL_BYTES", size)
    seen, real = [], passages.passages_of

    def spy(parts, lists, texts):
        seen.append(rows(parts.select("cell", "low", "high", F.explode("docs").alias("doc_id")).union(lists.select("cell", "low", "high", F.explode(F.array("a", "b")))).distinct()))
        return real(parts, lists, texts)

    monkeypatch.setattr(passages, "passages_of", spy)
    rng = np.random.default_rng(103)
    passage = " ".join(f"p{k}" for k in range(68))
    own = lambda: " ".join(f"w{x}" for x in rng.integers(0, 1 << 40, 60))
    texts = [(i, f"{own()} {passage} {own()}") for i in range(40)]
    got = rows(passages.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")))
    assert sorted(got.doc_id) == list(range(40)) and (got.n_links == 39).all() and (got.first_doc == 0).all() and (got.start_word == 60).all() and (got.n_words == 68).all()
    blocks = 1 + max(x.high.max() for x in seen)
    assert sum(len(x) for x in seen) <= 40 * blocks
    assert (blocks == 1) == (size == 1 << 20)


def test_copies_inside_documents_whatever_way_their_rows_are_dealt(spark, tmp_path):
    """A union of what is dealt by doc_id is not dealt by it again, so the rows of a document may
    be apart where its parts are put into fewer partitions, each in its own way."""
    spans, want = [], set()
    for d in range(200):
        for at in range(0, 20_000 if d % 10 == 0 else 200, 200):
            spans += [(d, at, at + 60, d, b"", 1, at + 100, at + 160), (d, at + 100, at + 160, d, b"", 1, at, at + 60)]
        spans += [(d, at, at + 60, 1000 + k, b"", 1, None, None) for k, at in enumerate(range(0, 200, 200))]
        want |= {(d, 0), (d, 100)}
    conf = {"adaptive.advisoryPartitionSizeInBytes": "8k", "adaptive.coalescePartitions.parallelismFirst": "false", "adaptive.coalescePartitions.minPartitionSize": "1k", "autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(f"spark.sql.{k}", None) for k in conf}
    spark.createDataFrame(spans, passages.SPAN).repartition(4).write.parquet(f"{tmp_path}/spans")
    for k, v in conf.items():
        spark.conf.set(f"spark.sql.{k}", v)
    try:
        got = rows(passages.own_copies(spark.read.parquet(f"{tmp_path}/spans")))
    finally:
        for k, v in before.items():
            spark.conf.unset(f"spark.sql.{k}") if v is None else spark.conf.set(f"spark.sql.{k}", v)
    assert set(zip(got.doc_id.tolist(), got.start_word.tolist(), strict=True)) == want


def test_the_steps_of_repeated_passages_leave_no_files(spark):
    """Of the stored tables only the last, which the result is read from, is there at the end."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    text, before = prose(120), spark.conf.get(name, None)
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    there = set(folder.iterdir())
    out = passages.repeated_passages(spark.createDataFrame([(i, f"{prose(30)} {text}") for i in range(3)], "doc_id long, text string"))
    assert len(rows(out)) == 3
    assert [x.name.split("-")[0] for x in set(folder.iterdir()) - there] == ["spans"]
    assert spark.conf.get(name, None) == before


def test_blocks_of_the_benchmark_do_not_change_the_similarity(spark, monkeypatch):
    rng = np.random.default_rng(41)
    common = prose(30, rng)
    items = [(i, f"{common} {prose(20, rng)}") for i in range(12)] + [(50, prose(40, rng))] * 2
    docs = []
    for d, (_, t) in enumerate(items):
        w = t.split()
        w[[3, 20, 40, 5][d % 4]] = "changed"
        docs.append((d, f"{prose(20, rng)} {' '.join(w)} {prose(20, rng)}"))
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one = rows(dc.leaks(*frames)).sort_values(["doc_id", "item_id", "similarity"])
    monkeypatch.setattr(dc, "BLOCK_CHARS", sum(len(t) for _, t in dict(items).items()) // 3 + 1)
    many = rows(dc.leaks(*frames)).sort_values(["doc_id", "item_id", "similarity"])
    assert len(one) >= 8 and one.astype(float).round(9).to_numpy().tolist() == many.astype(float).round(9).to_numpy().tolist()


PARA = "A long sentence of the article that a reader wants to see in full. "


@pytest.mark.parametrize(
    ("inner", "kept"),
    [('<div class="overflow-hidden"><p>KEY text</p></div>', True), ('<p title="hidden gems">KEY text</p>', True), ('<a href="/the-hidden-cost">KEY text</a>', True),
     (f'<section id="discussion"><h2>KEY</h2><p>{PARA * 3}</p></section>', True), ('<h2 id="legal">KEY</h2>', True),
     ('<div class="article-header"><h1>KEY</h1></div>', True), (f'<div class="related-work"><p>KEY {PARA}</p></div>', True),
     ('<p hidden>KEY</p>', False), ('<p hidden="until-found">KEY</p>', True), ('<p aria-hidden="true">KEY</p>', False), ('<p style="color:red; display: none">KEY</p>', False),
     ('<div class="advert">KEY</div>', False), ('<div class="newsletter-signup">KEY</div>', False), ('<section class="comments"><ul><li><a href="#">KEY</a></li><li><a href="#">b</a></li></ul></section>', False)],
)
def test_an_article_keeps_what_is_not_furniture(inner, kept):
    page = f"<html><body><nav>menu</nav><div class='site-footer'>foot</div><article><p>{PARA * 4}</p>{inner}<p>{PARA * 4}</p></article></body></html>"
    text = html_text.main_text(page)
    assert ("KEY" in text) == kept and "foot" not in text and text.count(PARA.strip()) >= 8
