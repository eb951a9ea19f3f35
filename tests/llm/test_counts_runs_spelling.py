"""Token counts, periodic runs and spelling variants against the library and brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from txrisk.llm import runs, spelling
from txrisk.llm import token_counts as tc
from txrisk.llm.bpe import default_tokenizer
from txrisk.llm.shared import table
from txrisk.llm.textvec import slices

SMALL = "/root/testdata/sf0.001"
# other columns carry names that the operators use themselves
SCHEMA = "doc_id long, text string, n long, word string, `key` string, kind int, start long, n_tokens string, root string"
TEXTS = [
    (1, None), (2, ""), (None, "a row without an id, without an id, without an id"), (3, "word"), (4, "same words " * 9), (4, "same words " * 9),
    (5, "long " * 40_000), (6, "\n\n \t\n"), (7, "日本語 のテキスト 😀 é <|endoftext|> x"), (8, "x" * 30_000), (-9, "a b c d e f g a b c d e f g a b c d e f g a b c d e f g a"),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(i, t, 1, "w", "k", 2, 3, "t", None) for i, t in TEXTS], SCHEMA)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_tokenizer())


@pytest.fixture(scope="module")
def machine():
    return tc.TokenMachine(default_tokenizer())


@pytest.fixture(scope="module")
def kinds():
    return np.frombuffer(zlib.decompress(tc.code_point_symbols(default_tokenizer())), np.uint8)


def lengths(library, texts):
    return [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]


def counted(texts, machine, kinds):
    return [n for s in slices(pa.array(texts, pa.string())) for n in tc.count_tokens(s, machine, kinds).tolist()]


# --- token counts ------------------------------------------------------------------------

MIXED = ["'", "s", "t", "re", "r", "e", "v", "l", "ll", " ", "  ", "\n", "\t", "0", "12", "!", "?", "é", "日", "a", "the", "in", "ing", "<|endoftext|>", "<|end", "😀", "٣", "Ⅷ", "\x85", " "]


def strings(rng):
    yield "".join(rng.choice(MIXED) for _ in range(rng.randint(0, 40)))
    yield "".join(rng.choice("abcdehilnorstu") for _ in range(rng.randint(1, 90)))
    yield "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x80, 0x800), rng.randrange(0x800, 0xD800), rng.randrange(0x10000, 0x11000)])) for _ in range(rng.randint(1, 30)))


def test_counts_equal_the_library(machine, kinds, library):
    rng = random.Random(1)
    texts = [None, "", "a  <|endoftext|>  b<|endoftext|><|endoftext|>", "<|endof", "text|> a", "don't've we'll 'r 're 'v 'l 'lx 'll ''s !'s 's's'", "a" * 50_000]
    texts += [t for _ in range(2500) for t in strings(rng)]
    assert counted(texts, machine, kinds) == lengths(library, texts)


def test_a_full_table_starts_anew(kinds, library, monkeypatch):
    monkeypatch.setattr(tc, "SLOTS", 1 << 12)
    monkeypatch.setattr(tc, "MAX_STATES", 1 << 9)
    small = tc.TokenMachine(default_tokenizer())
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdehilnorstu") for _ in range(rng.randint(1, 200))) for _ in range(400)]
    assert counted(texts, small, kinds) == lengths(library, texts)
    assert len(small.states) < 1 << 12


def test_chunk_maps_give_the_states_of_one_long_walk():
    symbols = np.random.default_rng(3).integers(0, tc.SYMBOLS, (37, tc.CHUNK)).astype(np.uint8)
    state, want = tc.START, []
    for chunk in symbols.tolist():
        want.append(state)
        for c in chunk:
            state = int(tc.STEP[state, c])
    assert tc.chunk_starts(symbols).tolist() == want


def test_token_counts_of_whole_tables(spark, edge, library):
    for docs in (edge, table(spark, SMALL, "documents")):
        texts = docs.select("doc_id", "text").toPandas()
        n = lengths(library, [t if isinstance(t, str) else "" for t in texts.text])
        size = [len(t.encode()) if isinstance(t, str) else 0 for t in texts.text]
        got = tc.token_counts(docs).toPandas()
        ids = [None if x != x else int(x) for x in texts.doc_id]
        assert list(zip([None if x != x else int(x) for x in got.doc_id], got.n_bytes, got.n_tokens, got.over_limit, strict=True)) == list(zip(ids, size, n, [x > 512 for x in n], strict=True))
    assert tc.token_counts(edge.limit(0)).count() == 0


def test_other_tokenizers_are_refused(tmp_path):
    import public_tokenizers

    with pytest.raises(ValueError):
        tc.TokenMachine(public_tokenizers.path("word_bpe_49k.json"))


# --- periodic runs -----------------------------------------------------------------------


def brute_runs(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            size = i - s + q
            part = w[s : s + size]
            if size >= max(6, 4 * q) and not any(all(part[k] == part[k + p] for k in range(size - p)) for p in range(1, q)):
                out.append((s, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic(rng):
    letters, n = rng.choice([1, 2, 2, 3, 5, 50]), rng.randint(0, rng.choice([10, 40, 120]))
    w = [b"%d" % rng.randrange(letters) for _ in range(n)]
    if rng.random() < 0.6 and n:
        a = rng.randrange(n)
        p = 1 + rng.randrange(max(1, (n - a) // 3))
        w = (w[:a] + w[a : a + p] * n)[:n] + [b"%d" % rng.randrange(letters) for _ in range(rng.randint(0, 6))]
        if rng.random() < 0.3:
            w = w + w[-20:] + w
    return w


def test_runs_equal_brute_force():
    rng = random.Random(4)
    for _ in range(60):
        texts = [periodic(rng) for _ in range(30)]
        assert runs.runs_of(texts) == [brute_runs(w) for w in texts]


def brute_row(doc_id, text):
    w = (text or "").encode().split()
    n = len(w)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w) if n < 4000 else runs.runs_of([w])[0]
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_of_whole_tables(spark, edge):
    assert [tuple(r) for r in runs.periodic_runs(edge).collect()] == [brute_row(i, t) for i, t in TEXTS]
    docs = [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").collect()]
    got = runs.op13_periodic_runs(spark, SMALL).collect()
    assert [tuple(r) for r in got] == [brute_row(i, t) for i, t in docs] and sum(r.n_runs > 0 for r in got) >= 10
    assert runs.periodic_runs(edge.limit(0)).count() == 0


def test_a_very_long_run_is_one_run():
    w = [b"x", b"y", b"z"] * 40_000
    assert runs.runs_of([w, [b"a"] * 50_000]) == [[(0, 120_000, 3)], [(0, 50_000, 1)]]


# --- spelling variants -------------------------------------------------------------------

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_variants(rows):
    seen = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            seen[w] += len(w) >= 7
    n = {w: k for w, k in seen.items() if k >= 2}
    near, by = defaultdict(set), defaultdict(list)
    for w in n:
        for i in range(len(w)):
            rest = w[:i] + w[i + 1 :]
            by[i, rest].append(w)
            if rest in n:
                near[w].add(rest)
                near[rest].add(w)
    for same in by.values():
        for a in same:
            near[a] |= {b for b in same if b != a}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= 10 * n[w]:
            form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(near[w]), n.get(form.get(w)))
    return out


def variants(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return {r.word: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("group_words", [20_000, 3, 1])
def test_variants_equal_brute_force(spark, group_words):
    rng = random.Random(5)
    base = ["".join(rng.choice("abÀé") for _ in range(rng.randint(6, 9))) for _ in range(30)]
    # a chain of forms: each word ten times as often as the one before
    chain = ["chainxxxx", "chainxxx", "chainxxa", "chainxba"]
    rows = [(None, None), (5, ""), (None, "ABCDEFGH abcdefgh ÄBCDEFGHI"), (6, " ".join(w for k, w in enumerate(chain) for _ in range(3 * 11**k)))]
    for d in range(100):
        words = [rng.choice(base) if rng.random() < 0.9 else rng.choice(base)[:-1] + rng.choice("abé") for _ in range(rng.randint(0, 200))]
        rows.append((d, " ".join(w if rng.random() < 0.5 else w.upper() for w in words)))
    want = brute_variants(rows)
    assert any(f and f != r for f, r, *_ in want.values())
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert variants(spelling.spelling_variants(df, spelling.SpellingConfig(group_words=group_words))) == want


def test_variants_of_whole_tables(spark, edge):
    docs = [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").collect()]
    assert variants(spelling.op12_spelling_variants(spark, SMALL)) == brute_variants(docs)
    assert variants(spelling.spelling_variants(edge)) == brute_variants(TEXTS)
    assert spelling.spelling_variants(edge.limit(0)).count() == 0


def test_the_acceptor_is_minimal_and_numbers_its_words():
    words = sorted({"".join(random.Random(i).choices("abc", k=i % 7)) for i in range(300)})
    a = spelling.Acceptor(words)
    rights = set()

    def walk(state, base, prefix):
        got = [(prefix, base)] if a.final[state] else []
        for c, (to, by) in a.arcs[state].items():
            got += walk(to, base + by, prefix + c)
        rights.add((state, frozenset(w[len(prefix) :] for w, _ in got)))
        return got

    assert sorted(walk(a.start, 0, "")) == [(w, i) for i, w in enumerate(words)]
    assert len({r for _, r in rights}) == len(rights) == len(a.final)
