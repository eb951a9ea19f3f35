"""op8 by select and document, against the library; op4 with many languages; op6 held out."""

import json

import numpy as np
import pytest
from tokenizers import Tokenizer

from txrisk.llm import language, token_files, toxicity
from txrisk.llm.bpe import default_tokenizer
from txrisk.llm.elias_fano import EliasFano
from txrisk.llm.shared import workspace

RNG = np.random.default_rng(77)


@pytest.mark.parametrize("n", [1, 2, 255, 256, 257, 4000])
def test_ranges_and_predecessors_by_select(n):
    v = np.sort(RNG.integers(0, 50 * n, n))
    e = EliasFano.from_bytes(EliasFano.build(v).to_bytes())
    for _ in range(60):
        a, b = sorted(RNG.integers(0, n + 1, 2).tolist())
        assert e.values(a, b).tolist() == v[a:b].tolist()
        a, x = int(RNG.integers(0, n)), int(RNG.integers(0, 50 * n))
        assert e.last_at_most(x, a) == max(a, int(np.searchsorted(v, x, "right")) - 1)


def test_random_documents_of_shards_equal_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    path = workspace(spark, "t")
    token_files.write_tokens(docs, path, shards=3)
    texts, lib = dict(docs.collect()), Tokenizer.from_file(default_tokenizer())
    store, root = token_files.open_path(path)
    with store.open_input_stream(f"{root}/_manifest.json") as f:
        shards = [token_files.ShardFile(f"{path}/{m['name']}") for m in json.loads(f.read())]
    assert sum(len(s) for s in shards) == len(texts)
    for s in shards:
        for i in RNG.integers(0, len(s), 25).tolist():
            want = lib.encode(texts[s.doc_ids(i, i + 1)[0].as_py()] or "", add_special_tokens=False).ids
            assert s.document(i).tolist() == [*want, 0]


def test_every_language_is_learnt(spark):
    """More languages than a small sample has room for: one document of each at least."""
    rows = [(i, f"{chr(0x4E00 + 40 * (i % 250))} {chr(0x4E00 + 40 * (i % 250))} " * 20, f"x{i % 250:03d}") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    cfg = language.LangConfig(sample=250, steps=60)
    model = language.train(docs, cfg)
    assert sorted(v for langs in model.languages.values() for v in langs) == sorted({r[2] for r in rows})


def test_held_out_toxicity(spark):
    sf = "/root/testdata/sf0.1"
    got = toxicity.op6_toxicity(spark, sf).toPandas().query("held_out")
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas().dropna(subset=["toxic"])
    both = got.merge(labels[["doc_id", "toxic"]], on="doc_id")
    assert both[both.toxic == 1].predicted.mean() > 0.85 and both[both.toxic == 0].predicted.mean() < 0.01
