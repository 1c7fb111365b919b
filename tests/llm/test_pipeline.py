"""The pipeline's stages against plain Python, on driver tables and on odd rows."""

import collections

import pytest
from places import DATA
from test_odd_rows import brute_jaccard

import corpus_pipeline
from tapeline.llm.common import materialise

NAMES = ["language_id", "exact_dedup", "jaccard_join", "source_mix", "best_fit"]


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES


def test_pipeline_equals_plain_python(spark, documents):
    docs = documents
    before = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        columns, docs = docs.columns, materialise(stage(spark, docs, DATA))
        rows = docs.collect()
        if name != "best_fit":
            assert docs.columns == columns
        ids = collections.Counter(r["doc_id"] for r in rows)
        if name == "language_id":
            assert {d for d, r in before.items() if any(c.isalpha() for c in r["text"] or "")} >= set(ids) and len(ids) >= 0.98 * len(before)
        elif name == "exact_dedup":
            top = {}
            for d, r in before.items():
                top[r["text"]] = max(d, top.get(r["text"], d))
            assert set(ids) == set(top.values())
        elif name == "jaccard_join":
            want = brute_jaccard([(d, r["text"]) for d, r in before.items()], 5, 80)
            assert set(ids) == {d for d, (_, c, _) in want.items() if c == d}
        elif name == "source_mix":
            assert set(ids) <= set(before) and max(ids.values()) <= 3
            words = lambda n: sum(len(before[d]["text"].split()) * k for d, k in n.items())
            assert abs(words(ids) - words(collections.Counter(before.keys()))) < 0.02 * words(collections.Counter(before.keys())) + 2000
            copies = ids
        else:
            assert set(ids) == set(copies)
        before = {r["doc_id"]: r for r in rows}


@pytest.mark.parametrize("at", range(5))
def test_stages_on_odd_rows_and_none(spark, odd, none, at):
    name, stage = corpus_pipeline.STAGES[at]
    assert stage(spark, none, DATA).count() == 0
    assert stage(spark, odd, DATA).count() > 0


def test_unlearned_languages_go(spark):
    """Texts in another script, and random ones, go; nearly all others stay."""
    import random

    documents = spark.read.parquet(DATA.replace("sf0.001", "sf0.01") + "/documents.parquet")

    rng = random.Random(3)
    other = ["".join(rng.choice("абвгдежзиклмнопрстуфхцчшщъыьэюя ") for _ in range(n)) for n in (60, 900)]
    noise = ["".join(chr(rng.randrange(33, 127)) for _ in range(n)) for n in (200, 3000)]
    planted = spark.createDataFrame([(10**6 + i, t, None, "web", len(t)) for i, t in enumerate(other + noise)], documents.schema)
    got = {r["doc_id"] for r in corpus_pipeline.language_id(spark, documents.unionByName(planted), DATA).collect()}
    assert not {d for d in got if d >= 10**6}
    lettered = {r["doc_id"] for r in documents.collect() if any(c.isalpha() for c in r["text"] or "")}
    assert len(got) >= 0.99 * len(lettered)


def test_run(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 0


def test_slices_of_texts_give_the_same_pieces(spark, odd):
    """A worker that takes texts in slices and remembers few words makes the pieces of one that takes whole batches; the pipeline's does."""
    import public_tokenizers
    import pyarrow as pa

    from tapeline.llm import packing

    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    whole, sliced = (sorted(map(str, packing.token_pieces(docs, path, **how).collect())) for how in ({}, {"slice_bytes": 3000, "remembered": 50}))
    assert whole == sliced and len(whole) > 200
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4, 5], "text": ["a" * 40, "b" * 70, "", "c" * 500, "d"]})
    parts = packing.text_slices(batch, 100)
    assert [r for p in parts for r in p.column(0).to_pylist()] == [1, 2, 3, 4, 5] and len(parts) == 3
    assert packing.text_slices(batch, None) == [batch]
    assert 0 < corpus_pipeline.SLICE_BYTES <= 1 << 20
