"""Registered queries against their SQL twins, and what no twin can tell against plain Python."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from places import DATA

from tapeline.llm import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_sql_twin(spark, same, name):
    same(registry.QUERIES[name](spark, DATA), registry.ORACLE_SQL[name])


def test_mix_nears_targets(spark):
    p = registry.QUERIES["op1_source_mix"](spark, DATA).toPandas()
    by = p.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"), least=("size", "min"))
    assert ((by.taken - by.target).abs() <= by["size"] * 0.02 + 200).all() and abs(by.target.sum() - by["size"].sum()) < 1
    assert (p.taken <= 3 * p["size"]).all() and (by.target <= 3 * by["size"] + 1e-6).all()


def test_media(spark, documents):
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in documents.collect()}
    for r in registry.QUERIES["op2_media_columns"](spark, DATA).collect():
        raw = texts[r["doc_id"]]
        pad = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(pad), hashlib.sha256(pad).hexdigest(), zlib.crc32(pad[-64:]))
        assert r["feature"].startswith("raw/8000Hz/") and r["media_bytes"] > len(pad)


def test_token_counts(spark, documents):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {r["doc_id"]: len(model.encode(r["text"] or "")) for r in documents.collect()}
    for r in registry.QUERIES["op4_token_counts"](spark, DATA).collect():
        assert r["n_tokens"] == want[r["doc_id"]] and r["over_limit"] == (r["n_tokens"] > 4096)


def test_jaccard(spark, documents):
    from test_odd_rows import brute_jaccard

    want = brute_jaccard([(r["doc_id"], r["text"]) for r in documents.collect()], 4, 85)
    for r in registry.QUERIES["op5_jaccard_join"](spark, DATA).collect():
        assert (r["n_shingles"], r["component_id"], r["n_links"]) == want[r["doc_id"]]


def test_main_text(spark):
    from html import unescape

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    got = registry.QUERIES["op6_main_text"](spark, DATA).collect()
    assert len(got) == len(pages)
    for r in got:
        inside = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        assert r["text"] == " ".join(unescape(re.sub(r"<[^>]*>", " ", inside)).split()) and r["n_chars"] == len(r["text"])


def test_packed_matrix_is_lossless(spark, documents):
    import sentencepiece

    from tapeline.llm import packing

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = collections.defaultdict(dict)
    for r in packing.write_token_matrix(documents, path, None).collect():
        row = np.frombuffer(r["ids"], "<u2")
        assert len(row) == 2048 and r["cu_seqlens"][-1] == r["n_tokens"] and not row[r["n_tokens"] :].any()
        assert r["position_resets"][: len(r["doc_ids"])] == r["cu_seqlens"][:-1]
        for d, p, a, b in zip(r["doc_ids"], r["pieces"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            got[d][p] = row[a:b].tolist()
    for r in documents.collect():
        assert sum((got[r["doc_id"]][p] for p in sorted(got[r["doc_id"]])), []) == model.encode(r["text"] or "") + [2]
    assert registry.QUERIES["op8_token_matrix"](spark, DATA).count() > 0


def test_best_fit(spark, documents):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    p = registry.QUERIES["op9_best_fit"](spark, DATA).toPandas()
    for _, g in p.groupby("doc_id"):
        assert (g.sort_values("piece").start.diff().dropna() == 2048).all()
    ids = {r["doc_id"]: np.array(t.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4") for r in documents.collect()}
    for r in p.itertuples():
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length]) == r.ids_crc32
    assert p.length.sum() == sum(map(len, ids.values()))
    p = p.sort_values(["sequence_id", "offset"])
    ends = p.groupby("sequence_id").length.cumsum()
    assert (ends - p.length == p.offset).all() and ends.max() <= 2048
    assert p.sequence_id.nunique() <= -(-p.length.sum() // 2048) + 1


def test_language_is_told_on_held_out_documents(spark, documents):
    lang = {r["doc_id"]: r["lang"] for r in documents.collect()}
    held = [r for r in registry.QUERIES["op10_language_id"](spark, DATA).collect() if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and 0 <= r["score"] <= 1 for r in held)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)
