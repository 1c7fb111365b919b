"""Piece ids and decoded texts against the library itself."""

import random

import numpy as np
import public_tokenizers
import pytest

from tapeline.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")

#: Marks, spaces, characters outside the vocabulary, spelled special tokens, and words long enough to be segmented in place.
PARTS = [" ", " ", "▁", "\n", "\t", "a", "b", "the", "é", "日本", "\U0001f600", "\x00", "<s>", "</s>", "<unk>", "<0x0A>", "ﬁ", "́", "word", "xyz" * 20, "​", "İ"]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PATH)

    def run(text):
        ids = model.encode(text or "", add_bos=True, add_eos=True)
        return ids, model.decode(ids)

    return run


def check(df, library, held=pieces.HELD):
    texts = df.select("doc_id", "text").collect()
    found = pieces.encoded_pieces(df, PATH, held).collect()
    key = lambda r: str(r)
    want = sorted(((r["doc_id"], *library(r["text"])) for r in texts), key=key)
    assert sorted(((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"]) for r in found), key=key) == want
    assert all(r["n_tokens"] == len(r["ids"]) // 4 for r in found)


def test_documents(documents, library):
    check(documents, library)


@pytest.mark.parametrize("held", [0, 20, pieces.HELD])
def test_odd_texts_with_tables_of_all_sizes(spark, library, held):
    rnd = random.Random(3)
    rows = [(i, "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 30)))) for i in range(1500)]
    rows += [(2000, None), (2001, ""), (2002, "q" * 100_000), (2003, " " * 5000), (2004, "ab " * 60_000), (2005, "▁ ▁"), (2006, "end "), (2006, "end ")]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), library, held)


def test_odd_rows_and_clashing_columns(odd, clashing, library):
    check(odd, library)
    found = pieces.encoded_pieces(clashing, PATH)
    assert len(found.columns) == len(set(found.columns)) and found.count() == odd.count()


def test_empty_table(none):
    assert pieces.encoded_pieces(none, PATH).count() == 0


def test_repeated_words_are_segmented_once(spark):
    df = spark.createDataFrame([(i, "again and again rarely%d " % i + "z" * 40) for i in range(50)], "doc_id long, text string").repartition(6)
    table = {r["word"]: r["n"] for r in pieces.word_table(df, PATH).collect()}
    assert table == {" again": 100, " and": 50}


def test_words_that_do_not_decode_to_themselves_are_decoded_by_ids(spark, library, monkeypatch):
    monkeypatch.setattr(pieces.WordModel, "same_decoded", lambda self, words, ids: np.zeros(len(words), bool))
    import pyarrow as pa

    codec = pieces.PieceCodec(pieces.WordModel(PATH), pieces.HeldWords(pa.table({"word": pa.array([], pa.string()), "ids": pa.array([], pa.list_(pa.int32())), "same": pa.array([], pa.bool_())})))
    texts = ["a b", "", " c▁"]
    ids, n, decoded = codec.encode(pa.array(texts))
    assert decoded.to_pylist() == [library(t)[1] for t in texts] and ids.tolist() == sum((library(t)[0] for t in texts), [])
