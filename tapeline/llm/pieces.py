"""Sentencepiece ids and decoded texts through a table of distinct marked words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOW_BYTES, eight_bytes, flat_bytes, materialise, mix64, small_batches, table, text_or_empty, worker_memory
from .tokens import SPACE, PieceModel

#: Words that the broadcast part of the table holds at most: about 50 MB with their ids.
HELD = 1 << 20

#: Bytes of a marked word that is compared as numbers; longer ones are segmented where they stand.
SHORT = 31


class WordModel(PieceModel):
    """Ids and decoded forms of marked words: runs of the white-space mark, written as spaces here, with what follows up to the next one."""

    def __init__(self, path: str):
        super().__init__(path)
        self.begin = [i for i in [self.model.bos_id()] if i >= 0]
        self.end = [i for i in [self.model.eos_id()] if i >= 0]
        self.mark = self.model.encode("x ")[len(self.model.encode("x")) :] if self.splits else []

    def segment(self, words: list[str]) -> list[list[int]]:
        """The library puts the first mark before a text itself, so a word goes in without it; the mark alone is what a last space adds."""
        return [self.mark if w == " " else ids for w, ids in zip(words, self.model.encode([w[1:] for w in words], num_threads=1))]

    def same_decoded(self, words: list[str], ids: list[list[int]]) -> np.ndarray:
        """Whether the ids of each word decode to it; decoding drops a text's first mark."""
        texts = self.model.decode(ids, num_threads=1) if words else []
        return np.array([w == " " or t == w[1:] for w, t in zip(words, texts)], bool)


def marked(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of the texts with a mark before each and every mark as a space, offsets, starts of marked words, words before each text). Empty texts have none."""
    plain = pc.replace_substring(texts, SPACE, " ")
    data, off = flat_bytes(pc.if_else(pc.equal(pc.binary_length(plain), 0), "", pc.binary_join_element_wise(" ", plain, "")))
    space = data == 32
    start = space.copy()
    start[1:] &= ~space[:-1]
    start[off[:-1][off[:-1] < off[1:]]] = True
    starts = np.flatnonzero(start)
    return data, off, starts, np.searchsorted(starts, off)


def numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rows of (hash, four numbers that spell the word and its length) of words of up to SHORT bytes."""
    eight = eight_bytes(data)
    size = ends - starts
    out = np.zeros((len(starts), 5), np.uint64)
    h, rest, done = size.astype(np.uint64), np.arange(len(starts)), 0
    while len(rest):
        part = eight[starts[rest] + done] & LOW_BYTES[np.minimum(size[rest] - done, 8)]
        out[rest, 1 + done // 8] = part
        h[rest] = mix64(h[rest] + part)
        done += 8
        rest = rest[size[rest] > done]
    out[:, 4] |= size.astype(np.uint64) << np.uint64(56)
    out[:, 0] = h
    return out


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a row of each distinct word, number of each row's word among them, rows whose hash is another word's: they stand for themselves)"""
    _, first, back = np.unique(keys[:, 0], return_index=True, return_inverse=True)
    odd = np.flatnonzero((keys[first[back]] != keys).any(1))
    return first, back, odd


def cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words as strings."""
    n = ends - starts
    off = np.concatenate(([0], np.cumsum(n)))
    at = np.repeat(starts - off[:-1], n) + np.arange(off[-1])
    return pa.StringArray.from_buffers(len(n), pa.py_buffer(off.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[at])))


def _count(batches):
    """(word, n): the distinct short words of each batch."""
    worker_memory("pieces")
    for batch in batches:
        data, off, starts, _ = marked(batch.column(0))
        ends = np.append(starts[1:], len(data))
        short = np.flatnonzero(ends - starts <= SHORT)
        starts, ends = starts[short], ends[short]
        first, back, odd = distinct(numbers(data, starts, ends))
        rows = np.concatenate((first, odd))
        n = np.bincount(back, minlength=len(first)) - np.bincount(back[odd], minlength=len(first))
        yield pa.RecordBatch.from_arrays([cut(data, starts[rows], ends[rows]), pa.array(np.concatenate((n, np.ones(len(odd), np.int64))))], ["word", "n"])


def word_table(docs: DataFrame, model_path: str, held: int = HELD) -> DataFrame:
    """word, n, ids (array) and same (whether the ids decode to it): marked words that texts repeat, each segmented once, stored.

    Tasks count distinct words before they are shuffled, so a hot word is a row per task. If more than `held` words are repeated, those
    that occur least often are left out; a word that isn't here occurs once or so few times, or is longer than SHORT bytes, and is segmented where it stands.
    """
    words = docs.select(text_or_empty().alias("text")).mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter("n > 1")
    words = materialise(words)
    size = F.floor(F.log2("n") * 8).alias("size")  # an eighth of a doubling: at most some 500 classes
    least, total = 1 << 62, 0
    for r in sorted(words.groupBy(size).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least")).collect(), key=lambda r: -r["size"]):
        total += r["words"]
        if total > held:
            break
        least = r["least"]
    else:
        least = 2

    def run(batches):
        model = worker_memory(("words", model_path), lambda: WordModel(model_path))
        for batch in batches:
            some = batch.column(0).to_pylist()
            ids = model.segment(some)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32())), pa.array(model.same_decoded(some, ids))], ["word", "n", "ids", "same"])

    return materialise(words.filter(F.col("n") >= least).mapInArrow(run, "word string, n long, ids array<int>, same boolean"))


class HeldWords:
    """The table as sorted arrays, of a bounded size."""

    def __init__(self, rows: pa.Table):
        words = rows.column("word").combine_chunks()
        data, off = flat_bytes(words)
        keys = numbers(data, off[:-1], off[1:])
        order = np.argsort(keys[:, 0], kind="stable")
        lists = rows.column("ids").combine_chunks()
        self.keys, self.place = keys[order], order
        self.length = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32)
        self.start = np.cumsum(self.length, dtype=np.int64) - self.length
        self.ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.uint32)
        self.same = rows.column("same").to_numpy().astype(bool)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Where each word is in start and length; -1 for words that aren't held."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys[:, 0], keys[:, 0]), len(self.keys) - 1)
        return np.where((self.keys[at] == keys).all(1), self.place[at], -1)


class PieceCodec:
    """Ids and decoded texts, both joined from words by their positions."""

    def __init__(self, model: WordModel, held: HeldWords):
        self.model, self.held = model, held

    def words(self, data, starts, ends):
        """(start, length, ids, same) with a row for each marked word: ids are found at start in ids."""
        held, short = self.held, ends - starts <= SHORT
        some = np.flatnonzero(short)
        keys = numbers(data, starts[some], ends[some])
        first, back, odd = distinct(keys)
        place = held.places(keys[first])
        own = np.concatenate((some[first[place < 0]], some[odd], np.flatnonzero(~short)))  # stand for themselves
        text = cut(data, starts[own], ends[own]).to_pylist()
        number = {w: k for k, w in enumerate(dict.fromkeys(text))}
        ids = self.model.segment(list(number))
        more = np.array([len(i) for i in ids], np.int64)
        fresh = np.array([number[w] for w in text], np.int64) + len(held.length)
        new = int((place < 0).sum())
        place[place < 0] = fresh[:new]
        out = np.empty(len(starts), np.int64)
        out[some] = place[back]
        out[own[new:]] = fresh[new:]
        length = np.concatenate((held.length, more))
        start = np.concatenate((held.start, len(held.ids) + np.cumsum(more) - more))
        flat = np.concatenate((held.ids, np.array([x for i in ids for x in i], np.uint32)))
        same = np.concatenate((held.same, self.model.same_decoded(list(number), ids)))
        return start[out], length[out], flat, same[out]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """(all ids in a row with begin and end, ids per text, decoded texts)"""
        model = self.model
        if not model.splits:
            rows = model.model.encode(texts.to_pylist(), add_bos=bool(model.begin), add_eos=bool(model.end), num_threads=1)
            n = np.array([len(r) for r in rows], np.int64)
            return np.array([x for r in rows for x in r], np.uint32), n, pa.array([model.model.decode(r) for r in rows], pa.string())
        data, off, starts, before = marked(texts)
        start, length, flat, same = self.words(data, starts, np.append(starts[1:], len(data)))
        total = np.concatenate(([0], np.cumsum(length)))
        body = total[before[1:]] - total[before[:-1]]
        n = body + len(model.begin) + len(model.end)
        ends = np.cumsum(n)
        out = np.empty(int(n.sum()), np.uint32)
        inner = np.ones(len(out), bool)
        for k, i in enumerate(model.begin):
            out[ends - n + k], inner[ends - n + k] = i, False
        for k, i in enumerate(reversed(model.end)):
            out[ends - 1 - k], inner[ends - 1 - k] = i, False
        out[inner] = flat[np.repeat(start - total[:-1], length) + np.arange(total[-1])]
        decoded = cut(data, np.minimum(off[:-1] + 1, off[1:]), off[1:])  # words that decode to themselves, without the first mark
        odd = np.flatnonzero(np.diff(np.concatenate(([0], np.cumsum(~same)))[before]))
        if len(odd):
            texts = decoded.to_pylist()
            for k in odd.tolist():
                texts[k] = model.model.decode(out[ends[k] - n[k] : ends[k]].tolist())
            decoded = pa.array(texts, pa.string())
        return out, n, decoded


def encoded_pieces(docs: DataFrame, model_path: str, held: int = HELD) -> DataFrame:
    """docs without text, with ids (binary, little-endian 32-bit, with begin and end), n_tokens and decoded, the text that these ids decode to.

    Texts are read twice: once for the table of repeated marked words, and once to join ids back by position, within the task that reads the text, so
    no text and no word's occurrence is shuffled. Words that the table doesn't hold are segmented in place. Where the model's pieces may cross white space,
    whole texts are encoded. Null and empty texts have begin and end alone and decode to an empty text. A very long text is a batch of its own. Rows
    stay as they are, repeated or not; columns named like the results are replaced. An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    made = ["ids", "n_tokens", "decoded"]
    keep = [c for c in docs.columns if c not in (*made, "text")]
    rows = docs.select(*keep, text_or_empty().alias("text"))
    shared = spark.sparkContext.broadcast(HeldWords(word_table(docs, model_path, held).toArrow()))

    def run(batches):
        codec = worker_memory(("pieces", model_path), lambda: PieceCodec(WordModel(model_path), shared.value))
        codec.held = shared.value
        for batch in batches:
            ids, n, decoded = codec.encode(batch.column(batch.num_columns - 1))
            off = np.concatenate(([0], 4 * np.cumsum(n))).astype(np.int32)
            binary = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(off), pa.py_buffer(ids.astype("<u4"))])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], binary, pa.array(n), decoded], [*keep, *made])

    return rows.mapInArrow(run, rows.select(*keep).schema.add("ids", "binary").add("n_tokens", "long").add("decoded", "string"))


def op13_piece_codec(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = encoded_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
