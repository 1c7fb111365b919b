"""Token counts and ids of public tokenizers, by whole-token shortcut and a bounded cache of pre-tokens."""

from __future__ import annotations

import json
import os
import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOW_BYTES, eight_bytes, flat_bytes, mix64, small_batches, table, text_or_empty, word_spans, worker_memory

#: Pre-tokens that a worker remembers (about 60 MB); beyond that it starts anew with the proven ones.
CACHE = 250_000

#: Pre-tokens of more bytes are encoded once a batch and not remembered.
SHORT = 16

SPACE = "▁"


class PieceModel:
    """A sentencepiece model whose texts can be encoded pre-token by pre-token.

    A pre-token is a run of the space symbol with what follows it up to the next one. No merge crosses its border if
    no piece has that symbol behind another character; then a text's ids are those of its pre-tokens in a row. The
    constructor proves this, and which vocabulary strings encode alone as their one token, before any text is read.
    Where the proof fails (another normaliser, pieces across spaces), whole texts are encoded.
    """

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = pb.ModelProto()
        spec.ParseFromString(self.model.serialized_model_proto())
        norm = spec.normalizer_spec
        user = [p.piece for p in spec.pieces if p.type == p.USER_DEFINED]
        plain = norm.add_dummy_prefix and not norm.remove_extra_whitespaces and not norm.precompiled_charsmap and norm.escape_whitespaces
        self.splits = bool(plain and not user and not spec.trainer_spec.treat_whitespace_as_suffix and all(SPACE not in p.piece.lstrip(SPACE) for p in spec.pieces))
        words = [(p.piece[1:], i) for i, p in enumerate(spec.pieces) if p.type == p.NORMAL and p.piece.startswith(SPACE) and len(p.piece) > 1 and SPACE not in p.piece[1:]]
        alone = self.model.encode([w for w, _ in words], num_threads=1) if self.splits else []
        self.whole = {w: i for (w, i), ids in zip(words, alone) if ids == [i]}

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in a row, ids per text)"""
        rows = self.model.encode(texts, num_threads=1)
        n = np.fromiter(map(len, rows), np.int64, len(rows))
        return np.fromiter(chain.from_iterable(rows), np.uint32, int(n.sum())), n


class PreTokens:
    """Ids of pre-tokens: proven whole tokens first, remembered ones next, and only the rest are merged by the library.

    Pre-tokens of up to SHORT bytes are two 64-bit numbers, by which they are compared exactly; no string is made of one
    that is known.
    """

    def __init__(self, encode_all, whole: dict[str, int] | None = None, size: int = CACHE):
        self.encode_all, self.whole, self.size = encode_all, whole or {}, size
        self._reset()

    def _reset(self) -> None:
        words = [w.encode() for w in self.whole]
        self.keys = np.zeros((0, 3), np.uint64)  # hash and the two numbers, in the order of hashes
        self.at = np.zeros(0, np.int64)
        self.start, self.length, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        if words:
            n = np.array([len(w) for w in words])
            ends = np.cumsum(n)
            data = np.frombuffer(b"".join(words), np.uint8)
            short = np.flatnonzero(n <= SHORT)
            self._add(self._numbers(data, (ends - n)[short], ends[short]), np.array(list(self.whole.values()), np.uint32)[short], np.ones(len(short), np.int64))

    @staticmethod
    def _numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Rows of (hash, first 8 bytes, the other up to 8) of words of up to SHORT bytes. The length is in the hash and so in the order only; a word
        with zero bytes at its end could pass for a shorter one, and is not remembered (see places)."""
        eight = eight_bytes(data)
        n = ends - starts
        low = eight[starts] & LOW_BYTES[np.minimum(n, 8)]
        high = eight[starts + 8 * (n > 8)] & LOW_BYTES[np.where(n > 8, n - 8, 0)]
        return np.stack((mix64(low + mix64(high + np.uint64(0x9E3779B97F4A7C15))), low, high), 1)

    def _add(self, keys: np.ndarray, ids: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Stores the ids of new words; their places. `keys` may be empty: then the words are not remembered."""
        place = len(self.start) + np.arange(len(n))
        self.start = np.concatenate((self.start, len(self.ids) + np.cumsum(n) - n))
        self.length = np.concatenate((self.length, n))
        self.ids = np.concatenate((self.ids, ids))
        if len(keys):
            all_ = np.concatenate((self.keys, keys))
            order = np.argsort(all_[:, 0], kind="stable")
            self.keys, self.at = all_[order], np.concatenate((self.at, place))[order]
        return place

    def places(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where each of the pre-tokens is in start and length; valid until the next call."""
        if len(self.start) > self.size:
            self._reset()
        out = np.empty(len(starts), np.int64)
        short = ends - starts <= SHORT
        if len(starts):
            short &= data[ends - 1] != 0
        some = np.flatnonzero(short)
        keys = self._numbers(data, starts[some], ends[some])
        _, first, back = np.unique(keys[:, 0], return_index=True, return_inverse=True)
        same = (keys[first[back], 1:] == keys[:, 1:]).all(1)
        short[some[~same]] = False  # words whose hash another word has; they are encoded as the long ones are
        distinct = keys[first]
        at = np.minimum(np.searchsorted(self.keys[:, 0], distinct[:, 0]), max(len(self.keys) - 1, 0))
        known = (self.keys[at] == distinct).all(1) if len(self.keys) else np.zeros(len(distinct), bool)
        place = np.empty(len(distinct), np.int64)
        place[known] = self.at[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            place[new] = self._add(distinct[new], *self.encode_all(_strings(data, starts[some[first[new]]], ends[some[first[new]]])))
        out[some] = place[back]
        rest = np.flatnonzero(~short)
        if len(rest):
            names = _strings(data, starts[rest], ends[rest])
            number = {w: k for k, w in enumerate(dict.fromkeys(names))}
            out[rest] = self._add(keys[:0], *self.encode_all(list(number)))[[number[w] for w in names]]
        return out

    def gather(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in a row, ids per place)"""
        n = self.length[place]
        ends = np.cumsum(n)
        at = np.repeat(self.start[place] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
        return self.ids[at], n


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    raw = data.tobytes()
    return [raw[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist())]


def _sums(per_part: np.ndarray, before: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(per_part)))
    return total[before[1:]] - total[before[:-1]]


NOT_SPACE = np.arange(256) != 32


class PieceTexts:
    """Counts and ids of whole texts under a PieceModel. Empty texts have no tokens."""

    def __init__(self, path: str):
        self.model = PieceModel(path)
        self.cache = PreTokens(self.model.encode_all, self.model.whole)

    def _parts(self, texts: pa.Array):
        """(which texts are words with single spaces between, their words before each text, place of each word)"""
        data, off = flat_bytes(texts)
        starts, ends, before = word_spans(data, off, NOT_SPACE)
        spaces = np.concatenate(([0], np.cumsum(data == 32)))
        words = np.diff(before)
        regular = (words > 0) & (spaces[off[1:]] - spaces[off[:-1]] == words - 1)
        full = np.flatnonzero(words > 0)
        regular[full] &= (starts[before[full]] == off[full]) & (ends[before[full + 1] - 1] == off[full + 1])
        a, b, c = SPACE.encode()
        symbol = np.flatnonzero((data[:-2] == a) & (data[1:-1] == b) & (data[2:] == c))
        regular[np.searchsorted(off, symbol, "right") - 1] = False
        if not self.model.splits:
            regular[:] = False
        mine = np.repeat(regular, words)
        place = self.cache.places(data, starts[mine], ends[mine])
        return regular, np.concatenate(([0], np.cumsum(words * regular))), place

    def counts(self, texts: pa.Array) -> np.ndarray:
        regular, before, place = self._parts(texts)
        out = _sums(self.cache.length[place], before)
        odd = np.flatnonzero(~regular)
        if len(odd):
            out[odd] = self.model.encode_all([texts[i].as_py() for i in odd.tolist()])[1]
        return out

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in a row, ids per text)"""
        regular, before, place = self._parts(texts)
        flat, per_part = self.cache.gather(place)
        n = _sums(per_part, before)
        odd = np.flatnonzero(~regular)
        if not len(odd):
            return flat, n
        more, n[odd] = self.model.encode_all([texts[i].as_py() for i in odd.tolist()])
        out = np.empty(int(n.sum()), np.uint32)
        mine = np.repeat(regular, n)
        out[mine], out[~mine] = flat, more
        return out, n


#: Fixed class: letters whose lower case and NFC form stay inside the class, so that a run of them is one pre-token.
LETTERS_MARKS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!\"#$%&()*+,\-./:;=?@\[\\\]^_`{}~]*)")


def byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if it is a printing Latin-1 character, else the next code point from 256 on."""
    out, spare = {}, 256
    for b in range(256):
        plain = 33 <= b <= 126 or 161 <= b <= 255 and b != 173
        out[b] = chr(b if plain else spare)
        spare += not plain
    return out


def words_stand_alone(spec: dict) -> bool:
    """Whether a tokenizer's parts prove that a text's ids are those of its words in a row, words being cut at ASCII white space.

    So it is if the text is composed (NFC), lower-cased and has its white space replaced by spaces, which all leave what
    lies between two white spaces to itself; if pre-tokens are runs that white space can't be part of, and it is removed; and
    if no added token holds white space or takes it in.
    """
    norm = spec.get("normalizer") or {}
    steps = norm.get("normalizers", [norm])
    plain = all(x.get("type") in ("NFC", "Lowercase") or x.get("type") == "Replace" and x.get("pattern") == {"Regex": r"\s+"} and x.get("content") == " " for x in steps)
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    cut = len(pre) == 2 and pre[0] == {"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Removed", "invert": True}
    alone = cut and pre[1]["type"] == "ByteLevel" and not pre[1]["add_prefix_space"] and not pre[1]["use_regex"]
    added = all(not re.search(r"\s", t["content"]) and not t["lstrip"] and not t["rstrip"] and not t["single_word"] for t in spec.get("added_tokens", []))
    return bool(plain and alone and added and not spec.get("post_processor") and spec["model"]["type"] == "BPE")


class WordTexts:
    """Ids of whole texts under a tokenizer of words that drops white space; texts are encoded whole where its parts don't prove that words stand alone."""

    def __init__(self, path: str, remembered: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.splits = words_stand_alone(json.loads(self.model.to_str()))
        self.merge = self.model.model.tokenize if self.splits else None
        self.runs: dict[str, array] = {"": array("I")}
        self.symbols = byte_symbols()
        self.remembered = remembered
        self.cache = PreTokens(self._encode_all, size=remembered)

    def _whole(self, texts: list[str]) -> list[array]:
        return [array("I", e.ids) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_all(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A word of letters and then marks is two pre-tokens, remembered each for itself, letters in lower case: only the merges are left to the library. Other words go through the whole tokenizer."""
        if len(self.runs) > self.remembered:
            self.runs = {"": array("I")}
        runs, merge, symbols = self.runs, self.merge, self.symbols
        flat, n, odd = array("I"), [], []
        for k, word in enumerate(words):
            cut = LETTERS_MARKS.fullmatch(word)
            if not cut:
                odd.append(k)
                n.append(0)
                continue
            size = 0
            for part in (cut[1].lower(), cut[2]):
                ids = runs.get(part)
                if ids is None:
                    plain = part if part.isascii() else part.encode().decode("latin-1").translate(symbols)
                    ids = runs[part] = array("I", [x.id for x in merge(plain)])
                flat += ids
                size += len(ids)
            n.append(size)
        flat, n = np.frombuffer(flat, np.uint32) if len(flat) else np.zeros(0, np.uint32), np.array(n, np.int64)
        if not odd:
            return flat, n
        rows = self._whole([words[k] for k in odd])
        more = np.zeros(len(words), bool)
        more[odd] = True
        n[odd] = [len(r) for r in rows]
        out = np.empty(int(n.sum()), np.uint32)
        mine = np.repeat(more, n)
        out[mine], out[~mine] = np.concatenate([np.frombuffer(r, np.uint32) if len(r) else np.zeros(0, np.uint32) for r in rows]), flat
        return out, n

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in a row, ids per text)"""
        if not self.splits:
            rows = self._whole(texts.to_pylist())
            return np.concatenate([np.zeros(0, np.uint32), *[np.array(r, np.uint32) for r in rows]]), np.array([len(r) for r in rows], np.int64)
        data, off = flat_bytes(texts)
        starts, ends, before = word_spans(data, off)
        flat, per_part = self.cache.gather(self.cache.places(data, starts, ends))
        return flat, _sums(per_part, before)


def loaded(kind, path: str, *settings):
    """The tokenizer of this worker process, with its cache."""
    return worker_memory(("tokenizer", path, *settings), lambda: kind(path, *settings))


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """docs without text, with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) under a sentencepiece model.

    Every whole text is counted, without begin, end or added special tokens. Pre-tokens that are proven to be one token
    count one by a look-up; the rest are merged by the library, once per distinct pre-token while the worker remembers
    it. Null and empty texts have 0 bytes and tokens. A very long text is a batch of its own, of some 100 bytes a word. Rows stay as they are, repeated or not; columns named like the
    results are replaced.
    """
    made = ["n_bytes", "n_tokens", "over_limit"]
    small_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c not in (*made, "text")]
    rows = docs.select(*keep, text_or_empty().alias("text"))

    def run(batches):
        counter = loaded(PieceTexts, model_path)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            n = counter.counts(texts)
            cols = [pc.binary_length(texts).cast(pa.int64()), pa.array(n), pa.array(n > limit)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *cols], [*keep, *made])

    schema = rows.select(*keep).schema.add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")
    return rows.mapInArrow(run, schema)


def op4_token_counts(spark, sf_dir):
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
