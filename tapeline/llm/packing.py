"""Packing token sequences: best fit by local search over bins, and best-fit-decreasing into binary id matrices."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, shared_dir, shuffle_partitions, small_batches, table, text_or_empty, worker_memory
from .tokens import CACHE, PieceTexts, WordTexts, loaded

#: Pieces that one task packs together. A group wastes less than a bin, of some thousand.
GROUP_PIECES = 8192

#: Tokens that a writer task holds and packs at a time.
BUFFER_TOKENS = 4_000_000


def text_slices(batch: pa.RecordBatch, most: int | None):
    """The batch in slices of about `most` bytes of its second column's text, a longer text in one of its own; whole if most is none."""
    if not most or batch.num_rows < 2:
        return [batch]
    ends = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = [0, *(np.flatnonzero(np.diff(ends // most)) + 1).tolist(), batch.num_rows]
    return [batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:])]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, slice_bytes: int | None = None, remembered: int = CACHE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every text's ids and end_id, cut into pieces of `capacity` if longer.

    Null and empty texts are the end_id alone. Rows without doc_id and repeated rows have pieces like others; a very long text is a batch of its
    own, of some 100 bytes a word; extra columns are ignored; an empty table gives no rows. With slice_bytes, a worker takes a batch's texts in slices of that
    size, and with a smaller `remembered`, it keeps fewer words' ids: both take less memory and more time.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        words = loaded(WordTexts, tokenizer_path, remembered)
        for batch in (part for whole in batches for part in text_slices(whole, slice_bytes)):
            flat, n = words.ids(batch.column(1))
            ends = np.cumsum(n)
            out = np.empty(len(flat) + len(n), "<u4")
            last = ends + np.arange(len(n))
            out[last] = end_id
            hole = np.ones(len(out), bool)
            hole[last] = False
            out[hole] = flat
            size = n + 1
            pieces = -(-size // capacity)
            row = np.repeat(np.arange(len(n)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(capacity, size[row] - start)
            at = (last - n)[row] + start
            crc = [zlib.crc32(out[a:b]) for a, b in zip(at.tolist(), (at + length).tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins (lists of positions). A segment tree over free capacities finds the fullest bin that still takes a piece."""
    size = 1
    while size <= capacity:
        size *= 2
    bins_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = [0] * (2 * size)  # bins under each node of the tree; leaf size + r: those with r free
    bins: list[list[int]] = []

    def change(r: int, by: int) -> None:
        k = size + r
        while k:
            some[k] += by
            k //= 2

    def least_from(r: int) -> int:
        """The smallest free capacity of at least r that a bin has; -1 if none."""
        k = size + r
        if some[k]:
            return r
        while k > 1:
            if not k & 1 and some[k + 1]:
                k += 1
                while k < size:
                    k = 2 * k if some[2 * k] else 2 * k + 1
                return k - size
            k //= 2
        return -1

    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        r = least_from(n)
        if r < 0:
            bins.append([i])
            b, r = len(bins) - 1, capacity
        else:
            b = bins_at[r].pop()
            change(r, -1)
            bins[b].append(i)
        if r > n:
            bins_at[r - n].append(b)
            change(r - n, 1)
    return bins


def next_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins filled one after the other, longest pieces first: a piece that doesn't fit the bin at hand opens the next one."""
    bins: list[list[int]] = []
    room = -1
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        if n > room:
            bins.append([])
            room = capacity
        bins[-1].append(i)
        room -= n
    return bins


class Exchanges:
    """Local search over bins: moves, one-for-one and two-for-one swaps between underfull ones, each raising the sum of squared fills.

    A bin gives its largest piece that another takes to the fullest such bin; if none moves, it swaps a piece, and if
    none swaps two pieces, for a smaller one, where that leaves the least room. Full bins stay as they are, so the pieces and bins that are looked at get fewer; the lists of them are made anew every REFRESH exchanges. `made` counts
    exchanges by kind.
    """

    REFRESH = 64

    def __init__(self, lengths: np.ndarray, bins: list[list[int]], capacity: int):
        self.size = np.asarray(lengths, np.int64)
        self.bins = [set(b) for b in bins]
        self.capacity = capacity
        self.bin_of = np.zeros(len(self.size), np.int64)
        for b, members in enumerate(bins):
            self.bin_of[members] = b
        self.fill = np.bincount(self.bin_of, self.size, len(bins)).astype(np.int64)
        self.made = {"move": 0, "one_for_one": 0, "two_for_one": 0}
        self._refresh()

    def _refresh(self) -> None:
        self.open = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity))
        is_open = np.zeros(len(self.bins), bool)
        is_open[self.open] = True
        self.pieces = np.flatnonzero(is_open[self.bin_of] & (self.size > 0))

    def _change(self, kind: str, source: int, to: int, come: list[int], leave: list[int]) -> None:
        self.bins[source] = self.bins[source] - set(come) | set(leave)
        self.bins[to] = self.bins[to] - set(leave) | set(come)
        gain = int(self.size[come].sum() - self.size[leave].sum())
        self.bin_of[come], self.bin_of[leave] = to, source
        self.fill[to] += gain
        self.fill[source] -= gain
        self.made[kind] += 1
        if sum(self.made.values()) % self.REFRESH == 0:
            self._refresh()

    def step(self, source: int) -> bool:
        """Makes the best exchange out of a bin, if there is one."""
        fill = self.fill[source]
        mine = sorted((i for i in self.bins[source] if self.size[i]), key=lambda i: (-self.size[i], i))
        sizes = self.size[mine].tolist()
        one: dict[int, list[int]] = {}
        for x, n in zip(mine, sizes):
            one.setdefault(n, [x])

        others = self.open[(self.fill[self.open] < self.capacity) & (self.fill[self.open] > 0) & (self.open != source)]
        gap = self.capacity - self.fill[others]
        for n, come in one.items():
            able = np.flatnonzero((gap >= n) & (self.capacity - gap + n > fill))
            if len(able):
                self._change("move", source, int(others[able[np.argmin(gap[able])]]), come, [])
                return True

        at = self.bin_of[self.pieces]
        there = (at != source) & (self.fill[at] < self.capacity)
        pieces, at = self.pieces[there], at[there]
        size = self.size[pieces]
        reach = size + self.capacity - self.fill[at]  # how large a piece may be that takes this one's place
        top = int(reach.max(initial=0))

        def swap(kind: str, offers: dict[int, list[int]]) -> bool:
            best = None
            for n, come in offers.items():
                if n > top:
                    continue
                able = np.flatnonzero((reach >= n) & (size < n))
                able = able[self.capacity - reach[able] + n > fill]
                if len(able):
                    k = able[np.argmin(reach[able])]
                    rest = int(reach[k]) - n
                    if best is None or rest < best[0]:
                        best = (rest, int(at[k]), come, [int(pieces[k])])
                    if not rest:
                        break
            if best:
                self._change(kind, source, *best[1:])
            return best is not None

        if swap("one_for_one", one):
            return True
        two: dict[int, list[int]] = {}
        for k, (x, n) in enumerate(zip(mine, sizes)):
            for y, m in zip(mine[:k], sizes[:k]):
                if n + m <= top:
                    two.setdefault(n + m, [x, y])
        return swap("two_for_one", two)

    def run(self) -> list[list[int]]:
        """The emptiest underfull bin gives until it is empty or stuck, then the next one; stuck ones are tried again after
        the others, until no exchange is left or the bins are as few as ceil(all pieces / capacity)."""
        left = int((self.fill > 0).sum())
        bound = -(-int(self.size.sum()) // self.capacity)
        stuck, moved = np.zeros(len(self.bins), bool), False
        while left > bound:
            able = self.open[(self.fill[self.open] > 0) & (self.fill[self.open] < self.capacity) & ~stuck[self.open]]
            if not len(able):
                if not moved:
                    break
                stuck[:], moved = False, False
                continue
            source = int(able[np.argmin(self.fill[able])])
            while self.fill[source] and self.step(source):
                moved = True
            stuck[source] = self.fill[source] > 0
            left -= not self.fill[source]
        nothing = [i for b, members in enumerate(self.bins) if not self.fill[b] for i in members]
        out = [sorted(members) for b, members in enumerate(self.bins) if self.fill[b]]
        if nothing:  # pieces without length take no room
            out = [out[0] + nothing, *out[1:]] if out else [nothing]
        return out


def local_search(lengths: np.ndarray, bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Fewer bins, if exchanges between underfull ones can empty some."""
    return Exchanges(lengths, bins, capacity).run()


def pack_pieces(pieces: DataFrame, capacity: int = 2048, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds sequence_id and offset to rows with a `length` of at most capacity: each sequence is gapless from 0.

    Rows are dealt evenly to groups of about group_pieces by a hash of their place, so repeated rows and hot documents
    spread; a group starts with bins filled one after the other (next fit), a sixth too many, and local search empties bins. Rows need the columns of token_pieces; extra columns
    are kept, sequence_id and offset replaced. Rows of length 0 or null take no room and join the first sequence of their group.
    An empty table gives an empty result. `pieces` should be a stored table (it is counted).
    """
    pieces = pieces.select(*[c for c in pieces.columns if c not in ("sequence_id", "offset")])
    groups = max(1, round(pieces.count() / group_pieces))
    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        worker_memory("packing")
        group = int(pdf.pop("_group").iloc[0])
        n = pdf["length"].fillna(0).to_numpy(np.int64)
        bins = local_search(n, next_fit(n, capacity), capacity)
        seq, off = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        for k, members in enumerate(bins):
            at = 0
            for i in members:
                seq[i], off[i] = k, at
                at += int(n[i])
        return pdf.assign(sequence_id=(group << 32) + seq, offset=off)

    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    # a group costs time, not bytes, so tasks are not left to be merged by size
    return dealt.repartition(min(groups, shuffle_partitions(pieces.sparkSession)), "_group").groupBy("_group").applyInPandas(pack, schema)


def op9_best_fit(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack_pieces(materialise(token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))))


MATRIX = "sequence_id long, ids binary, n_tokens int, doc_ids array<long>, pieces array<int>, cu_seqlens array<int>, position_resets array<int>"


def write_token_matrix(docs: DataFrame, model_path: str, place: str, capacity: int = 2048, end_id: int = 2, pad_id: int = 0) -> DataFrame:
    """Writes packed id rows as Parquet at `place` and returns them read back.

    A row is a sequence of `capacity` ids, little-endian unsigned 16-bit (the vocabulary is smaller than 65,536; larger
    ones are refused), filled up with pad_id; cu_seqlens are the cumulative lengths of its segments from 0, and
    position_resets the places at which positions start again at 0 (each segment's first token, and the padding's).
    Every text's ids with end_id are cut losslessly into pieces of `capacity` if longer; each task packs its own
    documents by best-fit-decreasing, up to BUFFER_TOKENS at a time, so no ids are shuffled. Null and empty texts
    are the end_id alone. Repeated rows are packed each, very long texts piece by piece; a task holds BUFFER_TOKENS ids and the
    longest text's; extra columns are ignored; an empty table writes no rows.
    """
    small_batches(docs.sparkSession)

    def flush(ids: list[np.ndarray], owners: list[tuple], number: int):
        length = np.array([len(x) for x in ids], np.int64)
        rows = []
        for members in best_fit_decreasing(length, capacity):
            row = np.full(capacity, pad_id, "<u2")
            cu = np.concatenate(([0], np.cumsum(length[members])))
            for i, a in zip(members, cu.tolist()):
                row[a : a + len(ids[i])] = ids[i]
            resets = cu if cu[-1] < capacity else cu[:-1]
            rows.append((number, row.tobytes(), int(cu[-1]), [owners[i][0] for i in members], [owners[i][1] for i in members], cu.tolist(), resets.tolist()))
            number += 1
        kinds = [pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 3]
        names = ["sequence_id", "ids", "n_tokens", "doc_ids", "pieces", "cu_seqlens", "position_resets"]
        for k in range(0, len(rows), 1000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + 1000]), kinds)], names)

    def run(batches):
        texts = loaded(PieceTexts, model_path)
        if texts.model.model.get_piece_size() > 1 << 16:
            raise ValueError("ids need more than 16 bits")
        number = TaskContext.get().partitionId() << 32
        ids, owners, held = [], [], 0
        for batch in batches:
            flat, n = texts.ids(batch.column(1))
            flat = flat.astype("<u2")
            end = np.cumsum(n)
            for doc_id, a, b in zip(batch.column(0).to_pylist(), (end - n).tolist(), end.tolist()):
                whole = np.append(flat[a:b], np.uint16(end_id))
                for p, k in enumerate(range(0, len(whole), capacity)):
                    ids.append(whole[k : k + capacity])
                    owners.append((doc_id, p))
                held += len(whole)
            if held >= BUFFER_TOKENS:
                for out in flush(ids, owners, number):
                    number += out.num_rows
                    yield out
                ids, owners, held = [], [], 0
        if ids:
            yield from flush(ids, owners, number)

    rows = docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, MATRIX)
    return materialise(rows, place)


def op8_token_matrix(spark, sf_dir):
    """Per sequence of the written matrix: its documents, pieces, cumulative lengths, resets, and the CRC-32 of the stored row."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stored = write_token_matrix(docs, public_tokenizers.path("piece_bpe_32k.model"), shared_dir(spark))
    return stored.select("sequence_id", "n_tokens", F.size("doc_ids").alias("n_segments"), "doc_ids", "pieces", "cu_seqlens", "position_resets", F.crc32("ids").alias("ids_crc32"))
