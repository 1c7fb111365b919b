"""Exact n-gram Jaccard self-join by T-occurrence search (DivideSkip) over inverted lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import Bloom, bucket_of, filter_of, words_for
from .common import flat_bytes, materialise, mix64, shuffle_partitions, small_batches, table, text_or_empty, word_hashes, worker_memory
from .components import connected_components

#: Counters of the frequency sketch: how often shingles that fall on a counter occur. A fixed 8 MB, whatever the corpus.
SKETCH_BITS = 20
CHUNKS = 64

#: Members of a unit that are searched in one go; larger units are cut into blocks, and pairs of blocks are searched.
BLOCK = 512

#: Shingles of a block's sets together, about; a single larger set can't be cut.
BLOCK_SHINGLES = 1 << 20

#: Postings that a task gathers before it passes them on.
FLUSH = 1 << 21

#: DivideSkip's weight of a probe against a merge step.
MU = 0.05

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


class Sets:
    """The shingle sets of some texts, one behind the other: sorted 64-bit hashes, with offsets."""

    def __init__(self, texts: pa.Array, k: int):
        data, off = flat_bytes(texts)
        w, before = word_hashes(data, off)
        grams = np.zeros(max(len(w) - k + 1, 0), np.uint64)
        for j in range(k):
            grams += w[j : j + len(grams)] * _ODD[j % 8] + np.uint64(j)
        grams = np.concatenate((mix64(grams), np.zeros(k - 1, np.uint64)))[: len(w)]
        n = np.diff(before)
        for i in np.flatnonzero((n > 0) & (n < k)).tolist():  # fewer than k words are one shingle
            a, b = before[i], before[i + 1]
            grams[a] = mix64(np.array([(w[a:b] * np.resize(_ODD, b - a)).sum() ^ np.uint64(b - a)], np.uint64))[0]
        size = np.where(n < k, n > 0, n - k + 1)
        for a, b in zip(before[:-1].tolist(), (before[:-1] + size).tolist()):
            grams[a:b].sort()
        place = np.arange(len(grams)) - np.repeat(before[:-1], n)
        new = place < np.repeat(size, n)
        new[1:] &= (grams[1:] != grams[:-1]) | (place[1:] == 0)
        self.flat = grams[new]
        self.off = np.concatenate(([0], np.cumsum(new)))[before]
        self.n = np.diff(self.off)

    def __len__(self) -> int:
        return len(self.n)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.flat[self.off[i] : self.off[i + 1]]

    def sums(self, per_shingle: np.ndarray) -> np.ndarray:
        """Totals per set, modulo 2 ** 64."""
        total = np.concatenate((np.zeros(1, per_shingle.dtype), np.cumsum(per_shingle, dtype=per_shingle.dtype)))
        return total[self.off[1:]] - total[self.off[:-1]]

    def ids(self) -> np.ndarray:
        """A 64-bit fingerprint of each set, as a signed integer."""
        total = self.sums(mix64(self.flat ^ np.uint64(0x5851F42D4C957F2D))) + self.n.astype(np.uint64) * _ODD[0]
        return mix64(total).view(np.int64)


def new_sets(sets: Sets, seen: set[int]) -> tuple[list[int], np.ndarray]:
    """(which of the sets are neither empty nor among `seen`, all fingerprints); `seen` takes them in."""
    ids = sets.ids()
    out = []
    for i, (f, n) in enumerate(zip(ids.tolist(), sets.n.tolist())):
        if n and f not in seen:
            seen.add(f)
            out.append(i)
    return out, ids


class Order:
    """The global order of shingles, rarest first, as far as bounded tables tell it: any such order gives right results.

    First come shingles known to occur in one set only: of those counted (3 in 8, by their hash), the ones that the
    filter of shared shingles doesn't have. The rest follow by (sketch count, hash).
    """

    def __init__(self, sketch: np.ndarray, shared: Bloom):
        self.sketch, self.shared = sketch, shared

    def alone(self, s: np.ndarray) -> np.ndarray:
        out = counted(s)
        out[out] = ~self.shared.has(s[out] >> np.uint64(16))
        return out

    def sorted(self, s: np.ndarray) -> np.ndarray:
        """The places of shingles, rarest first."""
        return np.lexsort((s, self.sketch[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], ~self.alone(s)))

    def told_alone(self, sets: Sets, num: int, den: int) -> np.ndarray:
        """Which sets have no other one as similar: so many of their shingles occur in them only that all rarest ones do."""
        return sets.sums(self.alone(sets.flat).astype(np.int64)) >= sets.n - -(-num * sets.n // den) + 1

    def prefix(self, s: np.ndarray, num: int, den: int, all_of_it: bool = True) -> np.ndarray:
        """The rarest shingles of a set: two sets of the similarity asked for share one of them.

        A set of n needs T = ceil(num n / den) common shingles, so it can do without any T - 1: the n - T + 1 rarest are
        its short lists. Unless all_of_it, those that are known to occur in one set only are left out.
        """
        keep = len(s) - -(-num * len(s) // den) + 1
        order = self.sorted(s)[:keep]
        return s[order] if all_of_it else s[order[int(self.alone(s).sum()) :]]


def counted(s: np.ndarray) -> np.ndarray:
    return (s & np.uint64(7)) < np.uint64(3)


class Index:
    """Inverted lists over some sets, members numbered from 0."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        self.off = np.concatenate(([0], np.cumsum(self.size)))
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        ranked = flat[order]
        first = np.append(True, ranked[1:] != ranked[:-1])
        self.start = np.append(np.flatnonzero(first), len(flat))
        self.df = np.diff(self.start)
        self.post = np.repeat(np.arange(len(sets)), self.size)[order]
        self.lists = np.empty(len(flat), np.int64)
        self.lists[order] = np.cumsum(first) - 1

    def partners(self, q: int, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
        """(members before q with Jaccard of at least num / den to q, their overlaps), by DivideSkip.

        The L longest of q's lists are set apart; the others are merged, and members met at least T - L times are
        looked up in the long ones by binary search, while they can still reach T.
        """
        none = np.zeros(0, np.int64)
        own = self.lists[self.off[q] : self.off[q + 1]]
        own = own[self.df[own] > 1]
        least = -(-num * int(self.size[q]) // den)
        if len(own) < least or not len(own):
            return none, none
        own = own[np.argsort(self.df[own], kind="stable")]
        apart = min(least - 1, int(least / (MU * np.log2(max(int(self.df[own[-1]]), 2)) + 1)))
        short, long_ = own[: len(own) - apart], own[len(own) - apart :]
        n = self.df[short]
        at = np.repeat(self.start[short] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        met = self.post[at]
        met = np.sort(met[met < q], kind="stable")  # the lists are ascending runs, which this sort merges
        edge = np.flatnonzero(np.append(True, met[1:] != met[:-1])) if len(met) else none
        found, count = met[edge], np.diff(np.append(edge, len(met)))
        fits = (count >= least - apart) & (den * np.minimum(self.size[found], self.size[q]) >= num * np.maximum(self.size[found], self.size[q]))
        found, count = found[fits], count[fits]
        need = -(-num * (self.size[found] + self.size[q]) // (num + den))
        for k, t in enumerate(long_):
            if not len(found):
                return none, none
            members = self.post[self.start[t] : self.start[t + 1]]
            at = np.minimum(np.searchsorted(members, found), len(members) - 1)
            count = count + (members[at] == found)
            able = count + (len(long_) - 1 - k) >= need
            if not able.all():
                found, count, need = found[able], count[able], need[able]
        reach = count >= need
        return found[reach], count[reach]


def search_unit(sets: list[np.ndarray], block: np.ndarray, weight: np.ndarray, shingles: np.ndarray, order: Order, num: int, den: int):
    """(root, links) per member: the least member that this unit's links lead to, and the documents linked.

    A pair is counted in the one unit that has the rarest shingle that both prefixes share; it joins them wherever it is found.
    With two blocks, only pairs across them are looked for.
    """
    root = np.arange(len(sets))
    links = np.zeros(len(sets), np.int64)
    linked = np.zeros(len(sets), bool)
    index = Index(sets)
    two = block.max() != block.min()
    pairs: list[tuple[int, np.ndarray]] = []
    for q in range(1, len(sets)):
        found, _ = index.partners(q, num, den)
        if two:
            found = found[block[found] != block[q]]
        if len(found):
            pairs.append((q, found))
            linked[q] = linked[found] = True
            labels = np.append(root[found], root[q])
            if (labels != labels[-1]).any():
                root[np.isin(root, labels)] = labels.min()
    if not pairs:
        return root, links, linked

    members = np.flatnonzero(linked)
    prefixes = [order.prefix(sets[i], num, den) for i in members.tolist()]
    n = np.array([len(x) for x in prefixes])
    grams, at = np.unique(np.concatenate(prefixes), return_inverse=True)
    by_rank = order.sorted(grams)
    rank_of = np.empty(len(grams), np.int64)
    rank_of[by_rank] = np.arange(len(grams))
    here = np.isin(grams[by_rank], shingles)
    rank, owner = rank_of[at], np.repeat(members, n)
    posted = np.argsort(rank, kind="stable")
    start = np.searchsorted(rank[posted], np.arange(len(grams) + 1))
    mine = dict(zip(members.tolist(), np.split(rank, np.cumsum(n)[:-1])))
    first = np.zeros(len(sets), np.int64)
    for q, found in pairs:
        own = np.sort(mine[q])[::-1]  # from the commonest on, so that the rarest shared one is written last
        df = start[own + 1] - start[own]
        at = np.repeat(start[own] - (np.cumsum(df) - df), df) + np.arange(df.sum())
        first[owner[posted[at]]] = np.repeat(own, df)
        counted_here = found[here[first[found]]]
        links[counted_here] += weight[q]
        links[q] += weight[counted_here].sum()
    return root, links, linked


def _read_sets(docs: DataFrame, k: int) -> DataFrame:
    """One pass over the texts: rows (doc_id, n, fp), and per task the counts of its shingles by sketch counter (chunk, blob)."""
    schema = "doc_id long, n int, fp long, chunk int, blob binary"
    names = ["doc_id", "n", "fp", "chunk", "blob"]

    def run(batches):
        worker_memory("jaccard")
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            sets = Sets(batch.column(1), k)
            np.add.at(counts, (sets.flat >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), np.uint32(1))
            n = len(sets)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets.n.astype(np.int32)), pa.array(sets.ids()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
        chunks = []
        for c, part in enumerate(np.split(counts, CHUNKS)):
            at = np.flatnonzero(part)
            if len(at):  # places and counts; a counter that is 0 takes no room
                chunks.append((c, at.astype("<u2").tobytes() + part[at].astype("<u4").tobytes()))
        n = len(chunks)
        yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.array([c for c, _ in chunks], pa.int32()), pa.array([b for _, b in chunks], pa.binary())], names)

    return docs.mapInArrow(run, schema)


def _sketch(rows: DataFrame) -> np.ndarray:
    """Sums the tasks' counts, chunk by chunk. 2 ** SKETCH_BITS numbers come to the driver."""
    width = (1 << SKETCH_BITS) // CHUNKS

    def total(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = len(blob) // 6
                sums.setdefault(c, np.zeros(width, np.int64))[np.frombuffer(blob, "<u2", n)] += np.frombuffer(blob, "<u4", n, 2 * n)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["chunk", "blob"])

    spark = rows.sparkSession
    parts = rows.filter("chunk is not null").select("chunk", "blob").repartition(min(CHUNKS, shuffle_partitions(spark)), "chunk")
    out = np.zeros(1 << SKETCH_BITS, np.int64)
    for r in parts.mapInArrow(total, "chunk int, blob binary").collect():
        out[r["chunk"] * width : (r["chunk"] + 1) * width] = np.frombuffer(r["blob"], np.int64)
    return out


def _pack(blobs: list[np.ndarray], bucket: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """One row per bucket, each of the arrays cut to it and stored as bytes."""
    order = np.argsort(bucket, kind="stable")
    at = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0))
    ends = np.append(at[1:], len(bucket))
    cols = [pa.array([x[a:b].tobytes() for a, b in zip(at, ends)], pa.binary()) for x in (y[order] for y in blobs)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[order][at].astype(np.int32)), *cols], names)


def _shared_filter(docs: DataFrame, k: int, buckets: int, shingles: int) -> Bloom:
    """A Bloom filter of the counted shingles that two and more sets have.

    48 bits of each counted shingle of every set go to the task that owns its bucket; it sorts them and hands on only
    its region of the filter. 4 bits per counted shingle, 64 MB in all at most: beyond that the filter gets fuller, and
    more sets take part in the search.
    """
    words = words_for(4 * max(shingles, 1) * 3 // 8, buckets)

    def send(batches):
        seen: set[int] = set()
        held, n = [], 0
        for batch in batches:
            sets = Sets(batch.column(1), k)
            for i in new_sets(sets, seen)[0]:
                held.append(sets[i][counted(sets[i])] >> np.uint64(16))
                n += len(held[-1])
            if n > FLUSH:
                yield pack(held)
                held, n = [], 0
        if n:
            yield pack(held)

    def pack(held):
        v = np.concatenate(held)
        return _pack([(v >> np.uint64(16)).astype("<u4"), (v & np.uint64(0xFFFF)).astype("<u2")], bucket_of(v, buckets).astype(np.int64), ["bucket", "high", "low"])

    def own(batches):
        high: dict[int, list] = {}
        for batch in batches:
            for c, a, b in zip(*(x.to_pylist() for x in batch.columns)):
                high.setdefault(c, []).append((a, b))
        for c in list(high):
            parts = high.pop(c)
            v = np.concatenate([np.frombuffer(a, "<u4").astype(np.uint64) << np.uint64(16) | np.frombuffer(b, "<u2").astype(np.uint64) for a, b in parts])
            v.sort()
            v = v[1:][v[1:] == v[:-1]]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([Bloom.region(v, words).tobytes()], pa.binary())], ["bucket", "region"])

    sent = docs.mapInArrow(send, "bucket int, high binary, low binary").repartition(buckets, "bucket")
    return Bloom.collected(sent.mapInArrow(own, "bucket int, region binary"), buckets, words)


def _postings(docs: DataFrame, k: int, num: int, den: int, order, buckets: int) -> DataFrame:
    """(bucket, grams, sets): the short lists' postings, packed by bucket of shingles; equal sets of a task once."""

    def pack(grams: list[np.ndarray], owners: list[tuple[int, int]]):
        g = np.concatenate(grams)
        fp = np.repeat(np.array([f for f, _ in owners], np.int64), [n for _, n in owners])
        return _pack([g, fp], (g % np.uint64(buckets)).astype(np.int64), ["bucket", "grams", "sets"])

    def run(batches):
        seen: set[int] = set()
        grams, owners, held = [], [], 0
        for batch in batches:
            sets = Sets(batch.column(1), k)
            alone = order.value.told_alone(sets, num, den)
            some, ids = new_sets(sets, seen)
            for i in some:
                if not alone[i]:
                    grams.append(order.value.prefix(sets[i], num, den, all_of_it=False))
                    owners.append((int(ids[i]), len(grams[-1])))
                    held += len(grams[-1])
            if held > FLUSH:
                yield pack(grams, owners)
                grams, owners, held = [], [], 0
        if grams:
            yield pack(grams, owners)

    return docs.mapInArrow(run, "bucket int, grams binary, sets binary")


def _lists(batches):
    """Owner of buckets: of the lists of two and more sets (leader, gram), and (leader, fp) of their members. A list's leader is the least set in it."""
    grams, sets = [], []
    for batch in batches:
        grams += [np.frombuffer(x, np.uint64) for x in batch.column(1).to_pylist()]
        sets += [np.frombuffer(x, np.int64) for x in batch.column(2).to_pylist()]
    if not grams:
        return
    g, fp = np.concatenate(grams), np.concatenate(sets)
    del grams, sets
    order = np.lexsort((fp, g))
    g, fp = g[order], fp[order]
    once = np.append(True, (g[1:] != g[:-1]) | (fp[1:] != fp[:-1]))
    g, fp = g[once], fp[once]
    at = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
    ends = np.append(at[1:], len(g))
    many = ends - at > 1
    at, ends = at[many], ends[many]
    names = ["leader", "gram", "fp"]
    by = np.argsort(fp[at], kind="stable")  # a leader's lists follow each other, so most of its members are told once
    at, ends = at[by], ends[by]
    yield pa.RecordBatch.from_arrays([pa.array(fp[at]), pa.array(g[at].view(np.int64)), pa.nulls(len(at), pa.int64())], names)
    upto = np.cumsum(ends - at)
    start = 0
    while start < len(at):
        stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + FLUSH, "right")))
        x, y = at[start:stop], ends[start:stop]
        lead = np.repeat(fp[x], y - x)
        member = np.concatenate([fp[i:j] for i, j in zip(x, y)])
        order = np.lexsort((member, lead))
        lead, member = lead[order], member[order]
        once = np.append(True, (lead[1:] != lead[:-1]) | (member[1:] != member[:-1]))
        lead, member = lead[once], member[once]
        for k in range(0, len(lead), 50_000):
            some = lead[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.nulls(len(some), pa.int64()), pa.array(member[k : k + 50_000])], names)
        start = stop


def _units(lists: DataFrame, sizes: DataFrame, parts: int) -> tuple[DataFrame, DataFrame]:
    """A leader's lists together are a unit: (leader, fp, block, blocks) of the members, and (leader, low, high, grams) of each pair of blocks.

    Members are dealt by set, never by leader. Units of more than a block are a table of a row each, which Spark broadcasts if it is small.
    """
    members = lists.filter("fp is not null").select("leader", "fp").join(sizes, "fp").distinct()
    members = materialise(members)
    per = members.groupBy("leader").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    blocks = F.least("sets", F.greatest(F.ceil(F.col("sets") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)))
    large = materialise(per.select("leader", blocks.cast("int").alias("blocks")).filter("blocks > 1"))
    members = members.join(large, "leader", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    members = members.select("leader", "fp", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("block"), "blocks")

    heads = materialise(lists.filter("gram is not null").groupBy("leader").agg(F.collect_list("gram").alias("grams")))  # some of the leader's own shingles
    one = heads.join(large, "leader", "left_anti").select("leader", F.lit(0).alias("low"), F.lit(0).alias("high"), "grams")
    many = heads.join(large, "leader").withColumn("low", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).repartition(parts, "leader", "low")
    many = many.withColumn("high", F.explode(F.sequence(F.col("low"), F.col("blocks") - 1))).select("leader", "low", "high", "grams")
    return members, one.unionByName(many)


def _needed_sets(docs: DataFrame, members: DataFrame, bloom, k: int) -> DataFrame:
    """(fp, grams) of the sets in `members`, of which bloom is a filter, once each."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            sets = Sets(batch.column(1), k)
            some, ids = new_sets(sets, seen)
            out = [(int(ids[i]), sets[i].tobytes()) for i in np.array(some, np.int64)[bloom.value.has(ids[some].view(np.uint64))].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary())], ["fp", "grams"])

    found = docs.mapInArrow(run, "fp long, grams binary")
    return found.join(members, "fp", "left_semi").dropDuplicates(["fp"])


def _search(order, num: int, den: int):
    """Over rows sorted by (leader, low, high, fp): one T-occurrence search per unit."""
    names = ["fp", "root", "links"]

    def run(batches):
        def unit(rows):
            head = [r for r in rows if r[4] < 0]
            rows = [r for r in rows if r[4] >= 0]
            if len(rows) < 2 or not head:
                return []
            sets = [np.frombuffer(r[6], np.uint64) for r in rows]
            root, links, linked = search_unit(sets, np.array([r[4] for r in rows]), np.array([r[7] for r in rows], np.int64), np.array(head[0][5], np.int64).view(np.uint64), order.value, num, den)
            return [(rows[i][3], rows[root[i]][3], int(links[i])) for i in np.flatnonzero(linked)]

        now, rows = None, []
        for batch in batches:
            out = []
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if r[:3] != now:
                    out += unit(rows)
                    now, rows = r[:3], []
                rows.append(r)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 3)], names)
        out = unit(rows)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 3)], names)

    return run


def jaccard_join(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links of every row, under Jaccard similarity of word k-gram sets >= percent / 100.

    A-Z are lower-cased and words are runs of other characters than ASCII white space. The set is that of distinct k-word shingles; a text
    of fewer words is one shingle, and null or empty texts have empty sets, which link with nothing (component_id is
    then the row's own doc_id, n_links 0). component_id is the least doc_id that links lead to, itself included.
    n_links counts the linked documents, equal ones too. Equal texts, ties and repeated rows are members of one class,
    so each gets the same component; extra columns are ignored; an empty table gives no rows. Without doc_id a row still links others.
    A very long text is a batch of its own, of some 100 bytes a word, and its set, 8 bytes a shingle, is one cell.

    Exact but for 64-bit hashes of shingles and sets. Steps, each a Spark job over numpy blocks:
    1. texts become sets; equal sets are one class; a sketch of fixed size counts shingles (its driver copy is 8 MB), and a filter of
       at most 64 MB tells which of a fixed 3 in 8 of all shingles occur in two and more sets;
    2. by T-occurrence, a set of n that needs T common shingles keeps its n - T + 1 rarest ones as short lists; the lists
       with two and more sets are brought together, and those with the same least set are one unit;
    3. each unit's members bring their whole sets, and each is searched against the others by DivideSkip: short lists are
       merged, long ones probed by binary search. Units of more than BLOCK sets or BLOCK_SHINGLES shingles are split into
       pairs of blocks by Spark, so that no task forms a whole unit;
    4. a unit hands on one edge per linked member, and components are found by large-star and small-star rounds.
    No pairs leave a task, and no key brings more than about BLOCK * 2 sets to one search.
    """
    spark = docs.sparkSession
    num, den = percent, 100
    small_batches(spark)
    parts = shuffle_partitions(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    read = materialise(_read_sets(texts, k))
    rows = read.filter("chunk is null").select("doc_id", "n", "fp")
    total = rows.agg(F.sum("n")).first()[0] or 0
    order = spark.sparkContext.broadcast(Order(_sketch(read), _shared_filter(texts, k, parts, total)))
    classes = rows.filter("n > 0").groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("weight"))

    lists = materialise(_postings(texts, k, num, den, order, parts).repartition(parts, "bucket").mapInArrow(_lists, "leader long, gram long, fp long"))
    sizes = rows.filter("n > 0").groupBy("fp").agg(F.max("n").alias("n"))
    members, heads = _units(lists, sizes, parts)
    involved = materialise(members.select("fp").distinct())
    needed = spark.sparkContext.broadcast(filter_of(involved))
    sets = _needed_sets(texts, involved, needed, k).join(classes.select("fp", "weight"), "fp").withColumnRenamed("grams", "set")
    full = members.join(sets, "fp").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    full = full.select("leader", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "fp", "block", F.lit(None).cast("array<long>").alias("grams"), "set", "weight")
    full = full.unionByName(heads.select("leader", "low", "high", F.lit(0).cast("long").alias("fp"), F.lit(-1).alias("block"), "grams", F.lit(None).cast("binary").alias("set"), F.lit(0).cast("long").alias("weight")))
    dealt = full.repartition(parts, "leader", "low", "high").sortWithinPartitions("leader", "low", "high", "fp")
    found = materialise(dealt.mapInArrow(_search(order, num, den), "fp long, root long, links long"))
    order.destroy()  # all that follows reads stored tables
    needed.destroy()

    comp = connected_components(found, "fp", "root")
    named = comp.join(classes, comp.node == classes.fp).groupBy("component").agg(F.min("least").alias("component_id"))
    by_set = comp.join(named, "component").select(F.col("node").alias("fp"), "component_id")
    links = found.groupBy("fp").agg(F.sum("links").alias("links"))
    by_class = classes.join(by_set, "fp", "left").join(links, "fp", "left")
    by_class = by_class.select("fp", F.coalesce("component_id", "least").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    by_class = materialise(by_class)  # so that the last join's large partitions, of sets with many copies, can be split
    out = rows.filter("n > 0").join(by_class, "fp").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", "n_links")
    alone = rows.filter("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return out.unionByName(alone)


def op5_jaccard_join(spark, sf_dir):
    return jaccard_join(table(spark, sf_dir, "documents"), k=4, percent=85)
