"""Language ID by prediction by partial matching: byte context trees with escapes, scored under frozen statistics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flat_bytes, materialise, small_batches, table, text_or_empty, worker_memory

#: Bytes of context: the model's order.
ORDER = 4

#: Training text per language and of all languages together, in bytes: where there is more, whole documents are picked by a hash of doc_id.
TRAIN_BYTES = 4_000_000
TRAIN_TOTAL = 16_000_000

#: One in so many picked documents is kept out of the trees and sets the limits of code lengths.
CALIBRATION = 8

#: Languages that share one set of tables.
GROUP = 8

#: Byte positions scored at a time.
STRIDE = 1 << 19

#: Bytes at which the evidence for one language over the others counts in full, however long a text is.
EVIDENCE = 64

#: Bytes of average text that are added to a text before its code length per byte is held against the limit.
PRIOR = 64

#: The limit lies MARGIN times as far above a language's average as this share of the calibration documents stays below; both as parts of the average.
QUANTILE = 0.9
MARGIN = 8.0

#: Bytes of all languages' average that are added to a language's own, so that a few documents don't set it.
SHRINK = 20_000


def _picked(docs: DataFrame, train_bytes: int, train_total: int) -> tuple[list[str], DataFrame]:
    """(languages, rows text, lang (its number), calibrate) of a bounded sample of labelled rows (doc_id, text, lang)."""
    rows = docs.filter("lang is not null and text is not null and text <> ''")
    number = F.crc32(F.concat(F.lit("t"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = rows.select("text", "lang", number.alias("h"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).collect()}  # a row per language
    langs = sorted(sizes)
    if not langs:
        return [], rows.select("text", F.lit(0).alias("lang"), F.lit(False).alias("calibrate")).limit(0)
    most = min(train_bytes, train_total / len(langs))
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(float(min(1.0, most / sizes[k]))))])
    code = F.create_map(*[x for i, k in enumerate(langs) for x in (F.lit(k), F.lit(i))])
    rows = rows.filter(F.col("h") < F.element_at(share, F.col("lang")) * float(2**32))
    return langs, rows.select("text", F.element_at(code, F.col("lang")).alias("lang"), (F.pmod(F.xxhash64("h"), F.lit(CALIBRATION)) == 0).alias("calibrate"))


def gram_counts(picked: DataFrame) -> np.ndarray:
    """Rows of [language, gram, count]; a gram is a byte with the ORDER bytes before it. Spark counts; TRAIN_TOTAL bounds what reaches the driver."""

    def count(batches):
        for batch in batches:
            data, off = flat_bytes(batch.column(0))
            lang = np.repeat(batch.column(1).to_numpy().astype(np.uint64), np.diff(off))
            found, n = np.unique(lang << np.uint64(8 * ORDER + 8) | grams(data, off), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["gram", "n"])

    got = picked.select("text", "lang").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    gram = got.column("gram").to_numpy()
    return np.stack((gram >> 8 * ORDER + 8, gram & (1 << 8 * ORDER + 8) - 1, got.column("n").to_numpy()), 1)


def grams(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Each byte, with the ORDER bytes before it above it."""
    out = data.astype(np.uint64)
    for k in range(1, ORDER + 1):
        out |= _before(data, off, k).astype(np.uint64) << np.uint64(8 * k)
    return out


def _before(data: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The byte k places before each byte of its own text; 10 (a line feed) before the text's start."""
    out = np.empty_like(data)
    out[:k] = 10
    out[k:] = data[:-k] if k else data
    starts = off[:-1]
    for j in range(k):
        at = starts + j
        out[at[at < len(out)]] = 10
    return out


class Lookup:
    """Places of distinct 64-bit keys, found by hash for many at a time."""

    def __init__(self, keys: np.ndarray):
        self.shift = np.uint64(64 - max(4, int(2 * len(keys)).bit_length()))
        h = self._hash(keys)
        self.order = np.argsort(h, kind="stable")
        self.keys = np.append(keys[self.order], np.uint64(2**64 - 1))
        self.start = np.searchsorted(h[self.order], np.arange(1 << 64 - int(self.shift), dtype=np.uint64)).astype(np.int32)
        self.most = int(np.bincount(h.astype(np.int64)).max()) if len(keys) else 0

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return (keys ^ keys >> np.uint64(15)) * np.uint64(0x9E3779B97F4A7C15) >> self.shift

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key in the table's order; -1 if it isn't there."""
        at = self.start[self._hash(keys)]
        found = np.where(self.keys[at] == keys, at, -1)
        miss = np.flatnonzero(found < 0)
        for j in range(1, self.most):
            next_ = np.minimum(at[miss] + j, len(self.keys) - 1)
            ok = self.keys[next_] == keys[miss]
            found[miss[ok]] = next_[ok]
            miss = miss[~ok]
        return found


class Contexts:
    """Frozen context trees of some languages. A symbol costs -log2(its count / (n + d)) bits after the longest context it was
    seen after, n being that context's count and d the number of its different symbols; every longer context that was seen
    costs an escape, -log2(d / (n + d)) (method C, without exclusion); a symbol never seen costs 8 bits more."""

    def __init__(self, lang: np.ndarray, gram: np.ndarray, n: np.ndarray, languages: int):
        self.levels = []
        lower = None
        for k in range(ORDER + 1):
            keys, inv = np.unique(gram.astype(np.uint64) & mask(k + 1), return_inverse=True)
            contexts, at = np.unique(keys >> np.uint64(8), return_inverse=True)
            known, ahead = Lookup(keys), Lookup(contexts)
            escape = np.zeros((len(contexts), languages), np.float32)
            cost = np.zeros((len(keys), languages), np.float32)
            under = None if lower is None else lower[0].find(keys & mask(k))
            for j in range(languages):  # a column at a time, so that the driver needs little more than the tables
                mine = lang == j
                count = np.bincount(inv[mine], n[mine], len(keys))
                total, kinds = np.bincount(at, count, len(contexts)), np.bincount(at, count > 0, len(contexts))
                all_ = np.maximum(total + kinds, 1)
                escape[:, j] = np.where(total > 0, -np.log2(np.maximum(kinds, 1) / all_), 0.0)
                below = 8.0 if lower is None else lower[1][under, j]
                cost[:, j] = np.where(count > 0, -np.log2(np.maximum(count, 1) / all_[at]), escape[at, j] + below)
            cost = cost[known.order]
            self.levels.append((known, cost, ahead, escape[ahead.order]))
            lower = known, cost
        self.languages = languages

    def costs(self, gram: np.ndarray) -> np.ndarray:
        """Bits of each gram's last byte (rows) in each language (columns)."""
        out = np.zeros((len(gram), self.languages), np.float32)
        todo = np.arange(len(gram))
        for k in range(ORDER, -1, -1):
            known, cost, ahead, escape = self.levels[k]
            part = gram[todo] & mask(k + 1)
            at = known.find(part)
            hit = at >= 0
            out[todo[hit]] += cost[at[hit]]
            todo, part = todo[~hit], part[~hit]
            if not len(todo):
                return out
            at = ahead.find(part >> np.uint64(8))
            out[todo[at >= 0]] += escape[at[at >= 0]]
        out[todo] += 8
        return out


def mask(n: int) -> np.uint64:
    return np.uint64((1 << 8 * n) - 1)


class Trees:
    """The trees of all languages, in groups; `average` and `limit` are code lengths per byte, of calibration documents."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        self.groups = []
        for a in range(0, len(langs), GROUP):
            mine = (counts[:, 0] >= a) & (counts[:, 0] < a + GROUP)
            self.groups.append(Contexts(counts[mine, 0] - a, counts[mine, 1], counts[mine, 2], min(GROUP, len(langs) - a)))
        self.average, self.limit = np.zeros(len(langs)), np.full(len(langs), np.inf)

    def lengths(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Code length in bits of every text (rows) in every language (columns). All bytes are coded, STRIDE at a time."""
        total = np.zeros((len(off) - 1, len(self.langs)))
        for a in range(0, len(data), STRIDE):
            b = min(a + STRIDE, len(data))
            lead = min(a, ORDER)
            starts = off[(off > a - lead) & (off < b)] - (a - lead)
            gram = grams(data[a - lead : b], np.append(starts, b - a + lead))[lead:]
            edges = np.unique(np.concatenate(([0], off[(off > a) & (off < b)] - a)))
            owner = np.searchsorted(off, edges + a, "right") - 1
            for g, group in enumerate(self.groups):
                sums = np.add.reduceat(group.costs(gram), edges, axis=0, dtype=np.float64)
                np.add.at(total[:, g * GROUP : g * GROUP + group.languages], owner, sums)
        return total


def train(docs: DataFrame, train_bytes: int = TRAIN_BYTES, train_total: int = TRAIN_TOTAL) -> Trees:
    """Trees from rows (doc_id, text, lang), and the limits of code lengths per byte from documents kept out of them."""
    spark = docs.sparkSession
    small_batches(spark)
    langs, picked = _picked(docs, train_bytes, train_total)
    if not langs:
        return Trees([], np.zeros((0, 3), np.int64))
    trees = Trees(langs, gram_counts(picked.filter("not calibrate")))
    shared = spark.sparkContext.broadcast(trees)

    def measure(batches):
        for batch in batches:
            data, off = flat_bytes(batch.column(0))
            lang = batch.column(1).to_numpy()
            bits = shared.value.lengths(data, off)[np.arange(len(lang)), lang]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(np.diff(off)), pa.array(bits)], ["lang", "n", "bits"])

    measured = materialise(picked.filter("calibrate").select("text", "lang").mapInArrow(measure, "lang int, n long, bits double"))
    shared.destroy()
    sums = {r["lang"]: (r["bits"], r["n"]) for r in measured.groupBy("lang").agg(F.sum("bits").alias("bits"), F.sum("n").alias("n")).collect()}  # a row per language
    if not sums:
        return trees
    pooled = sum(b for b, _ in sums.values()) / sum(n for _, n in sums.values())
    for k in range(len(langs)):
        bits, n = sums.get(k, (0.0, 0))
        trees.average[k] = (bits + SHRINK * pooled) / (n + SHRINK)
    average = F.element_at(F.array(*[F.lit(float(x)) for x in trees.average]), F.col("lang") + 1)
    high = measured.agg(F.percentile_approx((F.col("bits") + PRIOR * average) / (F.col("n") + PRIOR) / average, QUANTILE)).first()[0]
    trees.limit = trees.average * (1 + MARGIN * max(high - 1, 0.02))
    return trees


def predict(docs: DataFrame, trees: Trees) -> DataFrame:
    """docs with lang_pred, score, bits_per_byte and excess.

    Every byte of every text is coded. The score is the probability of lang_pred under equal priors, from code lengths
    scaled to EVIDENCE bytes where the text is longer, times limit / code length per byte where that is above the limit.
    excess is the code length per byte, smoothed by PRIOR average bytes, over the limit: above 1, the text is coded worse than
    nearly all documents of that language, so it is in none that was learned. Null and empty texts, and texts without any letter,
    are `und` with score 0; so is everything when there was nothing to learn from. Ties go to the first language in
    code point order. The trees are broadcast; TRAIN_TOTAL bounds them, whatever the number of languages. Very long texts
    are coded in strides. All rows and columns stay, repeated or not; columns named like the results are replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    made = ("lang_pred", "score", "bits_per_byte", "excess")
    docs = docs.select(*[c for c in docs.columns if c not in made])
    shared = spark.sparkContext.broadcast(trees)
    column = docs.columns.index("text")
    lettered = docs.withColumn("_letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))

    def run(batches):
        worker_memory("language")
        trees = shared.value
        for batch in batches:
            data, off = flat_bytes(batch.column(column))
            n = np.diff(off)
            ok = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool) & (n > 0)
            pred, score, per_byte, excess = np.full(len(n), "und", object), np.zeros(len(n)), np.zeros(len(n)), np.zeros(len(n))
            if trees.langs and ok.any():
                bits = trees.lengths(data, off)
                best = bits.argmin(1)
                least = bits[np.arange(len(n)), best]
                scale = np.minimum(1.0, EVIDENCE / np.maximum(n, 1))
                odds = np.exp2(-np.minimum((bits - least[:, None]) * scale[:, None], 1000)).sum(1)
                pred = np.where(ok, np.array(trees.langs, object)[best], "und")
                over = (least + PRIOR * trees.average[best]) / (n + PRIOR) / trees.limit[best]
                score, per_byte, excess = (np.where(ok, x, 0.0) for x in (1 / odds / np.maximum(over, 1), least / np.maximum(n, 1), over))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(pred, pa.string()), pa.array(score), pa.array(per_byte), pa.array(excess)], [*batch.schema.names[:-1], *made])

    schema = docs.schema.add("lang_pred", "string").add("score", "double").add("bits_per_byte", "double").add("excess", "double")
    return lettered.mapInArrow(run, schema)


def held_out(doc_id="doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def op10_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    trees = train(docs.filter(~held_out()))
    found = predict(docs.select("doc_id", "text"), trees)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits_per_byte", "excess")
