"""The Merkle manifest against plain Python: odd rows, repeated ids, lone leaves, deep trees, tampered and untouched texts."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tapeline.llm import merkle
from tapeline.llm.running import running

LOW = str.maketrans(merkle.UPPER, merkle.LOWER)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def grow(hashes):
    """Levels from the leaves up."""
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def climb(trees, place, leaf):
    """(siblings, top) of a leaf put in the place of the stored one."""
    proof = []
    for level in trees[:-1]:
        run = level[place // 16 * 16 : place // 16 * 16 + 16]
        k = place % 16
        proof += run[:k] + run[k + 1 :]
        leaf = h(*run[:k], leaf, *run[k + 1 :])
        place //= 16
    return proof, leaf


def brute(docs, tamper):
    """Rows of docs as (doc_id, source, lang, n_chars, text)."""
    by = {}
    for d in docs:
        changed = (*d[:4], tamper(d))
        by.setdefault(d[1], []).append((d[0], h(*map(enc, d)), h(*map(enc, changed))))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    trees = {s: grow([r[1] for r in by[s]]) for s in order}
    top = grow([trees[s][-1][0] for s in order])
    out = []
    for t, s in enumerate(order):
        for place, (doc_id, leaf, told) in enumerate(by[s]):
            a, sub = climb(trees[s], place, told)
            b, root = climb(top, t, sub)
            out.append((doc_id, leaf, trees[s][-1][0], top[-1][0], h(*a, *b), root, root == top[-1][0]))
    return sorted(out, key=str)


def lowered(d):
    chosen = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 5 == 0
    return d[4].translate(LOW) if chosen and d[4] is not None else d[4]


def got(df):
    text = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.translate("text", merkle.UPPER, merkle.LOWER)).otherwise(F.col("text"))
    return sorted(map(tuple, merkle.manifest(df, text).collect()), key=str)


def rows(df):
    return [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_odd_rows_equal_plain_python(odd, clashing):
    want = brute(rows(odd), lowered)
    assert got(odd) == want and got(clashing) == want and got(odd.repartition(5)) == want


def test_empty_table(none):
    assert merkle.manifest(none).count() == 0


@pytest.mark.parametrize("n", [1, 2, 16, 17, 257])
def test_trees_of_all_heights(spark, n):
    """A hot source of n leaves beside lone ones: sources of different heights, and a top of two levels."""
    made = [(i, "hot", "en", i, f"Text {i}") for i in range(n)] + [(10_000 + i, f"s{i:03}", None, None, f"Lone {i}") for i in range(20)]
    df = spark.createDataFrame(made, "doc_id long, source string, lang string, n_chars long, text string")
    assert got(df) == brute(made, lowered)
    assert {r["verified"] for r in merkle.manifest(df).collect()} == {True}


def test_one_source_alone(spark):
    made = [(i, None, "en", i, "T") for i in range(40)]
    df = spark.createDataFrame(made, "doc_id long, source string, lang string, n_chars long, text string")
    assert got(df) == brute(made, lowered)


def test_only_changed_texts_fail(spark, documents):
    found = merkle.manifest(documents, F.when(F.col("doc_id") == 7, F.concat("text", F.lit("!"))).otherwise(F.col("text"))).filter("not verified").collect()
    assert [r["doc_id"] for r in found] == [7]


def test_running_sums_over_ranges(spark):
    """One key holds most rows and lies over several ranges; keys that begin, end and fill ranges add up as in one list."""
    made = [("hot", i, i % 7) for i in range(3000)] + [(f"k{i % 50}", i, 1) for i in range(500)]
    df = spark.createDataFrame(made, "k string, o long, v long").repartition(7)
    spread = running(df, "k", [F.col("o")], {"at": F.lit(1).cast("long"), "sum": F.col("v")}).collect()
    seen = {}
    for k, o, v in sorted(made, key=lambda r: (r[0], r[1])):
        seen.setdefault(k, []).append((o, v))
    want = {(k, o): (i, sum(v for _, v in all_[:i])) for k, all_ in seen.items() for i, (o, _) in enumerate(all_)}
    assert {(r["k"], r["o"]): (r["at"], r["sum"]) for r in spread} == want
