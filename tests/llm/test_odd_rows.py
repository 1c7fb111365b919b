"""Each operator and pipeline stage on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import collections
import hashlib
import random
import re
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tapeline.llm import exact_dedup, html, jaccard, langid, media, mixing, packing, tokens, urlfilter
from tapeline.llm.components import connected_components

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def brute_sets(docs, k):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for d, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        out.append((d, frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])))
    return out


def brute_jaccard(docs, k, percent):
    sets = brute_sets(docs, k)
    root, links = list(range(len(sets))), collections.Counter()

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    inverted = collections.defaultdict(list)
    for i, (_, s) in enumerate(sets):
        near = collections.Counter(j for g in s for j in inverted[g])
        for j, n in near.items():
            if 100 * n >= percent * (len(s) + len(sets[j][1]) - n):
                links[i] += 1
                links[j] += 1
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
        for g in s:
            inverted[g].append(i)
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[top(i)].append(d)
    return {d: (len(s), min(least[top(i)]), links[i]) for i, (d, s) in enumerate(sets) if d is not None}


OPERATORS = {
    "mix": lambda df: mixing.mix_sources(df),
    "media": lambda df: media.media_tracks(media.store_texts(df)),
    "tokens": lambda df: tokens.token_counts(df, PIECES),
    "jaccard": lambda df: jaccard.jaccard_join(df),
    "dedup": lambda df: exact_dedup.exact_groups(df),
    "drop": lambda df: exact_dedup.drop_copies(df),
    "matrix": lambda df: packing.write_token_matrix(df, PIECES, None),
    "pack": lambda df: packing.pack_pieces(packing.materialise(packing.token_pieces(df, WORDS))),
    "language": lambda df: langid.predict(df, langid.train(df)),
    "urls": lambda df: urlfilter.filter_urls(df.select("*", F.col("text").alias("url"))),
    "pages": lambda df: html.extract_main_text(df.select("*", F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html"))),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(none, name):
    assert OPERATORS[name](none).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_clashing_columns(odd, clashing, name):
    rows = odd.count()
    got = OPERATORS[name](clashing)
    assert len(got.columns) == len(set(got.columns))
    n = got.count()
    if name not in ("drop", "matrix", "pack"):
        assert n == rows
    if name == "drop":
        assert n == len({(d, t or "") for d, t in odd.select("doc_id", "text").collect() if True} & {(d, t) for d, t in _kept(odd)}) + 1  # doc 2 is there twice


def _kept(odd):
    top = {}
    for d, t in odd.select("doc_id", "text").collect():
        top.setdefault(t or "", []).append(d)
    return [(max((x for x in ds if x is not None), default=None), t) for t, ds in top.items()]


def test_mix_of_null_and_wordless_sources(spark, odd):
    got = {(r["doc_id"], r["source"]): r for r in mixing.mix_sources(odd).collect()}
    assert got[(4, None)]["taken"] == 0 and got[(5, "")]["target"] == 0 and got[(3, "b")]["size"] == 0
    assert all(r["taken"] <= 3 * r["size"] for r in got.values())
    again = {(r["doc_id"], r["source"]): r["taken"] for r in mixing.mix_sources(odd.repartition(3)).collect()}
    assert again == {k: r["taken"] for k, r in got.items()}


def test_mix_cuts_large_sources_by_histogram(spark):
    df = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 9 == 0, "b").otherwise("a").alias("source"), F.repeat(F.lit("w "), (F.col("id") % 40).cast("int")).alias("text"))
    by = mixing.mix_sources(df).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 20 for r in by)


def test_mix_fills_large_sources_from_all_documents(spark):
    """Large sources follow the rule as small ones do, also if the first document in order is longer than the words needed."""

    def odds(i):
        u = (int(hashlib.md5(str(i).encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        return u / (1 - u)

    giant = min(range(5001), key=odds)
    sizes = [100_000 if i == giant else 100 for i in range(5001)]
    rows = [(i, "big", "w " * n) for i, n in enumerate(sizes)] + [(9000 + i, "z", "w " * 20_000) for i in range(30)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, source string, text string"), weights=(1.0, 18.0)).filter("source = 'big'").collect()
    need = got[0]["target"]
    assert len(got) == 5001 and 20_000 < need < 100_000 and {r["copies"] for r in got} <= {0, 1}

    taken, left = set(), need
    rate = need / sum(n * n for n in sizes)
    assert rate * max(sizes) <= 1
    order = sorted(range(5001), key=lambda i: odds(i) * (1 - rate * sizes[i]) / (rate * sizes[i]))
    assert order[0] == giant
    for k in range(1 + mixing.FILLS):
        room = left
        for i in [i for i in order if i not in taken and (k == 0 or sizes[i] <= room)]:
            if sizes[i] > left:
                break
            taken.add(i)
            left -= sizes[i]
    near = [i for i in order if i not in taken and sizes[i] < 2 * left]
    taken |= {min(near, key=lambda i: sizes[i])} if near else set()
    assert {r["doc_id"] for r in got if r["copies"]} == taken
    assert abs(sum(r["taken"] for r in got) - need) <= 50


def test_mix_inclusion_rates(spark):
    """Over many equal sources, documents are taken at rates proportional to their size, the largest always."""
    sizes = [1600] + [90, 80, 70, 60, 50, 50, 40, 40, 30, 30, 20, 20, 10, 10] * 4
    sources = 200
    rows = [(s * 100 + i, f"{s:04d}", "w " * n) for s in range(sources) for i, n in enumerate(sizes)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, source string, text string"), weights=(7.0, 3.0), max_repeat=1 << 20)
    got = got.select("source", "size", F.col("copies") % 1000 - F.floor(F.col("target") / F.col("source_size")), "target", "source_size").toPandas()
    got.columns = ["source", "size", "extra", "target", "all"]
    got = got[got.source.astype(int) % 2 == 1]  # 0.6 of the source's words
    need = got.target.iloc[0]
    assert abs(need - 0.6 * sum(sizes)) < 1e-6
    rate = (need - 1600) / sum(n * n for n in sizes[1:])
    assert rate * 90 < 1 < need / sum(n * n for n in sizes) * 1600
    rates = got.groupby("size").extra.mean()
    assert rates[1600] == 1
    for n in (90, 80, 70, 60, 50, 40, 30):
        assert abs(rates[n] - rate * n) < 0.09, (n, rates[n], rate * n)


@pytest.mark.parametrize("bound, value", [("BLOCK", 8), ("BLOCK_SHINGLES", 512)])
def test_jaccard_hot_unit_is_formed_by_many_tasks(spark, monkeypatch, bound, value):
    """No task writes all members of a unit of many blocks, whether sets or shingles make it large; links are those of brute force."""
    monkeypatch.setattr(jaccard, bound, value, raising=False)
    stored = []
    monkeypatch.setattr(jaccard, "materialise", lambda df, keep=jaccard.materialise: stored.append(keep(df)) or stored[-1])
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    docs = []
    for d in range(70):
        words = list(base)
        words[rng.randrange(60)] = f"x{d % 35}"
        docs.append((d, " ".join(words)))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in jaccard.jaccard_join(spark.createDataFrame(docs, "doc_id long, text string"), 3, 80).collect()}
    finally:
        spark.conf.unset(key)
    assert got == brute_jaccard(docs, 3, 80)
    by_leader = [df for df in stored if {"leader", "fp"} <= set(df.columns) and "gram" not in df.columns]
    assert by_leader
    for df in by_leader:
        files = df.filter("fp != 0").withColumn("file", F.input_file_name()).groupBy("leader").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("file").alias("files"))
        assert files.orderBy(F.desc("n")).first()["files"] > 1


def test_target_levels(spark):
    df = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 10), (None, 500)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    assert got["a"] == 30 and got["c"] == 30 and abs(sum(got.values()) - 1520) < 1e-9
    assert abs(got[None] / 5 - got["b"] / 2) < 1e-9  # b is second (2), null fourth (5)


def test_media_round_trip_and_broken_containers(spark):
    for raw in (b"", b"x", b"y" * 64, b"z" * 65, bytes(range(256)) * 400):
        payload = media.padded(raw)
        data = media.write_media(payload)
        (track,) = media.read_media(data)
        assert len(payload) % 64 == 0 and payload and media.stored_payload(data, track) == payload and track["codec"] == "raw "
        assert all(b - a == 64 for a, b in track["keyframes"])
        for cut in (3, 20, len(data) // 2, len(data) - 5):
            media.read_media(data[:cut])
    df = spark.createDataFrame([(None,), (b"",), (b"\0\0\0\1junk",), (bytearray(media.write_media(bytes(64))),)], "media binary")
    assert [len(r["tracks"]) for r in media.media_tracks(df).collect()] == [0, 0, 0, 1]


def test_media_of_nested_and_forged_boxes(spark):
    """No input makes the reader fail or ask for more memory than the file is long."""
    import struct

    nested = b""
    for _ in range(3000):
        nested = media.box(b"moov", nested)
    assert media.read_media(nested) == []
    good = media.write_media(media.padded(b"some text " * 200))
    (track,) = media.read_media(good)
    at = good.index(b"stsz") + 8
    forged = good[:at] + struct.pack(">II", 1, 0xFFFFFFFF) + good[at + 8 :]
    assert media.read_media(forged) == []
    at = good.index(b"stss") + 12
    assert media.read_media(good[:at] + bytes(4) + good[at + 4 :]) == []  # sync samples count from 1
    at = good.index(b"co64") + 12
    assert media.read_media(good[:at] + struct.pack(">Q", len(good)) + good[at + 8 :]) == []  # bytes outside the file
    rng = random.Random(6)
    for _ in range(1500):
        data = bytearray(good)
        for _ in range(rng.randint(1, 6)):
            data[rng.choice((rng.randrange(len(data)), rng.randrange(len(data) - 700, len(data))))] = rng.choice((0, 1, 255, rng.randrange(256)))
        for t in media.read_media(bytes(data)):
            assert all(0 <= a <= b <= len(data) for k in ("keyframes", "chunk_ranges") for a, b in t[k])
    df = spark.createDataFrame([(bytearray(nested),), (bytearray(forged),), (bytearray(good),)], "media binary")
    assert [len(r["tracks"]) for r in media.media_tracks(df).collect()] == [0, 0, 1]


def test_movie_fragments():
    """Samples of fragments: explicit sizes, defaults, flags, an explicit base, and a run that follows the one before it."""
    import struct

    stbl = media.box(b"stbl", media.full_box(b"stsd", struct.pack(">I", 1), media.box(b"avc1", bytes(78))), media.full_box(b"stts", bytes(4)), media.full_box(b"stsc", bytes(4)), media.full_box(b"stsz", bytes(8)), media.full_box(b"stco", bytes(4)))
    mdia = media.box(b"mdia", media.full_box(b"mdhd", struct.pack(">IIIIHH", 0, 0, 90, 0, 0, 0)), media.box(b"minf", stbl))
    trak = media.box(b"trak", media.full_box(b"tkhd", struct.pack(">III", 0, 0, 7), bytes(68)), mdia)
    moov = media.box(b"moov", trak, media.box(b"mvex", media.full_box(b"trex", struct.pack(">IIIII", 7, 1, 10, 4, media.NOT_SYNC))))
    first = lambda at: media.box(b"moof", media.box(b"traf", media.full_box(b"tfhd", struct.pack(">I", 7)), media.full_box(b"trun", struct.pack(">IiIII", 2, at, 0, 3, 5), flags=0x205), media.full_box(b"trun", struct.pack(">I", 1))))
    size = len(first(0))
    data = moov + first(size + 8) + media.box(b"mdat", b"aaabbbbbcccc")
    base = len(data)
    second = media.box(b"moof", media.box(b"traf", media.full_box(b"tfhd", struct.pack(">IQII", 7, base - 4, 20, 2), flags=0x1 | 0x8 | 0x10), media.full_box(b"trun", struct.pack(">III", 2, 0, media.NOT_SYNC), flags=0x400)))
    (t,) = media.read_media(data + second)
    at = len(moov) + size + 8
    assert (t["n_samples"], t["duration"], t["sample_bytes"]) == (5, 70, 16)
    assert t["keyframes"] == [[at, at + 3], [base - 4, base - 2]]
    assert t["chunk_ranges"] == [[at, at + 12], [base - 4, base]]
    assert media.read_media(moov + first(10**6) + media.box(b"mdat", bytes(12))) == []


def test_sample_tables_with_several_chunks_and_sizes():
    import struct

    body = b"aabbbccccdd"
    stbl = media.box(
        b"stbl", media.full_box(b"stsd", struct.pack(">I", 1), media.box(b"avc1", bytes(78))), media.full_box(b"stts", struct.pack(">III", 1, 4, 10)), media.full_box(b"stss", struct.pack(">III", 2, 1, 3)),
        media.full_box(b"stsc", struct.pack(">IIIIIII", 2, 1, 2, 1, 2, 1, 1)), media.full_box(b"stsz", struct.pack(">IIIIII", 0, 4, 2, 3, 4, 2)), media.full_box(b"stco", struct.pack(">IIII", 3, 8, 13, 17)),
    )
    mdia = media.box(b"mdia", media.full_box(b"mdhd", struct.pack(">IIIIHH", 0, 0, 90, 40, 0, 0)), media.box(b"minf", stbl))
    (t,) = media.read_media(media.box(b"mdat", body) + media.box(b"moov", media.box(b"trak", mdia)))
    assert (t["codec"], t["timescale"], t["duration"]) == ("avc1", 90, 40)
    assert t["keyframes"] == [[8, 10], [13, 17]] and t["chunk_ranges"] == [[8, 19]]


def test_url_rules(spark):
    rows = [(1, "HTTP://X.Example.COM/en/7?q"), (2, "http://a.com/en/1"), (3, "http://example.net/de/8/"), (4, "http://b.net/de/1#x"), (5, "http://notexample.org/es"), (6, None), (7, "no scheme"), (8, "a://b://c/d"), (9, "http://com/en/"), (9, "http://com/en/"), (10, "http://o.org/es/")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("verdict", F.lit("mine")).withColumn("host", F.lit(1))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict_by"]) for r in urlfilter.filter_urls(df).collect()}
    assert got[1] == ("x.example.com", "/en/7", "example.com/en/7", "rule") and got[2][2] == "com/en/" and got[3][2] == "example.net/de/8" and got[4][2] == "net/de/"
    assert got[5][2:] == (None, "model") and got[6][:2] == ("", "") and got[7][:2] == ("", "") and got[8][:2] == ("b:", "//c/d") and got[9][2] == "com/en/" and got[10][2] == "org/es/"
    assert urlfilter.filter_urls(df).count() == len(rows)
    assert urlfilter.filter_urls(df.limit(0)).count() == 0
    one = urlfilter.filter_urls(spark.createDataFrame([(1, "http://q.q/x")], "page_id long, url string")).first()
    assert (one["verdict"], one["verdict_by"]) == ("allow", "model")


def test_url_model_learns(spark):
    random.seed(4)
    word = lambda cs: "".join(random.choice(cs) for _ in range(8))
    rows = [(i, f"http://{word('abcde')}.net/de/{word('abcde')}") for i in range(200)] + [(i, f"http://{word('vwxyz')}.com/en/{word('vwxyz')}") for i in range(200, 400)]
    rows += [(i, f"http://h.io/{word('abcde')}{word('abcde')}") for i in range(400, 450)] + [(i, f"http://h.io/{word('vwxyz')}{word('vwxyz')}") for i in range(450, 500)]
    got = {r["page_id"]: r["verdict"] for r in urlfilter.filter_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert sum(got[i] == "allow" for i in range(400, 450)) >= 48 and sum(got[i] == "block" for i in range(450, 500)) >= 48


def test_tokens_of_odd_texts(odd):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in tokens.token_counts(odd.withColumn("t", F.col("text")), PIECES).collect():
        assert r["n_tokens"] == len(model.encode(r["t"] or "")) and r["n_bytes"] == len((r["t"] or "").encode())


@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80), (2, 50)])
def test_jaccard_of_edited_copies(spark, k, percent):
    random.seed(k)
    words = [f"w{i}" for i in range(400)]
    base = [[random.choice(words) for _ in range(random.randint(3, 80))] for _ in range(6)]
    shared = [random.choice(words) for _ in range(30)]
    rows = []
    for i in range(260):
        w = list(random.choice(base))
        for _ in range(random.choice([0, 0, 1, 2, 4])):
            w[random.randrange(len(w))] = random.choice(words)
        rows.append((i, " ".join(shared + w if i % 7 == 0 else w)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), k, percent).collect()}
    assert got == brute_jaccard(rows, k, percent)


def test_jaccard_in_blocks(spark, monkeypatch):
    random.seed(9)
    base = [f"w{i}" for i in range(40)]
    sets = []
    for _ in range(120):
        w = list(base)
        w[random.randrange(40)] = f"x{random.randrange(5)}"
        sets.append(np.unique(np.array([hash((a, b)) & (1 << 63) - 1 for a, b in zip(w, w[1:])], np.uint64)))
    want = {(i, j) for i, j in combinations(range(120), 2) if (n := len(np.intersect1d(sets[i], sets[j]))) * 100 >= 85 * (len(sets[i]) + len(sets[j]) - n)}
    index = jaccard.Index(sets)
    assert {(int(j), q) for q in range(120) for j in index.partners(q, 85, 100)[0]} == want


def test_odd_jaccard(odd):
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_join(odd, 4, 85).collect()]
    by = {d: (n, c) for d, n, c in got if d is not None}
    assert by[1][1] == by[2][1] == 1 and by[6] == by[7] == (1, 6) and by[3] == (0, 3) and by[5] == (0, 5) and by[8][0] == 1


def test_components(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 2000), (2000, 5), (7000, 7001), (8, 8), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(301)) and got[1000] == got[2000] == 0 and got[7001] == got[7000] == 7000
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_blocks_and_lines():
    page = '<html><head><title>t</title></head><body><header>H</header><div class="x cookie-notice">C</div><p>open &amp; <b>bo</b>ld<p>two<br>three<script>var a="</p>"</script><article><nav>n</nav><h1>T</h1>a\n b<aside>s</aside><section class="comments">no</section><form>f</form><p>c</article><footer>F</footer>'
    assert html.blocks(page) == [("site", "H"), ("site", "C"), ("open", "open & bold"), ("open", "two"), ("open", "three"), ("site", "n"), ("main", "T"), ("main", "a b"), ("site", "s"), ("site", "no"), ("site", "f"), ("main", "c"), ("site", "F")]
    assert html.blocks(None) == html.blocks("") == [] and html.blocks("plain") == [("open", "plain")]
    random.seed(1)
    for _ in range(500):
        a, b = ([random.randint(0, 3) for _ in range(random.randint(0, 9))] for _ in range(2))
        length = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                length[i + 1][j + 1] = length[i][j] + 1 if x == y else max(length[i][j + 1], length[i + 1][j])
        line, it = [x for x, s in zip(a, html.common_lines(a, b)) if s], iter(b)
        assert len(line) == length[-1][-1] and all(x in it for x in line)


def test_articles_keep_their_wrappers_and_headings():
    assert html.blocks('<div class="page no-sidebar has-comments"><article><p>A</p></article></div>') == [("main", "A")]
    assert html.blocks('<div id="share"><p>x</p><article><div class="entry-header"><h1>T</h1></div><header><p>lead</p></header><div class="comment-list"><article>c</article></div></article></div>') == [("site", "x"), ("main", "T"), ("main", "lead"), ("site", "c")]


def brute_texts(rows):
    """Main texts by the rule in plain Python, over all pages of a host at once."""

    def parts(url):
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        return (m[1].lower(), m[2]) if m else ("", "")

    seen = {}
    for _, url, page in rows:
        seen[(*parts(url), F_xxhash64(page or ""))] = [x for _, x in html.blocks(page)]
    order = sorted(seen)
    out = {}
    for page_id, url, page in rows:
        found = html.blocks(page)
        lines = [x for _, x in found]
        at = order.index((*parts(url), F_xxhash64(page or "")))
        far = [order[at + d] for n in range(1, len(order)) for d in (-n, n) if 0 <= at + d < len(order)]
        far = [o for o in far if o[0] == order[at][0]]
        first = [o for o in far if abs(order.index(o) - at) <= html.NEAR]
        near = sorted(first, key=lambda o: -html._likeness(order[at][1], o[1])) + far[len(first) :]
        gone = set()
        for o in near:
            other = seen[o]
            length = [[0] * (len(other) + 1) for _ in range(len(lines) + 1)]
            for i, x in enumerate(lines):
                for j, y in enumerate(other):
                    length[i + 1][j + 1] = length[i][j] + 1 if x == y else max(length[i][j + 1], length[i + 1][j])
            shared, i, j = set(), len(lines), len(other)
            while i and j:
                if lines[i - 1] == other[j - 1]:
                    i, j = i - 1, j - 1
                    shared.add(i)
                elif length[i - 1][j] >= length[i][j - 1]:
                    i -= 1
                else:
                    j -= 1
            if sum(len(lines[k]) for k in shared) < 0.8 * max(sum(map(len, lines)), sum(map(len, other))):
                gone = shared
                break
        main = [x for role, x in found if role == "main"]
        out[page_id] = " ".join(main or [x for k, (role, x) in enumerate(found) if role == "open" and k not in gone])
    return out


def F_xxhash64(text):
    import xxhash

    n = xxhash.xxh64_intdigest(text.encode(), 42)  # Spark's seed
    return n - (1 << 64) if n >> 63 else n


def test_differencing_without_articles(spark, monkeypatch):
    """Pages without article elements: what neighbours share goes, also across runs; copies keep their text."""
    rng = random.Random(7)
    monkeypatch.setattr(html, "RUN", 5)
    words = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = []
    for host in ("a.org", "b.org"):
        menu = [f"<div>{host} {x}</div>" for x in ("Home page of all", "News and more", "Contact us here", "All rights are ours")]
        for i in range(30):
            body = [f"<p>{text(12)} {host}{i}.{k}</p>" for k in range(rng.randint(1, 5))]
            ad = f"<div>{text(6)}</div>" if i % 5 == 0 else ""
            rows.append((len(rows), f"http://{host}/{rng.choice(['news', 'blog'])}/{rng.randint(1, 40)}", "".join([*menu[:3], ad, *body, menu[3]])))
    rows.append((len(rows), "http://a.org/news/7b", rows[3][2]))  # a copy elsewhere
    rows.append((len(rows), rows[5][1], rows[5][2].replace("w1", "w2")))  # a near copy at the same url
    rows += [(len(rows) + k, "http://copies.org/x", "<p>the same words on all pages</p>") for k in range(12)]
    rows += [(90, None, None), (91, None, "<p>lonely"), (92, "http://long.org/", "<p>" + "word " * 50_000), (93, "http://long.org/?" + "q" * 50_000, "<article>in</article>out")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("mine"))
    got = {r["page_id"]: r["text"] for r in html.extract_main_text(df).collect()}
    want = brute_texts(rows)
    assert got == want
    site = [k for k in range(60) if "Home page" in got[k] or "rights" in got[k]]
    assert not site and all(got[k] for k in range(60)) and got[rows[62][0]] == "the same words on all pages" and got[93] == "in"
    assert html.extract_main_text(df.limit(0)).count() == 0


def test_directory_doubles(spark):
    """Buckets hold what they may, cover all slots, and the directory is as deep as its deepest bucket; with enough keys it grows."""
    depths = []
    for n, rows in ((0, 4), (3, 4), (500, 16), (4000, 16)):
        keys = spark.range(n).select(F.xxhash64("id").alias("key"))
        least, depth, directory = exact_dedup.build_directory(keys, rows)
        slots = {r["slot_no"]: r["bucket"] for r in directory.collect()}
        assert sorted(slots) == list(range(1 << depth))
        filled, local = collections.Counter(), collections.Counter(slots.values())
        for r in keys.collect():
            filled[slots[(r["key"] & (1 << 64) - 1) >> 64 - depth if depth else 0]] += 1
        assert max(filled.values(), default=0) <= rows and sum(filled.values()) == n
        assert least == min(int(b.split("/")[0]) for b in local)
        for bucket, count in local.items():
            d, prefix = map(int, bucket.split("/"))
            assert count == 1 << depth - d
            if d:  # its parent was overfull
                parent = sum(m for b, m in filled.items() if (lambda e, q: e >= d and q >> e - d in (prefix, prefix ^ 1))(*map(int, b.split("/"))))
                assert parent > rows
        depths.append(depth)
    assert depths[:2] == [0, 0] and depths[2] < depths[3]


def test_equal_keys_are_chained_by_bytes():
    import pyarrow as pa

    rows = [(7, "s1", "one", 1, 5), (7, "s2", "two", 1, 9), (7, "s1", "one", 3, 4), (7, "s2", None, 1, 3), (8, "s3", "", 1, 1)]
    out = [r for b in exact_dedup._own([pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), exact_dedup.KINDS)], exact_dedup.ENTRY)]) for r in b.to_pylist()]
    assert [(r["key"], r["slot"], r["sha"], r["keep_id"], r["group_size"]) for r in out] == [(7, 0, "s1", 5, 4), (7, 1, "s2", 9, 2), (8, 0, "s3", 1, 1)]


def test_a_task_sends_each_text_once():
    import types

    import pyarrow as pa

    batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int64(), pa.string()])], ["doc_id", "key", "text"])
    all_ = types.SimpleNamespace(value=types.SimpleNamespace(has=lambda v: v != 5))
    out = [r for b in exact_dedup._combine(all_)([batch([(3, 1, "A"), (9, 1, "A"), (None, 2, ""), (8, 5, "C")]), batch([(4, 1, "A"), (7, 2, ""), (None, 1, "A")])]) for r in b.to_pylist()]
    assert [(r["key"], r["text"], r["n"], r["top"]) for r in out] == [(1, "A", 1, 3), (2, "", 1, exact_dedup.LOW), (1, None, 3, 9), (2, None, 1, 7)]
    assert len({r["sha"] for r in out}) == 2


def test_rows_are_dropped_whatever_the_filter_lets_through(spark, monkeypatch):
    from tapeline.llm import bloom

    df = spark.range(2000).select(F.when(F.col("id") % 100 != 0, F.col("id")).alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % 7)).alias("text"))
    away = exact_dedup.materialise(df.filter("doc_id is null or doc_id % 3 = 0").select("doc_id", "text").filter("text <> 't1'"))
    want = sorted(map(str, df.exceptAll(df.filter("(doc_id is null or doc_id % 3 = 0) and text <> 't1'")).collect()))
    for bits in (29, 11):
        monkeypatch.setattr(bloom, "MOST_BITS", bits)
        assert sorted(map(str, bloom.without(df, away, [F.col("doc_id"), F.col("text")]).collect())) == want
    assert bloom.without(df, away.limit(0), [F.col("doc_id"), F.col("text")]).count() == 2000


def test_stored_index_answers_texts(spark, odd):
    """The index tells of any text whether it is there, how often, and which row stays."""
    rows, index = exact_dedup.build_index(odd)
    asked = exact_dedup.text_keys(spark.createDataFrame([(100, "one two three"), (101, "never seen"), (102, None), (103, "the cat sat on the mat and the dog sat on the log")], "doc_id long, text string"))
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.probe(asked, index).collect()}
    assert got == {100: (6, 1), 101: (None, None), 102: (14, 3), 103: (2, 3)}
    assert index.count() == rows.select("sha").distinct().count()


def test_best_fit_and_local_search():
    random.seed(3)
    for _ in range(30):
        n = np.array([random.randint(1, 100) for _ in range(random.randint(1, 60))])
        bins = packing.best_fit_decreasing(n, 100)
        better = packing.local_search(n, [list(b) for b in bins], 100)
        for found in (bins, better):
            assert sorted(i for b in found for i in b) == list(range(len(n))) and all(n[b].sum() <= 100 for b in found)
        assert len(better) <= len(bins)
    worse = [[0, 1], [2, 3], [4, 5]]  # 60 + 30, 60 + 30, 10 + 10
    assert len(packing.local_search(np.array([60, 30, 60, 30, 10, 10]), worse, 100)) == 2


@pytest.mark.parametrize("lengths, bins, kind", [
    ([60, 30, 10], [[0, 1], [2]], "move"),
    ([50, 40, 45, 45, 10], [[0, 1], [2, 3], [4]], "move"),
    ([70, 20, 60, 30, 20], [[0, 1], [2, 4], [3]], "one_for_one"),
    ([60, 36, 70, 25, 20, 20], [[0, 1], [2, 3], [4, 5]], "two_for_one"),
])
def test_exchanges_fill_bins(lengths, bins, kind):
    search = packing.Exchanges(np.array(lengths), bins, 100)
    squares = [int((search.fill**2).sum())]
    while any(search.fill[b] and search.fill[b] < 100 and search.step(b) for b in np.argsort(search.fill, kind="stable").tolist()):
        squares.append(int((search.fill**2).sum()))
    assert search.made[kind] and all(a < b for a, b in zip(squares, squares[1:]))
    assert sorted(i for b in search.bins for i in b) == list(range(len(lengths))) and search.fill.max() <= 100


def test_local_search_empties_bins():
    rng = np.random.default_rng(8)
    n = np.minimum(rng.lognormal(6.3, 0.9, 2000).astype(np.int64) + 1, 2048)
    start = packing.next_fit(n, 2048)
    search = packing.Exchanges(n, start, 2048)
    found = search.run()
    assert sorted(i for b in found for i in b) == list(range(len(n))) and all(n[b].sum() <= 2048 for b in found)
    assert len(start) > 1.1 * len(found) and len(found) <= -(-int(n.sum()) // 2048) + 2
    assert min(search.made.values()) > 0 and sum(search.made.values()) > len(start) - len(found)


def test_language_trees_are_exact_codes():
    """Code lengths equal those of prediction by partial matching in plain Python, for known and unknown bytes, across strides."""
    import math

    import pyarrow as pa

    from tapeline.llm.common import flat_bytes

    learned = {"x": ["abracadabra abracadabra", "é"], "y": ["the theme of the thesis", "then"]}
    tables = {}
    for lang, texts in learned.items():
        table = tables[lang] = collections.defaultdict(collections.Counter)
        for t in texts:
            raw = b"\n" * langid.ORDER + t.encode()
            for i in range(langid.ORDER, len(raw)):
                for k in range(langid.ORDER + 1):
                    table[raw[i - k : i]][raw[i]] += 1

    def bits(lang, text):
        raw, out = b"\n" * langid.ORDER + text.encode(), 0.0
        for i in range(langid.ORDER, len(raw)):
            for k in range(langid.ORDER, -1, -1):
                seen = tables[lang].get(raw[i - k : i])
                if seen:
                    n, d = sum(seen.values()), len(seen)
                    out -= math.log2((seen[raw[i]] or d) / (n + d))
                    if seen[raw[i]]:
                        break
            else:
                out += 8
        return out

    counts = []
    for number, texts in enumerate(learned.values()):
        gram, n = np.unique(langid.grams(*flat_bytes(pa.array(texts))), return_counts=True)
        counts.append(np.stack((np.full(len(n), number), gram.astype(np.int64), n), 1))
    trees = langid.Trees(list(learned), np.concatenate(counts))
    asked = ["", "abra", "the cadabra", "", "q\x00é漢", "theme of abracadabra " * 3, "h"]
    for stride in (langid.STRIDE, 7, 1):
        keep, langid.STRIDE = langid.STRIDE, stride
        try:
            got = trees.lengths(*flat_bytes(pa.array(asked)))
        finally:
            langid.STRIDE = keep
        assert np.allclose(got, [[bits(lang, t) for lang in learned] for t in asked], rtol=1e-5, atol=1e-4)


def test_languages_in_many_groups(monkeypatch):
    """More languages than a group holds give the same code lengths."""
    import pyarrow as pa

    from tapeline.llm.common import flat_bytes

    rng = np.random.default_rng(2)
    counts = np.concatenate([np.stack((np.full(50, k), rng.integers(0, 1 << 40, 50) & 0x0707070707, np.ones(50, np.int64)), 1) for k in range(5)])
    texts = flat_bytes(pa.array(["\x01\x02\x03\x04\x05" * 4, "\x00\x07"]))
    one = langid.Trees(list("abcde"), counts).lengths(*texts)
    monkeypatch.setattr(langid, "GROUP", 2)
    assert np.allclose(one, langid.Trees(list("abcde"), counts).lengths(*texts))


def test_undetermined_languages(odd):
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(odd, langid.train(odd)).collect()}
    assert got[3] == got[4] == got[5] == got[12] == ("und", 0.0) and got[1][0] == "en" and got[11][0] == "fr"
    empty = langid.predict(odd, langid.train(odd.limit(0)))
    assert {r["lang_pred"] for r in empty.collect()} == {"und"}
