"""Main text of web pages: differencing against the differing page with the nearest URL of the same host, checked by markup."""

from __future__ import annotations

import re
from html import unescape
from math import isqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.order import numbered
from .common import materialise, shuffle_partitions, small_batches, table
from .running import running
from .urlfilter import url_parts

#: Pages before and after a page, in the order of URLs, that it is compared with at first; if all are its copies, the search goes on.
NEAR = 4

#: Two pages that share this part of the longer one's characters are copies of each other.
COPY = 0.8

#: A line that articles share is the site's if at least this part of the host's differing articles do, of at least so many.
SITE, LEAST = 0.9, 10

#: Pages that a task takes together.
RUN = 256

#: Elements whose content is no text of the page; elements around the main text that are not part of it;
#: elements that hold the main text; elements that begin or end a block of text; words of class, id and role that mark site furniture.
SILENT = {"script", "style", "noscript", "template", "head", "title", "svg", "math", "iframe", "object", "canvas", "audio", "video", "textarea", "select"}
FURNITURE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "fieldset"}
MAIN = {"article", "main"}
BLOCKS = (
    {"address", "article", "aside", "blockquote", "body", "br", "caption", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6"}
    | {"head", "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
)
WORDS = (
    {"ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "masthead"}
    | {"menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo", "related", "replies", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
    | {"contentinfo", "complementary", "search"}
)
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}

NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

#: Words of class and id that stand for an article's own heading: inside one, and behind a word for an article; first words of a name
#: that say what a page lacks or has elsewhere; last words that stand for a place on the page, so that the first word tells what is there.
HEADINGS = {"header", "masthead", "banner"}
ARTICLES = {"article", "content", "entry", "post", "story"}
NOT_THIS = {"no", "has", "with", "without"}
PLACES = (
    {"area", "bar", "block", "bottom", "box", "button", "buttons", "column", "container", "dialog", "form", "icons", "inner", "item", "items", "label", "left", "link", "links"}
    | {"list", "main", "outer", "overlay", "panel", "right", "row", "section", "slot", "top", "unit", "wrap", "wrapper", "zone"}
)

KEPT, OPEN, DROPPED, MARKED = "main", "open", "site", "marked"

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
TAG_STOP = re.compile(r"[>\"']")


def _marked(attributes: str, inside: bool) -> bool:
    """Whether an element's class, id or role names site furniture: by a name's last word, or by its first if the last one is a place."""
    for found in NAMES.findall(attributes):
        for name in "".join(found).lower().split():
            parts = [w for w in re.split(r"[^a-z]+", name) if w]
            if parts and parts[0] not in NOT_THIS:
                words = WORDS - HEADINGS if inside or parts[0] in ARTICLES else WORDS
                if parts[-1] in words or parts[0] in words and parts[-1] in PLACES:
                    return True
    return False


def tags(html: str):
    """(end of the text before, name in lower case, whether it closes, attributes, place behind) of the page's tags; comments and declarations have no name.

    A tag ends at the first `>` outside quotes. Every character is looked at a bounded number of times: a `<` that no `>` follows is text, as is
    all behind it, and once a tag's quotes take in every `>` that is left, quotes count for nothing from there on. A comment without an end goes on to the end.
    The place behind a tag may be changed by sending another one.
    """
    at, last, quotes = 0, html.rfind(">"), True
    while True:
        start = html.find("<", at)
        if start < 0:
            return
        name, close, attributes = "", html.startswith("/", start + 1), ""
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            at = len(html) if end < 0 else end + 3
        elif start > last:
            return
        elif html.startswith(("!", "?"), start + 1):
            at = html.find(">", start) + 1
        else:
            found = NAME.match(html, start + 1 + close)
            if not found:
                at = start + 1
                continue
            stop = found.end()
            while quotes:
                mark = TAG_STOP.search(html, stop)
                if not mark:
                    quotes = False
                elif mark[0] == ">":
                    stop = mark.start()
                    break
                else:
                    shut = html.find(mark[0], mark.end())
                    stop = shut + 1 if shut >= 0 else mark.end()
                    quotes = shut >= 0
            if not quotes:
                stop = html.find(">", found.end())
            name, attributes, at = found[0].lower(), html[found.end() : stop], stop + 1
        at = (yield start, name, close, attributes, at) or at


class Page:
    """The blocks of a page while its tags are read. Open elements know their place, so that no tag looks through the stack."""

    def __init__(self):
        self.out: list[tuple[str, str]] = []
        self.pieces: list[str] = []
        self.stack: list[tuple[str, str]] = [("", OPEN)]
        self.places: dict[str, list[int]] = {}
        self.block_places = [0]
        self.kept = 0

    def end_block(self) -> None:
        if self.pieces:
            raw = "".join(self.pieces)
            text = " ".join((unescape(raw) if "&" in raw else raw).split())
            if text:
                role = self.stack[-1][1]
                self.out.append((DROPPED if role == MARKED else role, text))
            self.pieces.clear()

    def pop(self) -> None:
        name, role = self.stack[-1]
        if role != self.stack[-2][1]:
            self.end_block()
        self.stack.pop()
        self.places[name].pop()
        if name in BLOCKS:
            self.block_places.pop()
        self.kept -= role == KEPT

    def close(self, name: str) -> None:
        """An inline element's end tag closes nothing across a block."""
        places = self.places.get(name)
        if places and (name in BLOCKS or places[-1] > self.block_places[-1]):
            for _ in range(len(self.stack) - places[-1]):
                self.pop()

    def open(self, name: str, attributes: str) -> None:
        role = self._role(name, attributes)
        if role != self.stack[-1][1]:
            self.end_block()
        if name in ("p", "li", "td", "th", "tr", "dd", "dt", "option") and self.stack[-1][0] == name:
            self.pop()
        self.places.setdefault(name, []).append(len(self.stack))
        if name in BLOCKS:
            self.block_places.append(len(self.stack))
        self.stack.append((name, role))
        self.kept += role == KEPT

    def _role(self, name: str, attributes: str) -> str:
        role, inside = self.stack[-1][1], self.kept > 0
        if role == MARKED and name in MAIN and not inside:
            return KEPT  # a wrapper's name doesn't take an article away
        if role in (DROPPED, MARKED):
            return role
        if name in FURNITURE and not (inside and name == "header"):
            return DROPPED
        if name in MAIN:
            return KEPT
        if "=" in attributes and name not in ("html", "body") and _marked(attributes, inside):
            return MARKED
        return role


def blocks(html: str | None) -> list[tuple[str, str]]:
    """(role, text) of the page's blocks in order. Roles: main (in an article or main element, outside furniture inside it), site (in furniture), open (neither).

    References are decoded and white space inside a block is one space. A block ends where an element of BLOCKS begins or
    ends, and where furniture does, inline or not. Unclosed elements end with the element around
    them; an end tag without a start is ignored. Comments, scripts, styles and other silent elements have no text. The time
    grows with the page's length, whatever its markup.
    """
    html, page, at, unclosed = html or "", Page(), 0, set()
    found = tags(html)
    behind = None
    while True:
        try:
            start, name, close, attributes, after = found.send(behind)
        except StopIteration:
            break
        behind = None
        page.pieces.append(html[at:start])
        at = after
        if name in BLOCKS or name in SILENT:
            page.end_block()
        if not name:
            continue
        if close:
            page.close(name)
        elif name in SILENT:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at) if name not in unclosed else None
            if end:
                at = behind = end.end()
            else:
                unclosed.add(name)
                if name in ("script", "style", "textarea", "title"):
                    at = behind = len(html)
        elif name not in VOID and not attributes.endswith("/"):
            page.open(name, attributes)
    page.pieces.append(html[at:])
    page.end_block()
    return page.out


def common_lines(a: list[int], b: list[int]) -> np.ndarray:
    """Which lines of a belong to a longest common subsequence with b. Bit-parallel: a row of bits per line of a.

    Between the lines that both begin and end with, only those that both have count. Of their rows one in sqrt(n) is held, and those between are made again on the way back.
    """
    shared = np.zeros(len(a), bool)
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    shared[:head] = True
    shared[len(a) - tail :] = True
    mine, theirs = set(a[head : len(a) - tail]), set(b[head : len(b) - tail])
    x = [i for i in range(head, len(a) - tail) if a[i] in theirs]
    y = [v for v in b[head : len(b) - tail] if v in mine]
    where: dict[int, int] = {}
    for j, v in enumerate(y):
        where[v] = where.get(v, 0) | 1 << j
    full, step = (1 << len(y)) - 1, 1 + isqrt(len(x))

    def grown(row, i):  # zero bits of a row mark the places where the subsequence of the lines so far grows
        hit = row & where[a[i]]
        return ((row + hit) | (row - hit)) & full

    row, held = full, []
    for k, i in enumerate(x):
        if k % step == 0:
            held.append(row)
        row = grown(row, i)
    j = len(y)
    for n in range(len(held) - 1, -1, -1):
        part = x[n * step : (n + 1) * step]
        rows = [held[n]]
        for i in part:
            rows.append(grown(rows[-1], i))
        for i, row, upper in zip(part[::-1], rows[:0:-1], rows[-2::-1]):
            while j and row >> (j - 1) & 1:
                j -= 1
            if not j:
                return shared
            if upper >> (j - 1) & 1:  # the subsequence ends here with this line
                shared[i] = True
                j -= 1
    return shared


def marks_article(found: list[tuple[str, str]]) -> bool:
    return any(role == KEPT for role, _ in found)


def main_text(found: list[tuple[str, str]], gone) -> str:
    """Blocks whose numbers aren't in `gone`: those of the article; on a page without one, the open blocks."""
    kind, gone = KEPT if marks_article(found) else OPEN, set(gone)
    return " ".join(t for k, (role, t) in enumerate(found) if role == kind and k not in gone)


def differing(page: tuple, other: tuple) -> np.ndarray | None:
    """Which lines of a page another one shares; none if they are copies. Pages are (path, lines, their characters).

    Lines outside the article of a page that marks one count as 0 characters, so that such pages are copies if their articles are.
    """
    _, lines, size = page
    shared = common_lines(lines, other[1])
    return shared if sum(n for n, s in zip(size, shared) if s) < COPY * max(sum(size), sum(other[2])) else None


def shared_lines(page: tuple, others: list[tuple]) -> np.ndarray | None:
    """Which lines of a page the nearest differing one shares; none if all are its copies. `others` are of its host, nearest places first, the one before first.

    The one whose path is most like the page's comes first; copies of the page are passed over.
    """
    for other in sorted(others, key=lambda o: -_likeness(page[0], o[0])):
        shared = differing(page, other)
        if shared is not None:
            return shared
    return None


def _likeness(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page; text is the main text's blocks joined by a space, empty if there is none.

    Every page with text is differenced: pages stand in the order of host, path and content, and the page is aligned by longest common
    subsequence with the differing one, among the NEAR before and after it on its host, whose path is most like its own
    (see shared_lines). Where these all are its copies, the page is compared with pages farther off (see farther),
    so that only a page whose host has nothing but copies of it keeps all its text. Markup then checks what is left: site furniture goes, whether pages
    share it or not. On a page without an article, the shared lines go. On a page that marks one, what lies outside goes, and a shared line inside
    goes if most articles of the host share it; else articles quote it, and it stays (see site_articles).

    Pages travel as hashes of their blocks, equal ones of a path once; runs of RUN places, with NEAR pages around them, are
    dealt to tasks, so a host or path of any size is split. What goes is joined back to the pages by what they hold. Null html has no text;
    null and odd urls share the empty host. Very long pages are one row of a batch; n lines that a page and its neighbour both have, but for
    the first and last ones, take about 2 * n * sqrt(n) bits and a time of n * n. Equal rows get equal texts; extra columns are ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    small_batches(spark, 500)
    host, path = url_parts(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("what", F.xxhash64("html"))
    gone = site_lines(rows)
    found = rows.join(gone.withColumnsRenamed({"host": "_host", "path": "_path", "what": "_what"}), (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")) & (F.col("what") == F.col("_what")), "left")
    return found.select("page_id", "url", "html", "gone").mapInArrow(_texts, "page_id long, url string, text string, n_chars long")


def site_lines(rows: DataFrame) -> DataFrame:
    """host, path, what (a page's content) and gone: the numbers of blocks that are the site's by differencing and its check, for pages that have such."""
    parts = shuffle_partitions(rows.sparkSession)
    light = rows.select("host", "path", "what", "html").mapInArrow(_hashes, "host string, path string, what long, asks boolean, marks boolean, lines binary, size binary")
    light = light.groupBy("host", "path", "what").agg(*[F.first(c).alias(c) for c in ("asks", "marks", "lines", "size")])
    placed = numbered(light, "host", "path", "what")
    run = lambda by: F.floor((F.col("pos") + by) / RUN)
    dealt = placed.withColumn("run", F.explode(F.array_distinct(F.array(run(-NEAR), run(0), run(NEAR)))))
    dealt = dealt.select("run", "pos", (F.col("asks") & (F.col("run") == run(0))).alias("asks"), "host", "path", "what", "marks", "lines", "size")
    dealt = dealt.repartition(parts, "run").sortWithinPartitions("run", "pos")
    found = materialise(dealt.mapInArrow(_differences, f"host string, path string, what long, marks boolean, voice long, {SHARED}, pos long"))
    told = found.filter("gone is not null").drop("pos")
    pending = found.filter("gone is null").select("pos", "voice")
    if not pending.isEmpty():
        told = told.unionByName(farther(placed, pending))
    told = told.filter("size(gone) > 0")
    gone = told.filter("not marks").select("host", "path", "what", "gone").unionByName(site_articles(told.filter("marks"), found))
    return materialise(gone)  # its size is known then, so that whole pages aren't shuffled to meet few rows


def site_articles(told: DataFrame, found: DataFrame) -> DataFrame:
    """host, path, what and gone of the pages whose articles have lines of the site's: what is left of `told`, the lines that articles share.

    A line is the site's if SITE of the host's differing articles share it, of LEAST at least. An article has a voice in
    this if it differs from the page before it on its host, and equal articles have one together, so copies that follow each other count once.
    """
    heard = found.groupBy("host").agg(F.count_distinct("voice").alias("articles")).filter(F.col("articles") >= LEAST)
    lines = told.filter("voice is not null").select("host", "voice", F.explode("told").alias("line"))
    lines = lines.groupBy("host", "line").agg(F.count_distinct("voice").alias("n")).filter(F.col("n") >= SITE * LEAST)
    site = lines.join(heard, "host").filter(F.col("n") >= SITE * F.col("articles")).select("host", "line")
    asked = told.select("host", "path", "what", F.explode(F.arrays_zip("gone", "told")).alias("at")).select("host", "path", "what", F.col("at.gone").alias("gone"), F.col("at.told").alias("line"))
    return asked.join(site, ["host", "line"], "left_semi").groupBy("host", "path", "what").agg(F.collect_list("gone").alias("gone"))


def farther(placed: DataFrame, pending: DataFrame) -> DataFrame:
    """host, path, what, marks, voice, gone and told of the pending pages, whose NEAR neighbours all are their copies, for those that find a differing page.

    Pages that are copies of the page before them stand for nothing new: of each such row of copies only the first, its head, is a candidate. A page
    is compared with its own head and the heads around it, NEAR on each side, and those that differ from none of them with twice as many each
    round, until their host has no more. So a host of a million copies and one other page takes two rounds.
    """
    parts = shuffle_partitions(placed.sparkSession)
    mine = materialise(placed.join(placed.join(pending, "pos", "left_semi").select("host").distinct(), "host", "left_semi").select("host", "path", "what", "marks", "lines", "size", "pos"))
    run = F.floor(F.col("pos") / RUN)
    pairs = mine.withColumn("run", F.explode(F.array_distinct(F.array(run, F.floor((F.col("pos") + 1) / RUN)))))
    pairs = pairs.repartition(parts, "run").sortWithinPartitions("run", "pos").select("run", "pos", "host", "path", "lines", "size")
    heads = pairs.mapInArrow(_heads, "pos long, host string, head long")
    heads = materialise(running(materialise(heads), "host", [F.col("pos")], {"before": F.col("head")}).select("pos", "head", (F.col("before") + F.col("head") - 1).alias("number")))
    mine = mine.join(heads, "pos")
    candidates = materialise(mine.filter("head = 1").select("host", "number", *[F.col(c).alias(f"other_{c}") for c in ("path", "lines", "size")]))
    left = materialise(mine.join(pending, "pos").drop("head").withColumnRenamed("number", "own"))
    done, inner, outer = None, 0, NEAR + 1
    while not left.isEmpty():
        steps = F.array(*[F.lit(d) for d in range(1 - outer, outer) if abs(d) >= inner]) if outer <= 64 else F.filter(F.sequence(F.lit(1 - outer), F.lit(outer - 1)), lambda d: F.abs(d) >= inner)
        tried = left.withColumn("step", F.explode(steps)).withColumn("number", F.col("own") + F.col("step")).join(candidates, ["host", "number"])
        tried = tried.select("pos", "step", "marks", "path", "lines", "size", "other_path", "other_lines", "other_size").mapInArrow(_tried, f"pos long, likeness int, step int, {SHARED}")
        order = F.struct(-F.col("likeness"), F.abs("step"), F.col("step"))
        tried = tried.groupBy("pos").agg(F.min_by(F.struct("gone", "told"), F.when(F.col("gone").isNotNull(), order)).alias("best"))
        tried = materialise(tried.select("pos", "best.gone", "best.told"))
        told = left.join(tried.filter("gone is not null"), "pos").select("host", "path", "what", "marks", "voice", "gone", "told")
        done = told if done is None else done.unionByName(told)
        left = materialise(left.join(tried.filter("gone is null"), "pos", "left_semi"))
        inner, outer = outer, 2 * outer
    return done


def _heads(batches):
    """Rows by run and place, each run with the last page of the run before it: whether a page differs from the one before it on its host."""
    before = None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            page = _page(row)
            if row["pos"] // RUN == row["run"]:
                known = before and before[0] == row["run"] and before[1] == row["pos"] - 1 and before[2] == row["host"]
                out.append((row["pos"], row["host"], int(not known or differing(page, before[3]) is not None)))
            before = row["run"], row["pos"], row["host"], page
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.string(), pa.int64()))], ["pos", "host", "head"])


def _tried(batches):
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            page, other = _page(row), _page({k: row[f"other_{k}"] for k in ("path", "lines", "size")})
            out.append((row["pos"], _likeness(page[0], other[0]), row["step"], *_shared(page, row["marks"], differing(page, other))))
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], ["pos", "likeness", "step", "gone", "told"])


def _page(row: dict) -> tuple:
    return row["path"], np.frombuffer(row["lines"], "<u8").tolist(), np.frombuffer(row["size"], "<u4").tolist()


#: What differencing finds of a page: the numbers of its shared lines, on a page that marks an article only those inside, and these lines' hashes. gone is null where all others are copies.
SHARED = "gone array<int>, told array<long>"


def _shared(page: tuple, marks: bool, shared: np.ndarray | None) -> tuple:
    if shared is None:
        return None, None
    gone = [k for k in np.flatnonzero(shared).tolist() if page[2][k]]
    return gone, np.array([page[1][k] for k in gone], "<u8").view("<i8").tolist() if marks else None


def _voice(page: tuple, before: tuple | None) -> int | None:
    """A hash of the page's article, if it differs from the page before."""
    if before and differing(page, before) is None:
        return None
    article = np.array([line for line, n in zip(*page[1:]) if n], "<u8")
    return int(np.uint64(xxhash.xxh3_64_intdigest(article.tobytes())).view(np.int64))


def _hashes(batches):
    for batch in batches:
        asks, marks, lines, size = [], [], [], []
        for page in batch.column(3).to_pylist():
            found = blocks(page)
            asks.append(any(role in (KEPT, OPEN) for role, _ in found))
            marks.append(marks_article(found))
            lines.append(np.array([xxhash.xxh3_64_intdigest(t) for _, t in found], "<u8").tobytes())
            size.append(np.array([len(t) if role == KEPT or not marks[-1] else 0 for role, t in found], "<u4").tobytes())
        told = [pa.array(asks, pa.bool_()), pa.array(marks, pa.bool_()), pa.array(lines, pa.binary()), pa.array(size, pa.binary())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], *told], ["host", "path", "what", "asks", "marks", "lines", "size"])


def _differences(batches):
    """Rows by run and place; a run is compared once it is whole."""
    names = ["host", "path", "what", "marks", "voice", "gone", "told", "pos"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int64()]

    def compare(rows):
        out, pages = [], {}
        for k, row in enumerate(rows):
            pages.pop(k - NEAR - 1, None)
            if row["asks"]:
                around = [k, *[k + d for n in range(1, NEAR + 1) for d in (-n, n) if 0 <= k + d < len(rows) and rows[k + d]["host"] == row["host"]]]
                page, *near = [pages.get(i) or pages.setdefault(i, _page(rows[i])) for i in around]
                if near:
                    voice = _voice(page, pages[k - 1] if k - 1 in around else None) if row["marks"] else None
                    out.append((row["host"], row["path"], row["what"], row["marks"], voice, *_shared(page, row["marks"], shared_lines(page, near)), row["pos"]))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * len(names), kinds)], names)

    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["run"] != held[0]["run"]:
                yield compare(held)
                held = []
            held.append(row)
    yield compare(held)


def _texts(batches):
    for batch in batches:
        texts = [main_text(blocks(page), gone or ()) for page, gone in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def op6_main_text(spark, sf_dir):
    return extract_main_text(table(spark, sf_dir, "pages"))
