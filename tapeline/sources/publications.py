"""Publication sources: event logs in JSON lines, archive pages, document links, and events made from `documents`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT = "struct<version:int,provider:string,model:string,generated_time:string,timestamp:string,confidence:int,prompt_version:string,summary:string,key_points:array<string>>"
IMPACT = "struct<asset_classes:array<string>,sectors:array<string>,horizon:string,direction:string,category:string,severity:string,importance:int,confidence:int>"
OFFICIAL = "title:string,publication_date:string,category:string,source:string,official_url:string,effective_date:string,content:string,pdf_url:string,attachments:array<string>"
EVENT_SCHEMA = (
    f"event_id string, official_data struct<{OFFICIAL}>, derived_data struct<ai_summary:string,ai_theme:string,market_relevance:string,keywords:array<string>,quality_score:int,impact:{IMPACT},ai_snapshots:array<{SNAPSHOT}>>, "
    "metadata struct<processing_state:string,lifecycle_status:string,created_at:string,updated_at:string,lifecycle:string,status:string,collected_at:string>, "
    "title string, publication_date string, published_at string, category string, source string, official_url string, url string, effective_date string, content string, summary string, pdf_url string, attachments array<string>, "
    "ai_summary string, ai_theme string, keywords array<string>, lifecycle string, status string, collected_at string, _corrupt_record string"
)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Events from JSON lines in the nested layout or the old flat one; old names stand in where the new ones are null. Corrupt lines keep their text in _corrupt_record and lack an id."""
    raw = spark.read.schema(EVENT_SCHEMA).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    c = F.coalesce
    official = F.struct(
        c("official_data.title", "title").alias("title"), c("official_data.publication_date", "publication_date", "published_at").alias("publication_date"), c("official_data.category", "category").alias("category"),
        c("official_data.source", "source").alias("source"), c("official_data.official_url", "official_url", "url").alias("official_url"), c("official_data.effective_date", "effective_date").alias("effective_date"),
        c("official_data.content", "content", "summary").alias("content"), c("official_data.pdf_url", "pdf_url").alias("pdf_url"), c("official_data.attachments", "attachments", F.array().cast("array<string>")).alias("attachments"),
    )
    snapshots = F.transform(c("derived_data.ai_snapshots", F.array().cast(f"array<{SNAPSHOT}>")), lambda s: s.withField("generated_time", c(s["generated_time"], s["timestamp"])))
    derived = F.struct(
        c("derived_data.ai_summary", "ai_summary").alias("ai_summary"), c("derived_data.ai_theme", "ai_theme").alias("ai_theme"), F.col("derived_data.market_relevance").alias("market_relevance"),
        c("derived_data.keywords", "keywords", F.array().cast("array<string>")).alias("keywords"), c("derived_data.quality_score", F.lit(0)).alias("quality_score"), F.col("derived_data.impact").alias("impact"), snapshots.alias("ai_snapshots"),
    )
    meta = F.struct(
        c("metadata.processing_state", "metadata.lifecycle", "lifecycle", F.lit("NEW")).alias("processing_state"), c("metadata.lifecycle_status", "metadata.status", "status", F.lit("ACTIVE")).alias("lifecycle_status"),
        c("metadata.created_at", "metadata.collected_at", "collected_at").alias("created_at"), c("metadata.updated_at", "metadata.collected_at", "collected_at").alias("updated_at"),
    )
    return raw.select("event_id", official.alias("official_data"), derived.alias("derived_data"), meta.alias("metadata"), "_corrupt_record")


#: The entities that are decoded, and their characters.
ENTITIES = (
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&ndash;", "–"), ("&mdash;", "—"), ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"),
    ("&hellip;", "…"), ("&bull;", "•"), ("&euro;", "€"), ("&pound;", "£"), ("&deg;", "°"), ("&copy;", "©"), ("&reg;", "®"), ("&middot;", "·"), ("&amp;", "&"),
)


def clean_text(c: Column) -> Column:
    """No CDATA marks and tags, entities decoded, runs of white space one space, trimmed. Entities that aren't listed stay."""
    c = F.regexp_replace(F.regexp_replace(c, r"<!\[CDATA\[|\]\]>", ""), r"<[^>]+>", " ")
    for name, mark in ENTITIES:
        c = F.replace(c, F.lit(name), F.lit(mark))
    return F.trim(F.regexp_replace(c, r"\s+", " "))


DATE_HEADER = r"""(?is)<td[^>]+class=["']?tableheader["']?[^>]*>\s*<b>\s*([A-Za-z]{3}\s+\d{1,2},\s+\d{4})\s*</?b>"""
ANCHOR = r"""(?is)<a[^>]+href=['"]?([^'">\s]+)['"]?[^>]*>(.*?)</a>"""


def archive_rows(pages: DataFrame, header: str = DATE_HEADER, anchor: str = ANCHOR) -> DataFrame:
    """(page_id, url, block, day, link, title) of each link inside each date block; links before the first date header are left out.

    `header` has the date as its first group (`MMM d, yyyy`), `anchor` link and title. A page without headers has no rows.
    """
    marked = pages.select("page_id", "url", F.split(F.regexp_replace("html", header, "\u0001$1\u0002"), "\u0001").alias("parts"))
    parts = marked.select("page_id", "url", F.posexplode("parts").alias("block", "part")).filter("block > 0")
    day = F.try_to_date(F.regexp_replace(F.element_at(F.split("part", "\u0002"), 1), r"\s+", " "), "MMM d, yyyy")
    body = F.substring_index(F.col("part"), "\u0002", -1)
    rows = parts.select("page_id", "url", "block", day.alias("day"), body.alias("body")).filter("day is not null")
    found = F.arrays_zip(F.regexp_extract_all("body", F.lit(anchor), 1).alias("link"), F.regexp_extract_all("body", F.lit(anchor), 2).alias("title"))
    return rows.select("page_id", "url", "block", "day", F.inline(found)).select("page_id", "url", "block", "day", "link", clean_text(F.col("title")).alias("title"))


def page_links(pages: DataFrame, anchor: str = ANCHOR) -> DataFrame:
    """S11 without date blocks: every link of every page with its title, at its place."""
    found = F.arrays_zip(F.regexp_extract_all("html", F.lit(anchor), 1).alias("link"), F.regexp_extract_all("html", F.lit(anchor), 2).alias("title"))
    return pages.select("page_id", F.posexplode(found).alias("at", "x")).select("page_id", "at", "x.link", clean_text(F.col("x.title")).alias("title"))


#: Parts of paths that belong to the layout.
LAYOUT = ("accessibility", "utkarsh")


def best_document_link(pages: DataFrame, suffix: str = ".pdf", prefer: str = "/pdfs/", skip=LAYOUT, root: str | None = None) -> DataFrame:
    """(page_id, document): the best link whose path ends with `suffix`: not of the layout, made absolute, one under `prefer` before others, else the first. Null if there is none."""
    links = F.regexp_extract_all("html", F.lit(rf"""(?i)href=['"]?([^'" >]+{suffix.replace(".", "[.]")})['"]?"""), 1)
    good = F.filter(links, lambda x: ~F.lower(x).rlike("|".join(skip)))
    site = F.lit(root) if root else F.regexp_extract("url", r"^[a-z]+://[^/?#]+", 0)
    whole = F.transform(good, lambda x: F.when(x.startswith("http"), x).when(x.startswith("/"), F.concat(site, x)).otherwise(F.concat(site, F.lit("/"), x)))
    first = lambda xs: F.try_element_at(xs, F.lit(1))
    return pages.select("page_id", whole.alias("links")).select("page_id", F.coalesce(first(F.filter("links", lambda x: F.lower(x).contains(prefer))), first(F.col("links"))).alias("document"))


def event_id(day: Column, category: Column, url: Column) -> Column:
    """M1"""
    return F.substring(F.sha2(F.concat_ws("|", day, category, url), 256), 1, 16)


def events_from_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """M1 over the driver's `documents`: one flat event per row; the title is the first line's first 80 characters.

    Fields that documents lack are made from doc_id: the day within 30 days, the effective date, attachments, snapshots
    and their confidence. Quality comes from `labels`.
    """
    k = F.col("doc_id")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (k % 30).cast("int"))
    text = F.coalesce("text", F.lit(""))
    title = F.trim(F.substring(F.element_at(F.split(text, "\n", 2), 1), 1, 80))
    url = F.concat(F.lit("http://example.org/doc/"), k.cast("string"))
    words = F.array_sort(F.array_distinct(F.filter(F.split(F.lower(title), r"[^a-z]+"), lambda w: F.length(w) >= 7)))
    quality = labels.select(F.col("doc_id").alias("_id"), "quality")
    df = docs.select(
        k, event_id(F.date_format(day, "yyyy-MM-dd"), F.col("source"), url).alias("event_id"), title.alias("title"), text.alias("content"), F.col("source").alias("category"), F.col("lang").alias("theme"),
        F.date_format(day, "yyyy-MM-dd").alias("publication_date"), url.alias("official_url"),
        F.when(k % 4 != 0, F.date_format(F.date_add(day, (k % 45).cast("int")), "yyyy-MM-dd")).alias("effective_date"),
        F.when(k % 3 == 0, F.concat(url, F.lit(".pdf"))).alias("pdf_url"), (k % 4).cast("int").alias("attachments"), F.slice(words, 1, 5).alias("keywords"),
        F.when(k % 3 != 0, (k % 101).cast("int")).alias("confidence"), F.when(k % 5 == 0, "DRAFT").when(k % 5 == 1, "ENRICHED").when(k % 5 == 2, "VALIDATED").otherwise("ACTIVE").alias("status"),
        F.when(k % 6 != 0, F.concat(F.lit("relevance "), (k % 6).cast("string"))).alias("relevance"),
    )
    return df.join(quality, F.col("doc_id") == F.col("_id"), "left").drop("_id").withColumn("quality", F.coalesce("quality", F.lit(0)) * 100)
