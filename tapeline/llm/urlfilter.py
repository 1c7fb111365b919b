"""URL filter: host and path rules, then the ratio of two character language models. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

#: (verdict, host and the start of the path): the rules of op3.
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Symbols of the models: 26 letters, 0 for any digit, five marks, ~ for anything else, $ at the end; ^ pads the start.
#: With 3 characters of context there are at most 35 ** 4 (1.5 million) grams, whatever the number of urls.
MARKS = "./-_?"
ORDER = 3

#: Weight of the shorter context against a longer one's count.
STRENGTH = 2.0
ALPHABET = 34.0

#: Log-likelihoods are summed in millionths and compared in hundredths of a nat per character, so results don't depend on the order of sums.
FINE = 1e6
BINS = 100.0

#: First digits of a url's MD5 by which a quarter of the ruled urls is kept from the models, to calibrate their threshold.
HELD_OUT = ("0", "1", "2", "3")


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url: after the first `://`; both empty if there is none or the url is null."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    there = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(there, pattern, 1), UPPER, LOWER), F.regexp_extract(there, pattern, 2)


def match_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(verdict, rule) of the longest rule that fits the host or a domain above it and the path's start; nulls if none does. Rules are a short list."""
    verdict, name = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block", r[1])):
        domain, _, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(f"/{rest}")
        verdict, name = F.when(fits, F.lit(kind)).otherwise(verdict), F.when(fits, F.lit(rule)).otherwise(name)
    return verdict, name


def _symbols(url: Column) -> Column:
    body = F.regexp_replace(F.translate(url, UPPER, LOWER), r"(?s)^.*?://", "")
    body = F.regexp_replace(F.translate(body, "123456789", "000000000"), r"(?s)[^a-z0./\-_?]", "~")
    return F.concat(F.lit("^" * ORDER), body, F.lit("$"))


def url_grams(urls: DataFrame) -> DataFrame:
    """(url, ruled, held, gram): each symbol with the ORDER before it."""
    text = urls.select("url", "ruled", "held", _symbols(F.col("url")).alias("s"))
    at = F.explode(F.sequence(F.lit(1), F.length("s") - ORDER)).alias("at")
    return text.select("url", "ruled", "held", "s", at).select("url", "ruled", "held", F.substring(F.col("s"), F.col("at"), F.lit(ORDER + 1)).alias("gram"))


def gram_scores(grams: DataFrame) -> DataFrame:
    """(gram, gain): log-likelihood ratio of accepted to rejected, in millionths, from rows (gram, accepted, rejected).

    Each class has a variable-order model: the count of a symbol after its 3 characters is smoothed by its probability
    after 2, that by the one after 1, then after none, then by the uniform one.
    """
    totals = grams.agg(F.sum("accepted").alias("all_accepted"), F.sum("rejected").alias("all_rejected"))
    grams = grams.crossJoin(F.broadcast(totals))  # one row
    gain = F.lit(0.0)
    for name, sign in (("accepted", 1.0), ("rejected", -1.0)):
        p = F.lit(1.0 / ALPHABET)
        for k in range(ORDER + 1):
            ends = Window.partitionBy(F.substring("gram", ORDER + 1 - k, k + 1))
            context = F.sum(name).over(Window.partitionBy(F.substring("gram", ORDER + 1 - k, k))) if k else F.col(f"all_{name}")
            p = (F.sum(name).over(ends) + STRENGTH * p) / (context + STRENGTH)
        gain = gain + sign * F.ln(p)
    return grams.select("gram", F.round(gain * FINE).cast("long").alias("gain"))


def filter_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """pages' columns, then host, path, rule, verdict (allow or block), verdict_by (rule or model) and score_bin.

    The longest rule that fits decides. The urls that rules decide also train two character models, accepted and
    rejected, but for a quarter of them, by a hash of the url, which calibrates: every other url is allowed if its log-likelihood
    difference per character, in hundredths of a nat, reaches the threshold at which the calibrating urls' verdicts are told best
    (largest sum of the two classes' rates of right verdicts; the middle of such thresholds). Where no accepted or no rejected url
    calibrates, all ruled ones do; if only one class was seen it is everyone's verdict, and with none all are allowed. Equal urls get
    equal verdicts; urls are scored once each, whole, however long. A null url scores as an empty one.
    Rows stay as they are, repeated or not; columns named like the results are replaced; an empty table gives no rows.

    The gram table is bounded by the symbols (35 ** 4), so it is broadcast; the grams of a url are summed before they
    are shuffled.
    """
    made = ("host", "path", "rule", "verdict", "verdict_by", "score_bin")
    keep = [c for c in pages.columns if c not in made]
    host, path = url_parts(F.col("url"))
    judged = pages.select(F.struct(*keep).alias("row"), F.coalesce("url", F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    verdict, rule = match_rule(F.col("host"), F.col("path"), rules)
    judged = judged.withColumn("rule", rule).withColumn("ruled", verdict)
    urls = judged.groupBy("url").agg(F.first("ruled").alias("ruled")).withColumn("held", F.substring(F.md5("url"), 1, 1).isin(*HELD_OUT))

    grams = url_grams(urls)
    counts = grams.groupBy("gram").agg(F.count_if(F.expr("ruled = 'allow' and not held")).alias("accepted"), F.count_if(F.expr("ruled = 'block' and not held")).alias("rejected"))
    scores = grams.join(F.broadcast(gram_scores(counts)), "gram").groupBy("url", "ruled", "held").agg(F.sum("gain").alias("gain"), F.count(F.lit(1)).alias("n"))
    scores = scores.select("url", "ruled", "held", F.floor(F.col("gain") / F.col("n") / (FINE / BINS)).cast("long").alias("score_bin"))
    scores = scores.crossJoin(F.broadcast(_threshold(scores)))
    by_model = F.when(F.col("score_bin") >= F.col("threshold"), F.lit("allow")).otherwise(F.lit("block"))
    scores = scores.select("url", "score_bin", by_model.alias("told"))
    out = judged.join(scores, "url")
    return out.select("row.*", "host", "path", "rule", F.coalesce("ruled", "told").alias("verdict"), F.when(F.col("ruled").isNull(), F.lit("model")).otherwise(F.lit("rule")).alias("verdict_by"), "score_bin")


def _threshold(scores: DataFrame) -> DataFrame:
    """One row: the bin from which on urls are allowed. Scores are grouped by bin first, of which there are a few thousand at most."""
    low, high = F.lit(-(2**62)), F.lit(2**62)
    count = lambda kind, held: F.count_if(F.expr(f"ruled = '{kind}'" + held))
    hist = scores.groupBy("score_bin").agg(*[count(kind, held).alias(name) for kind, held, name in (("allow", " and held", "good_held"), ("block", " and held", "bad_held"), ("allow", "", "good_all"), ("block", "", "bad_all"))])
    by = Window.partitionBy(F.lit(0)).orderBy("score_bin")
    whole = Window.partitionBy(F.lit(0))
    enough = (F.sum("good_held").over(whole) > 0) & (F.sum("bad_held").over(whole) > 0)
    hist = hist.withColumn("enough", enough).select("score_bin", *[F.when(F.col("enough"), F.col(f"{c}_held")).otherwise(F.col(f"{c}_all")).alias(c) for c in ("good", "bad")])
    hist = hist.withColumn("goods", F.sum("good").over(whole)).withColumn("bads", F.sum("bad").over(whole))
    below = by.rowsBetween(Window.unboundedPreceding, -1)
    right = F.col("bads") * (F.col("goods") - F.coalesce(F.sum("good").over(below), F.lit(0))) + F.col("goods") * F.coalesce(F.sum("bad").over(below), F.lit(0))
    whole_best = hist.withColumn("right", right).withColumn("most", F.max("right").over(whole)).agg(
        F.max("goods").alias("goods"), F.max("bads").alias("bads"), F.min(F.when(F.col("right") == F.col("most"), F.col("score_bin"))).alias("from"), F.max(F.when(F.col("right") == F.col("most"), F.col("score_bin"))).alias("to")
    )
    middle = F.floor((F.col("from") + F.col("to")) / 2)
    return whole_best.select(F.when((F.col("bads") > 0) & (F.col("goods") > 0), middle).when(F.col("bads") > 0, high).otherwise(low).cast("long").alias("threshold"))


def op3_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "verdict_by", "score_bin")


def _prob_sql(name: str) -> str:
    p = f"(1.0::double / {ALPHABET}::double)"
    for k in range(ORDER + 1):
        ends = f"over (partition by substr(gram, {ORDER + 1 - k}, {k + 1}))"
        context = f"over (partition by substr(gram, {ORDER + 1 - k}, {k}))" if k else "over ()"
        p = f"((sum({name}) {ends} + {STRENGTH}::double * {p}) / (sum({name}) {context} + {STRENGTH}::double))"
    return p


ORACLE = rf"""
with u as (select page_id, coalesce(url, '') as url,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') as host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) as path from pages),
rules(kind, rule) as (values {", ".join(f"('{k}', '{r}')" for k, r in RULES)}),
fit as (select u.url, arg_max(kind, length(rule)) as ruled, arg_max(rule, length(rule)) as rule from (select distinct url, host, path from u) u, rules
    where (host = split_part(rule, '/', 1) or ends_with(host, '.' || split_part(rule, '/', 1))) and starts_with(path, substr(rule, strpos(rule, '/'))) group by u.url),
urls as (select d.url, fit.ruled, substr(md5(d.url), 1, 1) in ({", ".join(f"'{x}'" for x in HELD_OUT)}) as held, '^^^' || regexp_replace(translate(regexp_replace(translate(d.url, '{UPPER}', '{LOWER}'), '(?s)^.*?://', ''), '123456789', '000000000'), '(?s)[^a-z0./\-_?]', '~', 'g') || '$' as s
    from (select distinct url from u) d left join fit on d.url = fit.url),
grams as (select url, ruled, held, substr(s, pos, {ORDER + 1}) as gram from (select url, ruled, held, s, unnest(range(1, length(s) - {ORDER} + 1)) as pos from urls)),
counts as (select gram, count(*) filter (where ruled = 'allow' and not held) as accepted, count(*) filter (where ruled = 'block' and not held) as rejected from grams group by gram),
gains as (select gram, round((0.0 + 1.0::double * ln({_prob_sql("accepted")}) + -1.0::double * ln({_prob_sql("rejected")})) * {FINE}::double)::bigint as gain from counts),
scores as (select url, ruled, held, floor(sum(gain)::double / count(*) / {FINE / BINS}::double)::bigint as score_bin from grams join gains using (gram) group by url, ruled, held),
enough as (select count(*) filter (where ruled = 'allow' and held) > 0 and count(*) filter (where ruled = 'block' and held) > 0 as ok from urls),
hist as (select score_bin, count(*) filter (where ruled = 'allow' and (held or not ok)) as good, count(*) filter (where ruled = 'block' and (held or not ok)) as bad from scores, enough group by score_bin),
cum as (select *, sum(good) over () as goods, sum(bad) over () as bads, coalesce(sum(good) over (order by score_bin rows between unbounded preceding and 1 preceding), 0) as below_good,
    coalesce(sum(bad) over (order by score_bin rows between unbounded preceding and 1 preceding), 0) as below_bad from hist),
rt as (select score_bin, bads * (goods - below_good) + goods * below_bad as points from cum),
best as (select floor((min(score_bin) + max(score_bin)) / 2)::bigint as score_bin from rt where points = (select max(points) from rt)),
cutoff as (select case when max(bads) > 0 and max(goods) > 0 then (select score_bin from best) when max(bads) > 0 then 4611686018427387904 else -4611686018427387904 end as threshold from cum)
select u.page_id, u.host, u.path, fit.rule, coalesce(fit.ruled, case when scores.score_bin >= cutoff.threshold then 'allow' else 'block' end) as verdict,
    case when fit.ruled is null then 'model' else 'rule' end as verdict_by, scores.score_bin
from u join scores on u.url = scores.url left join fit on u.url = fit.url, cutoff
"""
