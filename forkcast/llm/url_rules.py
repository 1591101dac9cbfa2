"""URL filtering by association rules.

Fixed host and path rules judge the urls that they fit.  Those urls are also
the labelled ones: each is a basket of tokens (host labels, the registered
domain, path words, query names) and its verdict, and FP-growth mines which
token combinations go with a verdict.  Rules short of support or confidence
are pruned, and rules that a part of them already says.  Tokens with the very
same baskets are mined as one.  The rest of the urls
is matched by an inverted index: a mined rule is filed under its rarest token,
a url looks up its tokens there and checks the other tokens of what it finds.

Baskets, mining and matching are Spark ML, joins and built-in functions.
Urls are judged once each, however often they stand in the table.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forkcast.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


BASE = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """Up to the first of ``/ ? #``, A-Z lower-cased; empty for null and without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to the first of ``? #``."""
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*([^?#]*)", 1)


def base_rule(host: Column, path: Column, rules: tuple[Rule, ...] = BASE) -> Column:
    """The longest fixed rule (text, verdict) that fits, else null."""
    best = None
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        best = F.when(fits, value) if best is None else best.when(fits, value)
    return best if best is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens of a url: host labels, last two labels, path words, query names."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    words = F.filter(F.split(F.translate(path, UPPER, LOWER), r"[^a-z]+"), lambda x: x != "")
    names = F.filter(F.split(F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1), "&"), lambda x: x != "")
    tag = lambda kind, values: F.transform(values, lambda x: F.concat(F.lit(kind), x))
    domain = F.when(F.size(labels) > 1, F.array(F.concat(F.lit("domain:"), F.substring_index(host, ".", -2)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(tag("label:", labels), domain, tag("path:", words), tag("query:", F.transform(names, lambda x: F.substring_index(x, "=", 1)))))


def token_classes(labelled: DataFrame, least: float) -> DataFrame:
    """(item, n, rep): the tokens that ``least`` baskets or more have, how many
    do, and one token that stands for all with the very same baskets (told by
    two 64-bit sums over basket numbers).  Verdicts stand for themselves."""
    baskets = labelled.withColumn("basket", F.monotonically_increasing_id())
    sums = [F.sum(F.xxhash64("basket", F.lit(salt)).cast("decimal(38,0)")).alias(f"sum{salt}") for salt in (1, 2)]
    items = baskets.select("basket", F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("n"), *sums).where(F.col("n") >= least)
    same = ["n", "sum1", "sum2", F.col("item").startswith("verdict:").alias("is_verdict")]
    items = items.select("item", *same)
    reps = items.groupBy("n", "sum1", "sum2", "is_verdict").agg(F.min("item").alias("rep"))
    own = F.when(F.col("is_verdict"), F.col("item")).otherwise(F.col("rep"))
    return items.join(reps, ["n", "sum1", "sum2", "is_verdict"]).select("item", "n", own.alias("rep"))


def mine(labelled: DataFrame, min_support: float = 0.01, min_confidence: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """(rules, classes) of ``labelled`` (tokens array<string>, verdict string):
    tokens, verdict, confidence, support, rare of the rules that hold in it,
    and the ``token_classes``, by whose representatives the rules are told.

    Kept are the rules from any number of tokens, however common, to a verdict,
    unless a rule from a part of those tokens says the same at least as
    surely.  Tokens with the same baskets say the same, so one of them is mined
    for all: k words that a site puts on all its pages count as one and do not
    multiply the combinations by 2**k.  ``rare`` is the token of a rule that
    the fewest baskets have.  Of tokens above the support there are at most a
    basket's size / min_support, however large the table.
    """
    baskets = labelled.where("verdict is not null").select(F.concat("tokens", F.array(F.concat(F.lit("verdict:"), "verdict"))).alias("items"))
    total = baskets.count()
    classes = materialize(token_classes(baskets, min_support * total), "tokens")
    # Rarer tokens are in no rule.  What is left is bounded by the support.
    frequent = [r.rep for r in classes.select("rep").distinct().collect()]
    baskets = baskets.select(F.array_intersect("items", F.lit(frequent)).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    verdict = F.filter("items", lambda x: x.startswith("verdict:"))
    sets = model.freqItemsets.select(F.array_sort(F.filter("items", lambda x: ~x.startswith("verdict:"))).alias("tokens"), F.substring(F.get(verdict, F.lit(0)), 9, 100).alias("verdict"), "freq")
    # (an url has one verdict, so no set has two)
    alone = sets.where("verdict is null").select("tokens", F.col("freq").alias("of"))
    sure = sets.where("verdict is not null and size(tokens) > 0").join(alone, "tokens")
    sure = materialize(sure.select("tokens", "verdict", F.size("tokens").alias("k"), (F.col("freq") / F.col("of")).alias("confidence"), (F.col("freq") / total).alias("support")), "sets")
    # best: the surest that any part of the tokens is, from those without one token
    best = sure.where("k = 1").select("tokens", "verdict", F.col("confidence").alias("top"))
    told = sure.where("k = 1").withColumn("best", F.lit(None).cast("double"))
    for k in range(2, (sure.agg(F.max("k")).first()[0] or 0) + 1):
        level = sure.where(F.col("k") == k)
        parts = level.select(F.col("tokens").alias("whole"), "verdict", F.explode(F.transform("tokens", lambda x: F.array_remove("tokens", x))).alias("tokens"))
        over = parts.join(best, ["tokens", "verdict"]).groupBy(F.col("whole").alias("tokens"), "verdict").agg(F.max("top").alias("best"))
        level = materialize(level.join(over, ["tokens", "verdict"], "left"), "level")
        best = level.select("tokens", "verdict", F.greatest("confidence", "best").alias("top"))
        told = told.unionByName(level)
    rules = told.where(F.col("confidence") >= min_confidence).where("best is null or best < confidence").drop("k", "best")
    seen = rules.select("tokens", "verdict", "confidence", "support", F.explode("tokens").alias("item")).join(classes.select("item", "n"), "item")
    return seen.groupBy("tokens", "verdict", "confidence", "support").agg(F.min_by("item", F.struct("n", "item")).alias("rare")), classes


def match(urls: DataFrame, rules: DataFrame, classes: DataFrame) -> DataFrame:
    """url, mined: the verdict for those urls (url, tokens) that some mined
    rule fits: the surest one's, then the best supported, longest and first
    one's.  A rule fits if the url has a token of each of its classes."""
    # bounded as the frequent tokens are
    stands = {r.item: r.rep for r in classes.where("item <> rep").collect()}
    for_all = F.create_map(*[F.lit(x) for pair in stands.items() for x in pair]) if stands else None
    rep = lambda t: F.coalesce(for_all[t], t) if stands else t
    pairs = F.transform("tokens", lambda t: F.struct(rep(t).alias("rep"), t.alias("token")))
    urls = urls.select("url", pairs.alias("pairs")).select("url", "pairs", F.array_distinct(F.col("pairs.rep")).alias("reps"))
    found = (urls.select("url", "pairs", "reps", F.explode("reps").alias("rare")).join(rules.withColumnRenamed("tokens", "needed"), "rare")
             .where(F.size(F.array_except("needed", "reps")) == 0))
    # told by the url's own tokens, the last one of each class
    own = F.transform("needed", lambda r: F.array_max(F.transform(F.filter("pairs", lambda p: p["rep"] == r), lambda p: p["token"])))
    sure = F.struct("confidence", "support", F.size("needed").alias("length"), F.array_join(F.array_sort(own), " ").alias("text"), "verdict")
    return found.groupBy("url").agg(F.max(sure)["verdict"].alias("mined"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = BASE, id_col: str = "page_id", url_col: str = "url", otherwise: str = "allow",
          min_support: float = 0.01, min_confidence: float = 0.9) -> DataFrame:
    """page_id, host, path, rule, verdict; one row per input row.

    ``rule`` is the longest fixed rule that fits (else null) and gives the
    verdict; the other urls get that of the surest mined rule, or
    ``otherwise``.  A null url, or one without ``://``, has an empty host and
    path, no tokens, and so the verdict ``otherwise``.  Repeated rows get
    equal verdicts, null ids are carried through, other columns ignored.
    Without labelled urls nothing is mined; an empty table gives an empty
    result.
    """
    url = F.col("url")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.select("*", base_rule(F.col("host"), F.col("path"), rules).alias("base"))
    rows = materialize(rows.select("page_id", "url", "host", "path", F.col("base.rule").alias("rule"), F.col("base.verdict").alias("fixed")), "pages")
    tokens = tokens_of(url, F.col("host"), F.col("path")).alias("tokens")
    labelled = rows.where("fixed is not null").select(tokens, F.col("fixed").alias("verdict"))
    if labelled.limit(1).count():
        mined, classes = mine(labelled, min_support, min_confidence)
        found = match(rows.where("fixed is null and url is not null").select("url", tokens).distinct(), materialize(mined, "mined"), classes)
        # urls that are judged or null have no partner: they stay out of the join
        open_ = F.col("fixed").isNull() & F.col("url").isNotNull()
        rows = rows.where(open_).join(found, "url", "left").unionByName(rows.where(~open_).withColumn("mined", F.lit(None).cast("string")))
    else:
        rows = rows.withColumn("mined", F.lit(None).cast("string"))
    return rows.select("page_id", "host", "path", "rule", F.coalesce("fixed", "mined", F.lit(otherwise)).alias("verdict"))
