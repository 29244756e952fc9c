"""URL filter: rules for known hosts, and a ratio of character language models for all other URLs (native)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerspark.llm import base

#: (verdict, host, path) of the rules: fixed values of the query's contract.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: A sign is judged by up to so many signs before it; the signs before a URL's start are ``START``.
ORDER, START = 5, "^"
#: Log ratios are whole millionths, so that sums do not depend on their order; a step of the calibration is a hundredth.
UNIT, STEP = 1_000_000, 10_000
#: The labelled URLs whose MD5 as hex is less than this (3 of 16) calibrate a model of the others.
ASIDE = "3"
#: The most frequent grams are looked up in a broadcast table of so many rows; no other gram is a hot key of the join.
FREQUENT = 16_384
#: The four counts of a gram: of all labelled URLs, and of those that are not set aside.
COUNTS = ("allow", "block", "allow_part", "block_part")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(rules: list[tuple[str, str, str]], host: Column, path: Column) -> Column:
    """The longest fitting rule as struct (rule, verdict), null if none fits; of equally long ones a block comes first."""
    kind = "struct<rule:string,verdict:string>"
    found = F.when(F.lit(False), F.lit(None).cast(kind))
    for verdict, own, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r)):
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(start)
        found = found.when(fits, F.struct(F.lit(own + start).alias("rule"), F.lit(verdict).alias("verdict")))
    return found


def grams(url: Column) -> Column:
    """For each sign of the whole URL the ``ORDER`` signs before it and the sign itself, as they are written; none for null."""
    signs = F.regexp_extract_all(F.concat(F.lit(START * ORDER), F.coalesce(url, F.lit(""))), F.lit("(?s)."), F.lit(0))
    each = F.transform(F.sequence(F.lit(1), F.size(signs) - ORDER), lambda i: F.array_join(F.slice(signs, i, ORDER + 1), ""))
    return F.when(F.size(signs) > ORDER, each).otherwise(F.array().cast("array<string>"))


def count(found: DataFrame) -> DataFrame:
    """(gram, the four counts, uses) from columns gram, verdict and aside; grams of URLs without a verdict count zero."""
    own = {v: F.col("verdict") == v for v in ("allow", "block")}
    return found.groupBy("gram").agg(
        *[F.count_if(F.coalesce(c, F.lit(False))).alias(v) for v, c in own.items()],
        *[F.count_if(F.coalesce(c & ~F.col("aside"), F.lit(False))).alias(f"{v}_part") for v, c in own.items()], F.count(F.lit(1)).alias("uses"))


def fit(counted: DataFrame) -> DataFrame:
    """(gram, ratio, ratio_part): the log ratio (accepted to rejected) of a gram's last sign behind the signs before it, by all labelled
    URLs and by those that are not set aside. One row for each gram that :func:`count` saw, so the table grows with the URLs.

    From no sign to ``ORDER`` signs of context each model blends its counts with the next shorter context's by Witten-Bell: the more
    different signs followed a context, the more the shorter one says; a context that was not seen leaves it to the shorter one.
    The shortest is blended with an even share for each sign in use and one more. A context's rows are at most as many as signs.
    """
    shorter = None
    for k in range(ORDER + 1):
        level = counted.groupBy(F.expr(f"right(gram, {k + 1})").alias("gram")).agg(*[F.sum(v).alias(v) for v in COUNTS])
        context = W.partitionBy(F.expr(f"left(gram, {k})"))
        level = level.select(
            "*", *[F.sum(v).over(context).alias(f"{v}_n") for v in COUNTS], *[F.count_if(F.col(v) > 0).over(context).alias(f"{v}_kinds") for v in COUNTS],
            F.count(F.lit(1)).over(context).alias("signs"))
        if shorter is None:
            level = level.select("*", *[(F.lit(1.0) / (F.col("signs") + 1)).alias(f"{v}_before") for v in COUNTS])
        else:
            level = level.join(shorter, F.expr("substring(gram, 2)") == F.col("tail"))
        blended = {v: F.when(F.col(f"{v}_n") > 0, (F.col(v) + F.col(f"{v}_kinds") * F.col(f"{v}_before")) / (F.col(f"{v}_n") + F.col(f"{v}_kinds"))).otherwise(F.col(f"{v}_before")) for v in COUNTS}
        shorter = level.select(F.col("gram").alias("tail"), *[p.alias(f"{v}_before") for v, p in blended.items()])
    ratio = {end: F.round((F.log(f"allow{end}_before") - F.log(f"block{end}_before")) * UNIT).cast("long") for end in ("", "_part")}
    return shorter.select(F.col("tail").alias("gram"), *[r.alias(f"ratio{end}") for end, r in ratio.items()])


def score(found: DataFrame, counted: DataFrame, model: DataFrame) -> DataFrame:
    """(row, total, total_part): the sums of the log ratios of a row's grams, from columns row and gram. The ``FREQUENT`` most frequent grams,
    which hold nearly all hot keys, are met by broadcast; a gram beyond them has at most one in ``FREQUENT`` of all places."""
    most = counted.orderBy(F.desc("uses"), "gram").limit(FREQUENT).select(F.col("gram").alias("often"))
    frequent = base.materialize(model.join(most, F.col("gram") == F.col("often"), "left_semi").withColumnRenamed("gram", "often"), "url-frequent")
    often = F.broadcast(frequent)
    sums = [F.sum(f"ratio{end}").alias(f"total{end}") for end in ("", "_part")]
    hot = found.join(often, F.col("gram") == F.col("often")).groupBy("row").agg(*sums)
    cold = found.join(often, F.col("gram") == F.col("often"), "left_anti").join(model, "gram").groupBy("row").agg(*sums)
    return hot.unionByName(cold).groupBy("row").agg(*[F.sum(f"total{end}").alias(f"total{end}") for end in ("", "_part")])


def bin_of(total: Column, url: Column) -> Column:
    """The log-likelihood difference per sign in hundredths; 0 for an empty URL."""
    return F.coalesce(F.floor(total / F.nullif(F.char_length(url), F.lit(0)) / STEP), F.lit(0)).cast("long")


def calibrate(labelled: DataFrame) -> DataFrame:
    """One row: the bin from which URLs are allowed, so that the shares of labelled URLs judged wrongly are least together. Of equally good
    ones, between two bins that occur as well, the nearest to zero."""
    bins = labelled.groupBy("bin").agg(*[F.count_if(F.col("verdict") == v).alias(v) for v in ("allow", "block")])
    below = W.orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    every = W.orderBy("bin").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    lost = F.try_divide(F.coalesce(F.sum("allow").over(below), F.lit(0)), F.sum("allow").over(every))
    passed = 1 - F.try_divide(F.coalesce(F.sum("block").over(below), F.lit(0)), F.sum("block").over(every))
    cut = F.least(F.col("bin"), F.greatest(F.lit(0).cast("long"), F.lag("bin").over(W.orderBy("bin")) + 1))
    wrong = bins.select(cut.alias("cut"), (lost + passed).alias("wrong")).where("wrong IS NOT NULL")
    return wrong.agg(F.min_by("cut", F.struct("wrong", F.abs("cut"), "cut")).alias("least"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, margin): the rule's verdict, or that of the language models for a URL without a rule.

    margin is the log-likelihood difference per sign above the calibrated cut, in hundredths. The models count every URL that a rule
    decides. The cut is that of models of thirteen sixteenths of these URLs (by a hash of the URL) on the others; it is 0 where
    one label is missing among them. Null and empty URLs have the difference 0. Repeated rows are judged each and counted each, null ids stay
    null, other columns are not read, an empty table gives no row. Everything is a DataFrame operation.
    """
    host, path = host_and_path(pages["url"])
    parsed = pages.select("page_id", "url", host.alias("host"), path.alias("path")).withColumn("found", rule_of(rules, F.col("host"), F.col("path")))
    aside = F.coalesce(F.md5(F.col("url").cast("binary")) < ASIDE, F.lit(False))
    ready = base.materialize(parsed.select("page_id", "host", "path", "url", "found.rule", "found.verdict", aside.alias("aside"), F.monotonically_increasing_id().alias("row")), "urls")
    found = ready.select("row", "verdict", "aside", F.explode(grams(F.col("url"))).alias("gram"))
    counted = base.materialize(count(found), "url-grams")
    model = base.materialize(fit(counted), "url-model")
    totals = score(found.select("row", "gram"), counted, model).withColumnRenamed("row", "_row")
    scored = base.materialize(ready.join(totals, F.col("row") == F.col("_row"), "left").drop("row", "_row"), "url-scores")
    judged = scored.where(F.col("verdict").isNotNull() & F.col("aside"))
    least = base.materialize(calibrate(judged.select("verdict", bin_of(F.col("total_part"), F.col("url")).alias("bin"))), "url-cut")
    margin = bin_of(F.col("total"), F.col("url")) - F.coalesce(least.scalar(), F.lit(0).cast("long"))
    verdict = F.coalesce("verdict", F.when(margin >= 0, "allow").otherwise("block"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), margin.alias("margin"))


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return judge(base.table(spark, folder, "pages")).drop("margin")
