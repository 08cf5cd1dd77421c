"""URL filters: allow and block rules, and for the rest the ratio of two character models learnt from what the rules decide."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.session import cut_lineage


class Rule(NamedTuple):
    """Fits a host and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str


#: Characters of context; contexts that were never seen give way to shorter ones.
ORDER = 5
#: Characters before any is seen are this likely.
FLOOR = 1 / 256
#: One URL in so many is kept from the models and used to set the threshold.
CALIBRATE = 5
START, END = "\u0002", "\u0003"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: the host up to ``/ ? #`` with A-Z in lower case, the path up to ``? #``; else both empty."""
    rest = F.coalesce(F.regexp_extract(url, "(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def ruled(rules: list[Rule], pick) -> Column:
    """``pick`` of the longest rule that fits ``host`` and ``path``, NULL if none does."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.host) + len(r.path)):
        fits = ((F.col("host") == rule.host) | F.col("host").endswith(f".{rule.host}")) & F.col("path").startswith(rule.path)
        found = F.when(fits, F.lit(pick(rule))).otherwise(found)
    return found


def _windows(url: Column) -> Column:
    """Each character of a URL and its end, with the ``ORDER`` characters before it."""
    padded = F.concat(F.lit(START * ORDER), url, F.lit(END))
    return F.transform(F.sequence(F.lit(1), F.length(url) + 1), lambda i: padded.substr(i, F.lit(ORDER + 1)))


def log_ratios(windows: DataFrame) -> DataFrame:
    """``(gram, ratio)``: log-likelihood of a window's last character as accepted less that as rejected.

    ``windows`` holds each distinct ``gram`` with its counts ``a`` (accepted) and ``r`` (rejected), zero
    where it is only to be scored. A window of one character less has the counts of all that end in it. From
    the shortest up, a model mixes what it counted after a context with the next shorter
    one, by the number of different followers (Witten and Bell); a context not seen leaves the shorter one's
    value. Every join key has as many rows as there are characters at most.
    """
    levels = [cut_lineage(windows)]
    for _ in range(ORDER):
        shorter = levels[0].select(F.expr("substr(gram, 2)").alias("gram"), "a", "r")
        levels.insert(0, cut_lineage(shorter.groupBy("gram").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))))
    below = None
    for level in levels:
        context = Window.partitionBy(F.expr("left(gram, length(gram) - 1)"))
        seen = level.select(
            "gram",
            "a",
            "r",
            *(F.sum(c).over(context).alias(f"n{c}") for c in ("a", "r")),
            *(F.sum((F.col(c) > 0).cast("long")).over(context).alias(f"t{c}") for c in ("a", "r")),
        )
        if below is None:
            seen = seen.withColumns({"pa": F.lit(FLOOR), "pr": F.lit(FLOOR)})
        else:
            seen = seen.join(below, F.expr("substr(gram, 2)") == F.col("short")).drop("short")
        mixed = lambda c: F.when(
            F.col(f"n{c}") > 0, (F.col(c) + F.col(f"t{c}") * F.col(f"p{c}")) / (F.col(f"n{c}") + F.col(f"t{c}"))
        ).otherwise(F.col(f"p{c}"))
        below = cut_lineage(seen.select(F.col("gram").alias("short"), mixed("a").alias("pa"), mixed("r").alias("pr")))
    return below.select(F.col("short").alias("gram"), (F.log("pa") - F.log("pr")).alias("ratio"))


def scores(urls: DataFrame) -> DataFrame:
    """``(url, ratio)`` of distinct ``urls`` (url, verdict or NULL): the mean log ratio of its characters.

    Every decided URL counts in the models but for one in ``CALIBRATE``, which ``threshold`` needs unseen.
    """
    learnt = F.when(F.pmod(F.xxhash64("url"), F.lit(CALIBRATE)) != 0, F.col("verdict"))
    grams = urls.select("url", learnt.alias("as"), F.explode(_windows(F.col("url"))).alias("gram"))
    counted = grams.groupBy("gram").agg(
        F.count_if(F.col("as") == "allow").alias("a"), F.count_if(F.col("as") == "block").alias("r")
    )
    ratios = log_ratios(counted)
    return grams.select("url", "gram").join(ratios.hint("shuffle_merge"), "gram").groupBy("url").agg(F.avg("ratio").alias("ratio"))


def threshold(scored: DataFrame) -> float:
    """The ratio that best parts allowed from blocked URLs among those kept from the models; 0 where one kind is missing.

    Only counts in steps of 1/100 between -20 and 20 reach the driver.
    """
    step = F.round(F.least(F.greatest("ratio", F.lit(-20.0)), F.lit(20.0)) * 100).cast("int")
    unseen = scored.filter((F.pmod(F.xxhash64("url"), F.lit(CALIBRATE)) == 0) & F.col("verdict").isNotNull())
    rows = unseen.groupBy(step.alias("step")).agg(
        F.count_if(F.col("verdict") == "allow").alias("a"), F.count_if(F.col("verdict") == "block").alias("r")
    )
    rows = sorted(rows.collect())
    good, bad = sum(x.a for x in rows), sum(x.r for x in rows)
    if not good or not bad:
        return 0.0
    best, at, below_good, below_bad = -1.0, 0.0, 0, 0
    for i, x in enumerate(rows):
        value = (good - below_good) / good + below_bad / bad
        if value > best:
            edge = x.step if i == 0 else (x.step + rows[i - 1].step) / 2
            best, at = value, edge / 100
        below_good, below_bad = below_good + x.a, below_bad + x.r
    return at


def judged(pages: DataFrame, rules: list[Rule], id: str = "page_id", url: str = "url") -> DataFrame:
    """``(id, host, path, rule, verdict, ratio)`` of every row: the longest rule's verdict, else the models'.

    The models see host and path. NULL, empty and repeated URLs, NULL and repeated ids each give their row; an empty
    URL has the ratio of its end alone. Other columns are left behind.
    """
    host, path = host_and_path(F.col("url"))
    pages = pages.select(F.col(id).alias("id"), F.coalesce(F.col(url), F.lit("")).alias("url"))
    pages = pages.select("id", host.alias("host"), path.alias("path"))
    pages = pages.withColumns({"rule": ruled(rules, lambda r: r.host + r.path), "said": ruled(rules, lambda r: r.verdict)})
    pages = pages.withColumn("url", F.concat("host", "path"))
    urls = cut_lineage(pages.groupBy("url").agg(F.first("said").alias("verdict")))
    scored = cut_lineage(urls.join(scores(urls), "url"))
    least = threshold(scored)
    ratio = scored.select("url", "ratio").hint("shuffle_merge")
    model = F.when(F.col("ratio") >= least, "allow").otherwise("block")
    return pages.join(ratio, "url").select("id", "host", "path", "rule", F.coalesce("said", model).alias("verdict"), "ratio")
