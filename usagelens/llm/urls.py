"""URL filters with the ratio of two character language models, in DataFrame functions only.

Rules decide what they can. The URLs that they allow and block train two smoothed
variable-order Markov models of characters: the probability of a character after
the last k ones is ``(n(context, c) + SMOOTH * p(c, one shorter)) / (n(context) + SMOOTH)``,
so a context that was never seen leaves it to the next shorter one, down to all
characters being alike. The characters are all of the URL after ``://``, the host in
lower case, then path, query and fragment as they are. Any other URL gets the mean over its characters of
log p(allowed) - log p(blocked), and is allowed at or above a threshold.

The threshold is calibrated: a fifth of the URLs that rules decide, drawn by their
hash, is left out of training and scored, and the threshold is where the share of
blocked ones that pass plus the share of allowed ones that don't is smallest.

Counts are aggregated over all URLs before anything is joined. URLs meet the model
by their 5-character strings; both sides are plain shuffles, which the runtime can
split where a string is in every URL.

Defined cases: null and a URL without ``://`` have an empty host and path, no rule
and no score, and are blocked; a URL with ``://`` and an empty host is scored; repeated rows are judged alike, and each counts in training; with
no allowed or no blocked URL the threshold is 0 and scores compare what there is;
an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.llm import base

# Verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
ORDER = 4
SMOOTH = 4.0
ALPHABET = 256.0
FOLDS = 5
BIN = 0.02
WIDEST = 20.0  # scores beyond this count as this when the threshold is set
START, END = "\x02", "\x03"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host, in lower case, and path."""
    pattern = r"^(?s:.*?)://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, pattern, 1), UPPER, LOWER), F.regexp_extract(text, pattern, 2)


def modelled(url: Column, host: Column) -> Column:
    """What the models read: all after ``://``, the host in lower case; null without ``://``."""
    return F.when(F.contains(url, F.lit("://")), F.concat(host, F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*((?s:.*))$", 1)))


def with_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, url, host, path, characters for the models, and the longest rule that fits with its verdict."""
    host, path = parts(F.col("url"))
    table = pages.select("page_id", "url", host.alias("host"), path.alias("path"), modelled(F.col("url"), host).alias("rest"))
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))

    def first(value):
        cases = [F.when(((F.col("host") == h) | F.endswith("host", F.lit(f".{h}"))) & F.startswith("path", F.lit(p)), F.lit(value(v, h, p))) for v, h, p in longest]
        return F.coalesce(*cases, F.lit(None).cast("string"))

    return table.withColumn("rule", first(lambda v, h, p: h + p)).withColumn("ruled", first(lambda v, h, p: v))


def strings(table: DataFrame, *keep: str) -> DataFrame:
    """A row for each character of a URL: it, after the ORDER characters before it."""
    padded = F.concat(F.lit(START * ORDER), "rest", F.lit(END))
    at = F.sequence(F.lit(1), F.length("rest") + 1)
    return table.filter("rest is not null").select(*keep, F.explode(F.transform(at, lambda i: F.substring(padded, i, F.lit(ORDER + 1)))).alias("string"))


def ratios(table: DataFrame) -> DataFrame:
    """For each string of any URL, the difference of its log probabilities under both models."""
    for_training = lambda verdict: (F.col("training") & (F.col("ruled") == verdict)).cast("long")
    marked = table.select("rest", F.coalesce(for_training("allow"), F.lit(0)).alias("a"), F.coalesce(for_training("block"), F.lit(0)).alias("b"))
    counts = base.saved(strings(marked, "a", "b").groupBy("string").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "strings")
    before = None
    for k in range(ORDER + 1):
        own = counts.select(F.substring("string", ORDER + 1 - k, k + 1).alias("string"), "a", "b").groupBy("string").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        context = F.substring("string", 1, k)
        of_context = own.groupBy(context.alias("context")).agg(F.sum("a").alias("all_a"), F.sum("b").alias("all_b"))
        level = own.withColumn("context", context).join(of_context, "context")
        if before is None:
            level = level.withColumn("pa", F.lit(1 / ALPHABET)).withColumn("pb", F.lit(1 / ALPHABET))
        else:
            level = level.withColumn("shorter", F.substring("string", 2, k)).join(before, "shorter")
        p = {x: (F.col(x) + SMOOTH * F.col(f"p{x}")) / (F.col(f"all_{x}") + SMOOTH) for x in "ab"}
        before = base.saved(level.select(F.col("string").alias("shorter"), p["a"].alias("pa"), p["b"].alias("pb")), f"level{k}")
    return before.select(F.col("shorter").alias("string"), (F.log("pa") - F.log("pb")).alias("ratio"))


def threshold(scored: DataFrame) -> Column:
    """The score that parts allowed from blocked URLs best, as a scalar subquery over a bounded histogram."""
    clipped = F.greatest(F.lit(-WIDEST), F.least(F.lit(WIDEST), "score"))
    bins = scored.filter("ruled is not null and score is not null").groupBy(F.floor(clipped / BIN).alias("bin")).agg(
        F.count_if(F.col("ruled") == "allow").alias("allowed"), F.count_if(F.col("ruled") == "block").alias("blocked")
    )
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    lost, passed = F.coalesce(F.sum("allowed").over(below), F.lit(0)), F.coalesce(F.sum("blocked").over(below), F.lit(0))
    every = Window.partitionBy()
    table = bins.select("bin", lost.alias("lost"), passed.alias("stopped"), F.sum("allowed").over(every).alias("allow"), F.sum("blocked").over(every).alias("block"))
    cost = F.col("lost") / F.col("allow") + 1 - F.col("stopped") / F.col("block")
    best = table.filter("allow > 0 and block > 0").agg(F.min_by(F.col("bin") * BIN, F.struct(cost, "bin")).alias("t"))
    return best.select(F.coalesce("t", F.lit(0.0))).scalar()


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per page with its rule and verdict; score is empty where a rule decides."""
    training = F.pmod(F.xxhash64("url"), F.lit(FOLDS)) != 0
    table = base.saved(with_rules(pages, rules).withColumn("training", training).withColumn("row", F.monotonically_increasing_id()), "ruled")
    model = base.saved(ratios(table), "ratios")
    wanted = strings(table.filter("ruled is null or not training"), "row")
    scores = wanted.join(model.hint("merge"), "string").groupBy("row").agg(F.avg("ratio").alias("score"))
    scored = base.saved(table.join(scores.hint("merge"), "row", "left").select("page_id", "host", "path", "rule", "ruled", "score"), "scored")
    own = F.when(F.col("score") >= threshold(scored), "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), F.when(F.col("ruled").isNull(), F.col("score")).alias("score"))
