"""URL filters: rules first, then the ratio of two character models. DataFrame functions only.

The method learns from the urls that the rules decide: one smoothed variable-order Markov model for
accepted texts (host and path), one for rejected ones. A character's chance after a context of up to
``ORDER - 1`` characters is interpolated with that after the next shorter context; the order used is the
longest that was seen ``MIN_COUNT`` times. A url's score is the mean log-ratio over its characters, minus a
threshold that divides the two classes best (balanced error) on a fifth of the texts, kept out of the counts.

Every n-gram holds the difference its order makes to the log-ratio of the next shorter one, so a score is a
plain sum over all n-grams of a text that the model has: one pass, added up within the task that made them.
Counts, models and threshold come from all distinct texts. The model is broadcast only after its rows are
counted against ``BROADCAST_GRAMS``; a larger one is joined by shuffle.

A null url or one without ``://`` has empty host and path. A text without characters scores 0 before the
threshold. Without both classes the method allows. Repeated rows get equal verdicts, one per row.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import Scratch, unused

ORDER = 5
MIN_COUNT = 3
PRIOR = 2.0
ALPHABET = 256
BINS = 400
SPAN = 4.0
BROADCAST_GRAMS = 400_000
START, END = "\x02", "\x03"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# (host, path, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


@dataclass(frozen=True)
class Model:
    grams: DataFrame | None  # gram, delta
    threshold: float


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def grams_of(text: Column) -> Column:
    """All n-grams up to ORDER that end at each character and at the end mark; the start mark is context only."""
    chars = F.split(F.concat(F.lit(START), text, F.lit(END)), "")

    def ending(i: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.least(F.lit(ORDER), i)), lambda n: F.array_join(F.slice(chars, i - n + 1, n), "")
        )

    return F.flatten(F.transform(F.sequence(F.lit(2), F.size(chars)), ending))


def dealt(texts: DataFrame) -> DataFrame:
    """The texts over all shuffle partitions: they are small, so that a scan puts them into few tasks, but what they are cut
    into is not.
    """
    return texts.repartition(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "text")


def gram_counts(texts: DataFrame) -> DataFrame:
    """(gram, n, a, b): how often each n-gram is seen in accepted and in rejected texts."""
    rows = dealt(texts).select("accepted", F.explode(grams_of(F.col("text"))).alias("gram"))
    counts = rows.groupBy("gram").agg(
        F.count_if(F.col("accepted")).alias("a"), F.count_if(~F.col("accepted")).alias("b")
    )
    return counts.filter(F.col("a") + F.col("b") >= MIN_COUNT).withColumn("n", F.length("gram"))


def differences(counts: DataFrame) -> DataFrame:
    """(gram, delta) from the counts, order by order."""
    total = counts.filter("n = 1").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    below = counts.filter("n = 1").select(
        "gram",
        *[((F.col(c) + PRIOR / ALPHABET) / ((total[c] or 0) + PRIOR)).alias(f"p{c}") for c in "ab"],
    )
    below = below.withColumn("ratio", F.log(F.col("pa") / F.col("pb")))
    parts = [below.select("gram", F.col("ratio").alias("delta"))]
    for n in range(2, ORDER + 1):
        here = counts.filter(F.col("n") == n).withColumn("ctx", F.substring("gram", 1, n - 1))
        seen = here.groupBy("ctx").agg(F.sum("a").alias("ta"), F.sum("b").alias("tb"))
        shorter = below.select(F.col("gram").alias("tail"), "pa", "pb", F.col("ratio").alias("before"))
        here = here.join(seen, "ctx").withColumn("tail", F.substring("gram", 2, n - 1)).join(shorter, "tail")
        below = here.select(
            "gram", "before", *[((F.col(c) + PRIOR * F.col(f"p{c}")) / (F.col(f"t{c}") + PRIOR)).alias(f"p{c}") for c in "ab"]
        ).withColumn("ratio", F.log(F.col("pa") / F.col("pb")))
        parts.append(below.select("gram", (F.col("ratio") - F.col("before")).alias("delta")))
    return reduce(DataFrame.union, parts)


def raw_scores(texts: DataFrame, model: DataFrame) -> DataFrame:
    """(text, z): the mean log-ratio per character of each distinct text, rounded to 9 places."""
    grams = dealt(texts).select("text", F.explode(grams_of(F.col("text"))).alias("gram"))
    sums = grams.join(model, "gram").groupBy("text").agg(F.sum("delta").alias("total"))
    per = F.greatest(F.length("text"), F.lit(1))
    return sums.select("text", F.round(F.when(F.col("text") == "", 0.0).otherwise(F.col("total") / per), 9).alias("z"))


def fit(texts: DataFrame, scratch: Scratch) -> Model:
    """texts: distinct (text, accepted), the latter null where no rule decides."""
    known = texts.filter("accepted is not null and text <> ''")
    held = F.conv(F.substring(F.md5(F.encode("text", "UTF-8")), 1, 6), 16, 10).cast("long") % 5 == 0
    counts = scratch.table(gram_counts(known.filter(~held)), "counts")
    have = counts.filter("n = 1").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    if not (have["a"] and have["b"]):
        return Model(None, 0.0)
    grams = scratch.table(differences(counts), "grams")
    model = F.broadcast(grams) if grams.count() <= BROADCAST_GRAMS else grams
    scored = raw_scores(known.filter(held), model).join(known, "text")
    step = F.greatest(F.lit(0), F.least(F.lit(BINS), F.floor((F.col("z") + SPAN) / (2 * SPAN / BINS))))
    bins = scored.groupBy(step.alias("bin")).agg(
        F.count_if(F.col("accepted")).alias("a"), F.count_if(~F.col("accepted")).alias("b")
    )
    counted = {r["bin"]: (r["a"], r["b"]) for r in bins.collect()}  # at most BINS + 1 rows
    up, down = sum(a for a, _ in counted.values()), sum(b for _, b in counted.values())
    if not (up and down):
        return Model(model, 0.0)
    # error of each bin's lower edge: accepted texts below it, rejected ones from it on
    errors, lost, kept = [], 0, down
    for k in range(BINS + 1):
        errors.append((lost / up + kept / down, abs(k - BINS // 2), k))
        a, b = counted.get(k, (0, 0))
        lost, kept = lost + a, kept - b
    return Model(model, min(errors)[2] * (2 * SPAN / BINS) - SPAN)


def judge(pages: DataFrame, rules=RULES, url: str = "url", into: str = "filter") -> DataFrame:
    """pages with a struct column: host, path, rule, score (null where a rule decides), verdict."""
    scratch = Scratch(pages.sparkSession, "urls")
    made, key = unused(pages, "parsed"), unused(pages, "page_text")
    host, path = host_and_path(F.col(url))
    parsed = pages.withColumn(made, F.struct(host.alias("host"), path.alias("path")))
    parsed = parsed.withColumn(key, F.concat(F.col(made)["host"], F.col(made)["path"]))
    rule = matching_rule(F.col(made)["host"], F.col(made)["path"], rules)
    texts = parsed.select(F.col(key).alias("text"), (rule["verdict"] == "allow").alias("accepted")).groupBy("text")
    texts = scratch.table(texts.agg(F.min("accepted").alias("accepted")), "texts")
    model = fit(texts, scratch)
    if model.grams is None:
        scores = texts.filter("accepted is null").select("text", F.lit(0.0).alias("z"))
    else:
        scores = raw_scores(texts.filter("accepted is null"), model.grams)
    scores = scores.select(F.col("text").alias(key), (F.col("z") - model.threshold).alias(unused(pages, "score")))
    score = F.col(unused(pages, "score"))
    out = F.struct(
        F.col(made)["host"].alias("host"),
        F.col(made)["path"].alias("path"),
        rule["rule"].alias("rule"),
        F.when(rule.isNull(), F.coalesce(score, F.lit(-model.threshold))).alias("score"),
        F.coalesce(
            rule["verdict"], F.when(F.coalesce(score, F.lit(-model.threshold)) >= 0, "allow").otherwise("block")
        ).alias("verdict"),
    ).alias(into)
    return parsed.join(scores, key, "left").select(*[parsed[c] for c in pages.columns], out)


def op4(spark, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of all pages."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, into="f").select("page_id", "f.host", "f.path", "f.rule", "f.verdict")
