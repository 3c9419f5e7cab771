"""Mixing to target weights: iterative proportional fitting of token weights, then sampling.

Tokens are summed per cell (source, language, topic). The output has a stated budget: ``BUDGET`` of all tokens. Each of
the three shares it out by its targets; a value with fewer tokens than its part is taken whole and the others share what it
leaves (``levels``). Capped raking then multiplies the cells until each of the three agrees with its parts: a cell's
probability is 1 at most, cells that reach it are put aside, and the rest is raked to what remains. So a rare source, language
or null is kept whole and takes nothing from the others. A document is kept if a hash of its id falls below its cell's
probability, so expected tokens follow the parts, nothing is drawn from a random state, and a lost task draws the same
documents again. ``kept_share`` says what came of the budget.

Shares that are given are demands: without a budget of the caller's own they lower it until the scarcest value can have its
share, but to ``LEAST`` of all tokens only.

Raking works on the cells, never on documents, as window sums in one plan: each window row is a cell, so
a source with a third of all documents is as few rows as any other. The cells are joined back by the
three keys; Spark's own size check picks the join, and a hot key is split as a skewed join.

A topic is the cell of a random-hyperplane hash of a text's longer words (``TOPIC_BITS`` planes), unless the
documents have a column for it. A token is a word here.

Targets: shares by value, or ``POWERS``: the natural share to a power below 1, which lifts rare values.
Values without a target share are not sampled. Nulls count as a value of their own; a null text has no
tokens and is kept with its cell's probability; repeated rows share one fate. Cells without tokens have
probability 0 where all their documents are empty: nothing is known to weigh them by, so they are kept.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.frames import Scratch, annotate, unused

TOPIC_BITS = 3
TOPIC_WORD_BYTES = 7
SWEEPS = 8
BUDGET = 0.6
LEAST = 0.1
POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.5}
SEED = 20


def measure(docs: DataFrame, into: str = "measured") -> DataFrame:
    """docs with a struct column of the number of tokens and the topic of each text."""

    def compute(piece: pa.RecordBatch) -> list:
        words = W.split(W.text_column(piece))
        hashes = words.hashes()
        long = pc.binary_length(words.vocab).to_numpy(zero_copy_only=False) >= TOPIC_WORD_BYTES
        topic = np.zeros(len(words.counts), np.int32)
        for bit in range(TOPIC_BITS):
            side = np.where(long, ((hashes >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) * 2 - 1, 0)
            topic |= (W.sums(side[words.ids], words.offsets) > 0).astype(np.int32) << bit
        return [words.counts, topic]

    return annotate(docs, compute, "n_tokens long, topic int", into)


def _target(dim: str, targets: Mapping[str, Mapping[str, float]], natural: Column) -> Column:
    if dim not in targets:
        return F.pow(natural, F.lit(POWERS.get(dim, 1.0)))
    share = F.lit(0.0)
    for value, x in targets[dim].items():
        share = F.when(F.col(dim).cast("string") == F.lit(str(value)), F.lit(float(x))).otherwise(share)
    return share


def rake(
    cells: DataFrame, dims: tuple[str, ...], targets: Mapping[str, Mapping[str, float]] | None = None, sweeps: int = SWEEPS
) -> DataFrame:
    """cells (``dims`` and ``tokens``) with ``weight``: tokens raked to the marginals."""
    out = cells.withColumn("weight", F.col("tokens").cast("double"))
    for dim in dims:
        natural = F.sum("tokens").over(Window.partitionBy(dim)).cast("double")
        out = out.withColumn(f"to_{dim}", _target(dim, targets or {}, natural))
    for _ in range(sweeps):
        for dim in dims:
            total = F.sum("weight").over(Window.partitionBy(dim))
            out = out.withColumn(
                "weight", F.when(total > 0, F.col("weight") * F.col(f"to_{dim}") / total).otherwise(F.lit(0.0))
            )
    return out.select(*dims, "tokens", "weight")


def _budget(goals: DataFrame, values: DataFrame, given: list[str], budget: float | None) -> float:
    """Tokens to keep: the budget's share, or what given shares and the cells that may be sampled leave of it."""
    whole = goals.agg(F.sum("tokens").alias("tokens"), F.sum("free").alias("free")).first()
    tokens, free = float(whole["tokens"] or 0), float(whole["free"] or 0)
    out = tokens * (BUDGET if budget is None else budget)
    if budget is None and given:
        asked = values.filter(F.col("dim").isin(given) & (F.col("has") > 0)).groupBy("dim")
        for r in asked.agg((F.min(F.col("has") / F.col("share")) * F.sum("share")).alias("most")).collect():
            out = max(min(out, r["most"]), min(out, LEAST * tokens))
    return min(out, free)


def levels(values: DataFrame, budget: float) -> dict[str, float]:
    """Per dimension the x for which the parts, ``least(has, x * share)`` of each value, add up to the budget.

    Starts with no value taken whole and grows; a round is one aggregate over ``values`` (dim, share, has).
    """
    out = {r["dim"]: 0.0 for r in values.select("dim").distinct().collect()}
    while out:
        level = F.lit(0.0)
        for dim, x in out.items():
            level = F.when(F.col("dim") == F.lit(dim), F.lit(x)).otherwise(level)
        whole = level * F.col("share") >= F.col("has")
        sums = values.groupBy("dim").agg(
            F.sum(F.when(whole, F.col("has")).otherwise(0)).alias("taken"), F.sum(F.when(whole, F.lit(0.0)).otherwise(F.col("share"))).alias("shares")
        )
        new = {r["dim"]: (budget - r["taken"]) / r["shares"] for r in sums.collect() if r["shares"] > 0}
        grown = {dim: x for dim, x in new.items() if x > out[dim] * (1 + 1e-12)}
        if not grown:
            break
        out |= grown
    return out


def probabilities(
    cells: DataFrame, dims: tuple[str, ...], targets=None, sweeps: int = SWEEPS, budget: float | None = None
) -> DataFrame:
    """cells (``dims`` and ``tokens``) with ``probability`` and ``weight``, the tokens expected from each."""
    scratch, targets = Scratch(cells.sparkSession, "mixing"), targets or {}
    goals, sampled = cells, F.lit(True)
    for dim in dims:
        natural = F.sum("tokens").over(Window.partitionBy(dim)).cast("double")
        goals = goals.withColumn(f"to_{dim}", _target(dim, targets, natural))
        sampled = sampled & (F.col(f"to_{dim}") > 0)
    goals = goals.withColumn("free", F.when(sampled, F.col("tokens")).otherwise(0))
    for dim in dims:
        goals = goals.withColumn(f"has_{dim}", F.sum("free").over(Window.partitionBy(dim)))
    goals = scratch.table(goals, "goals")
    values = None
    for dim in dims:
        own = goals.groupBy(dim).agg(F.first(f"to_{dim}").alias("share"), F.first(f"has_{dim}").alias("has"))
        own = own.select(F.lit(dim).alias("dim"), "share", "has")
        values = own if values is None else values.unionByName(own)
    values = scratch.table(values, "values")
    whole = _budget(goals, values, [d for d in dims if d in targets], budget)
    level = levels(values, whole)

    # factor: what the cell's tokens are multiplied by; above 1 the cell is whole
    out = goals.withColumn("factor", F.lit(1.0))
    for _ in range(sweeps):
        for dim in dims:
            value, upward = Window.partitionBy(dim), Window.partitionBy(dim).orderBy("factor").rowsBetween(Window.unboundedPreceding, 0)
            part = F.least(F.col(f"has_{dim}").cast("double"), F.lit(level.get(dim, 0.0)) * F.col(f"to_{dim}"))
            # with the cells of larger factors whole, the others need at least this: the largest such bound is met
            above = F.col(f"has_{dim}") - F.sum("free").over(upward)
            below = F.sum(F.col("free") * F.col("factor")).over(upward)
            out = out.withColumn("bound", F.when(below > 0, (part - above) / below))
            out = out.withColumn("factor", F.col("factor") * F.coalesce(F.max("bound").over(value), F.lit(1.0)))
    chance = F.when(F.col("free") > 0, F.least("factor", F.lit(1.0))).when(F.col("tokens") > 0, F.lit(0.0)).otherwise(F.lit(1.0))
    out = out.select(*dims, "tokens", chance.alias("probability"))
    return scratch.table(out.withColumn("weight", F.col("tokens") * F.col("probability")), "raked")


def draw(id_col: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    return F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(2**53)).cast("double") / F.lit(float(2**53))


def mix(
    docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, into: str = "mixing", budget: float | None = None
) -> DataFrame:
    """docs with a struct column: topic, n_tokens, weight of its cell (tokens expected from it), probability, kept."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    name = unused(docs, "measured")
    plain = measure(docs.select("doc_id", "text", "source", "lang"), "m")
    cell = (F.col("source"), F.col("lang"), F.col("m.topic").alias("topic"))
    cells = plain.groupBy(*cell).agg(F.sum("m.n_tokens").alias("tokens"))
    table = probabilities(scratch.table(cells, "cells"), ("source", "lang", "topic"), targets, budget=budget)
    table = table.select(
        F.col("source").alias("_s"), F.col("lang").alias("_l"), F.col("topic").alias("_t"), F.struct("weight", "probability").alias(unused(docs, "raked"))
    )
    rows = measure(docs, name)
    same = rows["source"].eqNullSafe(table["_s"]) & rows["lang"].eqNullSafe(table["_l"]) & (rows[name]["topic"] == table["_t"])
    raked = F.col(unused(docs, "raked"))
    made = F.struct(
        F.col(name)["topic"].alias("topic"),
        F.col(name)["n_tokens"].alias("n_tokens"),
        raked["weight"].alias("weight"),
        raked["probability"].alias("probability"),
        (draw(F.col("doc_id")) < raked["probability"]).alias("kept"),
    ).alias(into)
    return rows.join(table, same).select(*[rows[c] for c in docs.columns], made)


def kept_share(mixed: DataFrame, into: str = "mixing") -> DataFrame:
    """One row: documents and tokens of what ``mix`` returned, the shares of them kept, and the share of tokens expected."""
    m = F.col(into)
    tokens = F.sum(m["n_tokens"])
    return mixed.agg(
        F.count(F.lit(1)).alias("documents"),
        F.avg(m["kept"].cast("int")).alias("documents_kept"),
        tokens.alias("tokens"),
        (F.sum(F.when(m["kept"], m["n_tokens"]).otherwise(0)) / tokens).alias("tokens_kept"),
        (F.sum(m["n_tokens"] * m["probability"]) / tokens).alias("tokens_expected"),
    )


def op9(spark, sf_dir: str) -> DataFrame:
    """Topic, tokens, weight, probability and fate of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang")
    return mix(docs, into="m").select("doc_id", "source", "lang", "m.*")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sampled documents, with their own columns."""
    name = unused(docs, "mixing")
    return mix(docs, into=name).filter(F.col(name)["kept"]).select(*docs.columns)
