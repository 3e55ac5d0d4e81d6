"""Problem 9: sources mixed to target weights along a curriculum that changes over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessaloom.llm.running import running
from tessaloom.session import durable, small_side

#: How far a source's weight may lie from its share at the beginning and the end, as a part of the share.
TILT = 0.5


def schedules(targets: DataFrame, sources: DataFrame, tilt: float = TILT) -> DataFrame:
    """Targets with what each source has and gives: available, demand, given, and the slope of its weight.

    A source's weight at time t of 0..1 is share * (1 + slope * (2 t - 1)); its
    integral is the share. Slopes run from large sources, early, to small ones,
    late, and are centred so that the weights of the sources that give
    something add up to the same at any time.
    available counts every document max_repeats times. demand is the share of
    the mix's size; given is the lesser of the two, so a shortage of a source
    is never filled from others and shows in the shares. Sources without
    documents give nothing.
    """
    total = sources.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("_total"))
    rows = targets.join(sources, "source", "left").na.fill(0, ["tokens"]).crossJoin(F.broadcast(total))  # one row
    repeats = F.greatest(F.coalesce(F.col("max_repeats"), F.lit(0)), F.lit(0))
    rows = rows.withColumn("demand", F.round(F.col("budget_share") * F.col("_total") * F.col("target_share")).cast("bigint"))
    rows = rows.withColumn("available", F.col("tokens") * repeats).withColumn("given", F.least("demand", "available")).withColumn("_late", F.when(F.col("given") > 0, -F.log1p(F.col("tokens").cast("double"))))
    centre = rows.groupBy("mix_name").agg(F.sum(F.col("target_share") * F.col("_late")).alias("_a"), F.sum(F.when(F.col("given") > 0, F.col("target_share"))).alias("_b"))
    rows = rows.join(centre, "mix_name").withColumn("_off", F.col("_late") - F.when(F.col("_b") > 0, F.col("_a") / F.col("_b")).otherwise(0.0))
    widest = rows.groupBy("mix_name").agg(F.max(F.abs("_off")).alias("_most"))
    slope = F.when((F.col("_most") > 0) & F.col("_off").isNotNull(), F.col("_off") / F.col("_most") * tilt).otherwise(0.0)
    return rows.join(widest, "mix_name").select("mix_name", "source", "target_share", "max_repeats", F.col("tokens").alias("source_tokens"), "demand", "available", "given", slope.alias("slope"))


def _time(done: Column, slope: Column) -> Column:
    """When a source has given this part of its tokens: the inverse of t + slope * (t * t - t)."""
    root = F.sqrt((1 - slope) * (1 - slope) + 4 * slope * done)
    return F.when(F.abs(slope) < 1e-9, done).otherwise((root - (1 - slope)) / (2 * slope))


def mix(sizes: DataFrame, key: str, targets: DataFrame, tilt: float = TILT) -> DataFrame:
    """(mix_name, position, source, key, repeat_no, tokens), sorted by mix and position.

    sizes: (key, source, tokens); targets: (mix_name, budget_share, source,
    target_share, max_repeats). Within a source documents come in an order by
    hash; pass after pass, those are taken whose middle lies within the tokens
    the source gives, so a source misses its demand by half a document at most.
    position is where in the mix's tokens the curriculum's integral asks for
    the document. A source that a third of all rows share is summed in parts.
    Null sources and documents without tokens are in no mix.
    """
    rows = durable(sizes.where(F.col("source").isNotNull() & (F.col("tokens") > 0)))
    plan = durable(schedules(targets, rows.groupBy("source").agg(F.sum("tokens").alias("tokens")), tilt))
    wanted = small_side(plan.where("given > 0").select("mix_name", "source", "source_tokens", "given", "slope"))
    placed = running(rows.join(small_side(plan.where("given > 0").select("source").distinct()), "source", "left_semi"), "source", [key], F.col("tokens"))
    passes = F.sequence(F.lit(0), F.floor((F.col("given") - 1) / F.col("source_tokens")).cast("int"))
    taken = placed.join(wanted, "source").select("*", F.explode(passes).alias("repeat_no")).withColumn("_middle", F.col("repeat_no") * F.col("source_tokens") + F.col("_at") + F.col("tokens") / 2)
    taken = taken.where(F.col("_middle") <= F.col("given"))
    length = plan.groupBy("mix_name").agg(F.sum("given").alias("_length"))
    time = _time(F.least(F.col("_middle") / F.col("given"), F.lit(1.0)), F.col("slope"))
    out = taken.join(small_side(length), "mix_name").select("mix_name", F.floor(time * F.col("_length")).cast("bigint").alias("position"), "source", key, F.col("repeat_no").cast("bigint").alias("repeat_no"), F.col("tokens").cast("bigint").alias("tokens"))
    return out.orderBy("mix_name", "position", "source", key, "repeat_no")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(mix_name, source, target_share, actual_share, tokens, documents, most_repeats): what was really reached.

    Sources that gave nothing come out with 0. Where targets are those of
    schedules, demand is there too: the tokens a source should have given.
    """
    more = ["demand"] if "demand" in targets.columns else []
    per = mixed.groupBy("mix_name", "source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("documents"), F.max(F.col("repeat_no") + 1).alias("most_repeats"))
    every = targets.select("mix_name", "source", "target_share", *more).join(per, ["mix_name", "source"], "left").na.fill(0, ["tokens", "documents", "most_repeats"])
    whole = per.groupBy("mix_name").agg(F.sum("tokens").alias("_all"))
    return every.join(whole, "mix_name", "left").select("mix_name", "source", "target_share", F.when(F.col("_all") > 0, F.col("tokens") / F.col("_all")).otherwise(0.0).alias("actual_share"), *more, "tokens", "documents", "most_repeats")
