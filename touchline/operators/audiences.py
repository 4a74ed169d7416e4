"""Score tables, audiences, splits, change sets and campaign comparison."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.scores import hash_fraction, hash_number, propensity_label
from touchline.operators.ordering import bin_code, decile_edges, hash_slice, ordinals


def score_table(scored: DataFrame, key: str = "domain_userid", score: str = "propensity_score") -> DataFrame:
    """(key, score, decile, label) for every scored user.

    ``scored`` is read more than once: pass a written table, not a pending model run.
    """
    edges = decile_edges(scored, score)
    decile = bin_code(F.col(score), edges)
    return scored.select(
        key,
        F.col(score).alias("propensity_score"),
        decile.alias("propensity_decile"),
        propensity_label(decile).alias("propensity_label"),
    )


def high_propensity(predictions: DataFrame, key: str, prediction: str) -> DataFrame:
    """Users predicted to convert."""
    return predictions.where(F.col(prediction) == 1.0).select(key, F.col(prediction).alias("propensity_prediction"))


def rule_audience(parent: DataFrame, scores: DataFrame, key: str, rule: Column) -> DataFrame:
    """Parent rows, joined with their scores, that meet a rule."""
    return parent.join(scores, key, "left").where(rule)


def awareness_rule() -> Column:
    """First time on the site, no marketing campaign, high propensity."""
    return (F.col("sessions") == 1) & F.col("mkt_medium").isNull() & (F.col("propensity_label") == "High")


def event_audience(views: DataFrame, path_pattern: str) -> DataFrame:
    """Views of the pages whose path matches, as audience events."""
    return views.where(F.col("page_urlpath").like(path_pattern)).select("domain_userid", "page_view_id", "start_tstamp")


def change_set(previous: DataFrame, current: DataFrame, key: str, compared: Sequence[str]) -> DataFrame:
    """What a destination must add, remove or update to follow the current audience."""
    before = previous.select(F.col(key).alias("_b"), F.struct(*compared).alias("_before"))
    after = current.select(F.col(key).alias("_a"), F.struct(*compared).alias("_after"))
    both = before.join(after, F.col("_b") == F.col("_a"), "full")
    change = (
        F.when(F.col("_b").isNull(), "add")
        .when(F.col("_a").isNull(), "remove")
        .when(~F.col("_before").eqNullSafe(F.col("_after")), "update")
    )
    values = [F.coalesce(F.col(f"_after.{c}"), F.when(F.col("_a").isNull(), F.col(f"_before.{c}"))).alias(c) for c in compared]
    return both.select(F.coalesce("_a", "_b").alias(key), change.alias("change"), *values).where("change IS NOT NULL")


def split_by_hash(audience: DataFrame, key: str, groups: int, salt: str = "") -> DataFrame:
    """A stable random group per user, without any shuffle; group sizes are near equal."""
    return audience.withColumn("split", (hash_number(F.col(key), salt) % groups).cast("int"))


def split_stratified(audience: DataFrame, key: str, strata: Sequence[str], groups: int) -> DataFrame:
    """A random group per user so that group sizes within a stratum differ by one at most.

    Users are dealt out in hash order. A stratum may hold most of the audience,
    so its order is built from hash slices and not in one task.
    """
    hashed = audience.withColumns({"_hash": F.md5(F.col(key).cast("string")), "_cut": hash_slice(F.col(key), audience.count())})
    dealt = ordinals(hashed, strata, "_cut", ["_hash", key], "_position")
    return dealt.select(*audience.columns, ((F.col("_position") - 1) % groups).cast("int").alias("split"))


def campaign_performance(members: DataFrame, outcomes: DataFrame, key: str, arm: str, baseline: str) -> DataFrame:
    """Size, conversions, rate and lift over the baseline arm, one row per arm.

    ``members`` holds a user once per arm; ``outcomes`` may list users several times or not at all.
    """
    happened = outcomes.select(key).distinct().withColumn("_hit", F.lit(1))
    per_arm = (
        members.join(happened, key, "left")
        .groupBy(arm)
        .agg(F.count(F.lit(1)).alias("members"), F.count("_hit").alias("conversions"))
        .withColumn("rate", F.col("conversions").cast("double") / F.col("members").cast("double"))
    )
    # One row per arm is left: a window over all of them is small.
    base = F.max(F.when(F.col(arm) == baseline, F.col("rate"))).over(Window.partitionBy(F.lit(1)))
    return per_arm.withColumn("lift", F.try_divide("rate", base))


#: Poisson(1) up to the count of which larger ones have a chance below 1 in 10 ** 7.
_POISSON = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(10)]


#: Members that one task draws all replicates of.
_DRAWN = 20_000


def _copies(share: Column) -> Column:
    """Poisson(1) from a number in [0, 1)."""
    found = F.when(share < _POISSON[0], 0)
    for i, c in enumerate(_POISSON[1:], 1):
        found = found.when(share < c, i)
    return found.otherwise(len(_POISSON))


def campaign_intervals(
    members: DataFrame, outcomes: DataFrame, key: str, arm: str, baseline: str, replicates: int = 200, confidence: float = 0.95, salt: str = ""
) -> DataFrame:
    """Size, conversions, rate and lift of each arm, with bootstrap intervals for rate and lift.

    A member counts Poisson(1) times in each replicate, by a hash of key and
    replicate: all replicates come from one pass over the members, and are the
    same in every run. What is shuffled is one row per arm, replicate and task. An
    interval spans the middle ``confidence`` of the replicates in which there is a
    value; a lift has none where the baseline has no conversions.
    """
    happened = outcomes.select(key).distinct().withColumn("_hit", F.lit(1))
    joined = members.join(happened, key, "left").withColumn("_hit", F.coalesce("_hit", F.lit(0)))
    # Few bytes may mean very many draws: tasks follow the number of members.
    spread = joined.repartition(1 + members.count() // _DRAWN)
    # Replicate 0 counts every member once.
    drawn = spread.withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(replicates))))
    drawn = drawn.withColumn("_share", hash_fraction(F.concat_ws(":", F.col(key).cast("string"), F.col("_r").cast("string")), salt))
    copies = F.when(F.col("_r") == 0, 1).otherwise(_copies(F.col("_share")))
    counted = drawn.select(arm, "_r", "_hit", copies.alias("_copies")).groupBy(arm, "_r").agg(
        F.sum("_copies").alias("_members"), F.sum(F.col("_copies") * F.col("_hit")).alias("_conversions")
    )
    rates = counted.withColumn("_rate", F.try_divide(F.col("_conversions").cast("double"), F.col("_members").cast("double")))
    # Arms times replicates rows are left, whatever the number of members.
    base = F.max(F.when(F.col(arm) == baseline, F.col("_rate"))).over(Window.partitionBy("_r"))
    lifted = rates.withColumn("_lift", F.when(base > 0, F.col("_rate") / base))
    edges = [(1 - confidence) / 2, (1 + confidence) / 2]
    once = F.col("_r") == 0
    spans = {n: F.percentile(F.when(~once, F.col(f"_{n}")), F.lit(edges).cast("array<double>")) for n in ("rate", "lift")}
    return lifted.groupBy(arm).agg(
        F.max(F.when(once, F.col("_members"))).alias("members"),
        F.max(F.when(once, F.col("_conversions"))).alias("conversions"),
        F.max(F.when(once, F.col("_rate"))).alias("rate"),
        F.get(spans["rate"], F.lit(0)).alias("rate_low"),
        F.get(spans["rate"], F.lit(1)).alias("rate_high"),
        F.max(F.when(once, F.col("_lift"))).alias("lift"),
        F.get(spans["lift"], F.lit(0)).alias("lift_low"),
        F.get(spans["lift"], F.lit(1)).alias("lift_high"),
    )


def site_insights(events: DataFrame, ts: str, user: str, source: str) -> DataFrame:
    """Users and events per day and traffic source."""
    per_user = events.groupBy(F.to_date(ts).alias("day"), F.coalesce(source, F.lit("direct")).alias("source"), user).agg(
        F.count(F.lit(1)).alias("_n")
    )
    return per_user.groupBy("day", "source").agg(F.count(user).alias("users"), F.sum("_n").alias("events"))
