"""Review decisions and their application."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from driftspark.operators.joins import salted_lookup

BATCH = ("repo",)

# Fixed values.
CANCELLED = "Cancelled by user"
SKIPPED = "Skipped by user"


def settle_actions(decisions: DataFrame, auto_approve: bool = False) -> DataFrame:
    """A missing action is a cancelled review; auto-approve accepts everything."""
    if auto_approve:
        none = F.lit(None).cast("string")
        return (
            decisions.withColumn("action", F.lit("approve"))
            .withColumn("edited_content", none)
            .withColumn("feedback", none)
        )
    cancelled = F.col("action").isNull()
    feedback = F.when(F.length("feedback") > 0, F.col("feedback"))
    return decisions.withColumn(
        "feedback", F.when(cancelled, CANCELLED).otherwise(feedback)
    ).withColumn("action", F.coalesce("action", F.lit("reject")))


def resolve_decisions(
    decisions: DataFrame, batch: Sequence[str] = BATCH, auto_approve: bool = False
) -> DataFrame:
    """Final decisions: after a rejection that stops a batch the rest is skipped.

    The stop is the batch's smallest such ``seq`` - a map-side combined minimum,
    not a window over the batch - looked up by the batch's rows with salting.
    """
    settled = settle_actions(decisions, auto_approve)
    stops = settled.filter((F.col("action") == "reject") & F.col("stop"))
    first = stops.groupBy(*batch).agg(F.min("seq").alias("stop_seq"))
    joined = salted_lookup(settled, first, list(batch), ["seq"], how="left")
    skipped = F.coalesce(F.col("seq") > F.col("stop_seq"), F.lit(False))
    none = F.lit(None).cast("string")
    return joined.select(
        *[c for c in settled.columns if c not in ("action", "edited_content", "feedback", "stop")],
        F.when(skipped, "reject").otherwise(F.col("action")).alias("action"),
        F.when(skipped, none).otherwise(F.col("edited_content")).alias("edited_content"),
        F.when(skipped, SKIPPED).otherwise(F.col("feedback")).alias("feedback"),
    )


def pair_decisions(
    updates: DataFrame, decisions: DataFrame, batch: Sequence[str] = BATCH
) -> DataFrame:
    """Each update with the decision at its position in the batch."""
    chosen = decisions.select(*batch, "seq", "action", "edited_content", "feedback")
    return updates.join(chosen, [*batch, "seq"])


def approved_updates(paired: DataFrame) -> DataFrame:
    """Approved or edited updates with the text to write."""
    edited = (F.col("action") == "edit") & (F.length("edited_content") > 0)
    return paired.filter(F.col("action").isin("approve", "edit")).withColumn(
        "final_content",
        F.when(edited, F.col("edited_content")).otherwise(F.col("updated_content")),
    )


def apply_updates(
    docs: DataFrame, approved: DataFrame, keys: Sequence[str] = ("repo", "path")
) -> DataFrame:
    """Documents after the updates, with the replaced text as ``backup``.

    Several updates of one path apply in ``seq`` order: the last one stays and
    the one before it is the backup. The result is a new table; write it to a new
    location, never over the documents being read.
    """
    order = Window.partitionBy(*keys).orderBy(F.desc("seq"))
    latest = approved.select(*keys, "seq", "final_content").withColumn(
        "rank", F.row_number().over(order)
    )
    per_path = latest.filter("rank <= 2").groupBy(*keys).agg(
        F.max(F.when(F.col("rank") == 1, F.col("final_content"))).alias("chosen"),
        F.max(F.when(F.col("rank") == 2, F.col("final_content"))).alias("previous"),
    )
    joined = docs.select(*keys, "content").join(per_path, list(keys), "full_outer")
    replaced = F.col("chosen").isNotNull()
    return joined.select(
        *keys,
        F.coalesce("chosen", "content").alias("content"),
        F.when(replaced, F.coalesce("previous", "content")).alias("backup"),
        replaced.alias("is_updated"),
    )


def decision_log(paired: DataFrame, keys: Sequence[str] = ("repo", "path")) -> DataFrame:
    """Log records of the decisions taken; skipped reviews are not logged."""
    taken = paired.filter(~F.col("feedback").eqNullSafe(F.lit(SKIPPED)))
    return taken.select(
        F.current_timestamp().alias("ts"),
        *keys,
        "action",
        "reasoning",
        "feedback",
        F.coalesce(F.length("edited_content") > 0, F.lit(False)).alias("had_edited_content"),
    )
