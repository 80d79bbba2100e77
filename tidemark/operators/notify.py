"""Sync notices: routing by action, and the completion message."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import ACTION_PROCESSED, ACTOR_SYSTEM


def tenants_with_action(sync: DataFrame, action: str) -> DataFrame:
    """Distinct tenants that sent ``action`` (NULL or non-numeric tenant ids dropped)."""
    return (sync.filter((F.col("action") == F.lit(action)) & F.col("organiser_Id").isNotNull())
            .select("organiser_Id").distinct())


def completion_notice(tenants: DataFrame, now: int) -> DataFrame:
    """One JSON message per tenant: {context:{oId, eId:0, action, actor}, timeStamp}.

    Built with ``to_json`` on the executors; nothing is collected to the driver."""
    ctx = F.struct(F.col("organiser_Id").cast("bigint").alias("oId"), F.lit(0).cast("bigint").alias("eId"),
                   F.lit(ACTION_PROCESSED).alias("action"), F.lit(ACTOR_SYSTEM).alias("actor"))
    msg = F.struct(ctx.alias("context"), F.lit(now).cast("bigint").alias("timeStamp"))
    return tenants.select("organiser_Id", F.to_json(msg).alias("value"))
