"""Join helpers: size-checked broadcast, match context (P7/J5), stacking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only when the optimizer's size estimate is below this.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def estimated_size(df: DataFrame) -> int | None:
    """Optimizer size estimate in bytes (plan statistics, no job is run)."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(stats.sizeInBytes().toString())
    except Exception:  # pragma: no cover - non-JVM (Connect) sessions
        return None


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast only behind a checked size bound.

    Beyond the bound (or without an estimate) no hint is given: the planner
    falls back to a shuffle join, and AQE may still broadcast at runtime
    once real sizes are known (``autoBroadcastJoinThreshold``).
    """
    size = estimated_size(df)
    if size is not None and size <= limit_bytes:
        return F.broadcast(df)
    return df


def attach_match_context(events: DataFrame, matches: DataFrame,
                         columns: tuple[str, ...] = ("home_team", "away_team"),
                         co_located: bool = False) -> DataFrame:
    """Events x match dimension on match_id (J5): one row per event.

    The match dimension has one row per match: tiny next to its events
    (thousands of events per match), so it is broadcast behind the size
    check and the event side is never shuffled. ``co_located``: both are
    stored tables bucketed alike by match (``sinks.writers.write_bucketed``);
    they are merged bucket by bucket, without an exchange of either side and
    without a broadcast, whatever the size of the dimension.
    """
    dim = matches.select("match_id", *columns)
    if co_located:
        return events.join(dim.hint("merge"), "match_id", "inner")
    return events.join(broadcast_if_small(dim), "match_id", "inner")


def union_matches(frames: list[DataFrame]) -> DataFrame:
    """Stack per-match frames by column name; absent columns become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
