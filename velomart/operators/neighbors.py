"""Previous and next row per key, without holding a whole key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velomart.operators.dedup import keep_latest


def with_neighbor(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: str,
    values: Sequence[str],
    name: str,
    following: bool = False,
) -> DataFrame:
    """Add struct ``name`` holding ``values`` of the previous (or following) row of the key.

    A plain ``lag`` partitioned by the key gives a hot key to one task. ``bucket`` must be
    a column that never decreases along ``order``, such as the date. Rows look inside their
    (key, bucket) group first. Only the edge row of each bucket travels further: one row
    per key and bucket, ``lag``-ged over the buckets of the key and joined back, which
    needs no second shuffle of the rows. The struct is NULL only where no neighbour exists.
    """
    step = F.lead if following else F.lag
    ascending = [F.col(c).asc_nulls_first() for c in order]
    group = [*keys, bucket]
    state = F.struct(*values)

    inside = df.withColumn("_inside", step(state).over(Window.partitionBy(*group).orderBy(*ascending)))

    narrow = df.select(*dict.fromkeys([*group, *order, *values]))
    if following:
        edge_order = [F.col(c).asc_nulls_first() for c in order]
        edges = keep_latest(narrow, group, [], edge_order)
    else:
        edges = keep_latest(narrow, group, order)
    buckets = Window.partitionBy(*keys).orderBy(bucket)
    carried = edges.select(*group, state.alias("_edge")).select(
        *[F.col(c).alias(f"_{c}") for c in group], step("_edge").over(buckets).alias("_carried")
    )
    matches = [F.col(c) == F.col(f"_{c}") for c in group]
    return (
        inside.join(carried, matches, "left")
        .withColumn(name, F.coalesce("_inside", "_carried"))
        .select(*df.columns, name)
    )
