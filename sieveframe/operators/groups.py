"""Facts about a row's group, put beside each row without moving hot groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveframe.sources.scratch import settle

# Groups above 1/HOT_SHARE of all rows are set apart, as far as their keys fit HOT_BYTES.
# Fewer than HOT_SHARE groups can be that large.
HOT_SHARE = 10_000
HOT_BYTES = 4 << 20
_COUNT_BYTES = 16


def with_group_size(
    df: DataFrame,
    keys: list[str],
    name: str = "group_size",
    at_least: int = 1,
    hot_bytes: int = HOT_BYTES,
) -> DataFrame:
    """Each row with the number of rows that share its keys; nulls are a value.

    Rows of groups with fewer than ``at_least`` rows are left out.

    The rows are counted with partial aggregates and then joined to the counts;
    a window over the rows would pull a whole group into one task. The counts
    are written first, so Spark knows their size and broadcasts them by itself
    only below its own threshold. The largest groups whose keys take no more
    than ``hot_bytes`` together are broadcast, so their rows do not move; all
    other rows are left to a join that splits skewed partitions.
    """
    named = {k: f"_{name}_{i}" for i, k in enumerate(keys)}
    sizes = df.groupBy(*(F.col(k).alias(named[k]) for k in keys)).agg(
        F.count(F.lit(1)).alias(name)
    )
    if at_least > 1:
        sizes = sizes.filter(F.col(name) >= at_least)
    sizes = settle(sizes, "group-sizes")
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(named[k])) for k in keys))
    columns = [*df.columns, name]

    least = _hot_from(sizes, list(named.values()), name, hot_bytes)
    if least is None:
        return df.join(sizes, same).select(*columns)
    few = F.broadcast(sizes.filter(F.col(name) >= least))
    others = sizes.filter(F.col(name) < least)
    in_few = df.join(few, same).select(*columns)
    rest = df.join(few, same, "left_anti").join(others, same).select(*columns)
    return in_few.unionByName(rest)


def _hot_from(
    sizes: DataFrame, keys: list[str], name: str, limit: int
) -> int | None:
    """The least size such that groups from it on are hot and fit the limit in bytes.

    Sizes are told apart by powers of two, of which there are few whatever the number
    of groups.
    """
    width = sum(
        (F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys),
        F.lit(_COUNT_BYTES),
    )
    step = F.floor(F.log2(F.col(name))).cast("int")
    steps = (
        sizes.groupBy(step.alias("step"))
        .agg(F.sum(width).alias("bytes"), F.sum(name).alias("rows"))
        .collect()
    )
    total, held, least = sum(r.rows for r in steps), 0, None
    for r in sorted(steps, key=lambda r: -r.step):
        held += r.bytes
        if held > limit or 2**r.step * HOT_SHARE <= total:
            break
        least = 2**r.step
    return least
