"""Places, neighbours, running sums and exact quantiles within groups, without gathering a group in one task.

All rows are put in one sort order, cut in ranges, and written with their place in
their range. What the groups of a range begin with and hold is a small table (as
many rows as there are groups and ranges); sums over it move the places. So a
group of any size is spread like the rest, and no buffer or window holds it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .. import tables

#: Of monotonically_increasing_id, the bits that count rows within a partition.
_INSIDE = (1 << 33) - 1


def _ranged(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` in ranges of ``keys``, written, with __part and __idx, the place in the range."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Equal keys would share one range; where a row comes from breaks the tie.
    marked = df.withColumn("__at", F.monotonically_increasing_id())
    dealt = marked.repartitionByRange(parts, *keys, "__at").sortWithinPartitions(*keys, "__at").drop("__at")
    dealt = dealt.withColumns({"__part": F.spark_partition_id(), "__idx": F.monotonically_increasing_id().bitwiseAND(_INSIDE)})
    # Written, because the bounds of ranges are sampled anew whenever the plan runs.
    return tables.table(dealt, "ranged")


def _pieces(dealt: DataFrame, by: Sequence[str], value: Column) -> DataFrame:
    """For each range and group: its first place in the range, its rows (n), and the sums of ``value`` (total) there and before."""
    sums = dealt.groupBy("__part", *by).agg(F.min("__idx").alias("__min"), F.count("*").alias("__n"), F.sum(value).alias("__total"))
    order = W.partitionBy(*by).orderBy("__part") if by else W.orderBy("__part")
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    return sums.withColumns({"__rows": F.coalesce(F.sum("__n").over(earlier), F.lit(0)), "__before": F.coalesce(F.sum("__total").over(earlier), F.lit(0))})


def _renamed(df: DataFrame, columns: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{k}" for k, c in enumerate(columns)})


def _same(columns: Sequence[str], prefix: str) -> list[Column]:
    return [F.col(c).eqNullSafe(F.col(f"{prefix}{k}")) for k, c in enumerate(columns)]


def _joined(dealt: DataFrame, pieces: DataFrame, by: Sequence[str]) -> DataFrame:
    pieces = _renamed(pieces, ["__part", *by], "__j")
    return dealt.join(pieces, reduce(lambda a, b: a & b, _same(["__part", *by], "__j"))).drop(*(f"__j{k}" for k in range(len(by) + 1)))


_OWN = ("__part", "__idx", "__min", "__n", "__total", "__rows", "__before")


def placed(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "place") -> DataFrame:
    """``df`` with its rows' places within their groups, from 0; rows of equal order (ties) follow each other in any order."""
    dealt = _ranged(df, [*by, *order])
    joined = _joined(dealt, _pieces(dealt, by, F.lit(1)), by)
    return joined.withColumn(name, F.col("__idx") - F.col("__min") + F.col("__rows")).drop(*_OWN)


def with_next(df: DataFrame, by: Sequence[str], order: Sequence[str], column: str, name: str) -> DataFrame:
    """``df`` with ``column`` of the next row of its group; rows without a next one are left out."""
    numbered = placed(df, by, order, "__p")
    after = _renamed(numbered.select(*by, (F.col("__p") - 1).alias("__q"), F.col(column).alias(name)), by, "__a")
    same = reduce(lambda a, b: a & b, _same(by, "__a"), F.col("__p") == F.col("__q"))
    return numbered.join(after, same).drop("__p", "__q", *(f"__a{k}" for k in range(len(by))))


def running(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows of the group before each row, 0 at the first."""
    dealt = _ranged(df, [*by, *order])
    inside = W.partitionBy("__part", *by).orderBy("__idx").rowsBetween(W.unboundedPreceding, -1)
    local = dealt.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = _joined(local, _pieces(dealt, by, F.col(value)), by)
    return joined.withColumn(name, F.col(name) + F.col("__before")).drop(*_OWN)


def sorted_values(df: DataFrame, by: Sequence[str], value: str | Column) -> DataFrame:
    """(by, __v, __part, __idx): the values, nulls included, written in order of group and value."""
    v = F.col(value) if isinstance(value, str) else value
    return _ranged(df.select(*by, v.alias("__v")), [*by, "__v"])


def quantiles(df: DataFrame, by: Sequence[str], value: str | Column, shares: dict[str, float]) -> DataFrame:
    """(by, shares' names): exact quantiles, interpolated between the two nearest values; nulls are left out.

    Only groups with a value have a row; without ``by`` there is always one. ``shares`` lie in 0..1.
    """
    return quantiles_of(sorted_values(df, by, value), by, shares)


def quantiles_of(dealt: DataFrame, by: Sequence[str], shares: dict[str, float]) -> DataFrame:
    """Quantiles of ``sorted_values``: the places of the nearest values follow from the small table, their values from one look-up."""
    values = dealt.where("__v is not null")
    pieces = _pieces(values, by, F.lit(1))
    size = F.sum("__n").over(W.partitionBy(*by) if by else W.partitionBy(F.lit(1)))
    pieces = pieces.withColumn("__size", size)
    wanted = []
    for k, q in shares.items():
        pos = (F.col("__size") - 1) * F.lit(float(q))
        wanted += [F.struct(F.lit(k).alias("share"), end.cast("long").alias("pos"), weight.alias("weight")) for end, weight in ((F.floor(pos), 1 - (pos - F.floor(pos))), (F.floor(pos) + 1, pos - F.floor(pos)))]
    asked = pieces.withColumn("w", F.explode(F.array(*wanted))).where("w.weight > 0 and w.pos >= __rows and w.pos < __rows + __n")
    asked = asked.select(F.col("__part").alias("__q"), (F.col("w.pos") - F.col("__rows") + F.col("__min")).alias("__i"), "w.share", "w.weight")
    found = values.join(asked, (F.col("__part") == F.col("__q")) & (F.col("__idx") == F.col("__i")))
    # Two values at most of each share meet in a group.
    return found.groupBy(*by).agg(*(F.sum(F.when(F.col("share") == k, F.col("__v").cast("double") * F.col("weight"))).alias(k) for k in shares))
