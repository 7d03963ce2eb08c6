"""Exact quantiles and modes without holding a group in one task.

``percentile`` keeps every distinct value of a group in one buffer. Here the wanted ranks are found by narrowing: the values
between the least and the greatest of a group are counted in a bounded number of cells, the counts say which
cell holds which rank, and only those cells are counted again, until a cell holds one value or few rows. Counts are combined
before the shuffle, so a group that holds all rows is counted by as many tasks as the rows fill partitions, and no
row travels before its cell is down to few rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermopanel.session import materialise

#: cells that an interval is cut into, and rows below which a cell is sorted instead
CELLS, FEW = 4096, 4096
_INTERVAL = ("__lo", "__hi")


def _cell(value: Column, cells: int, logarithmic: bool) -> Column:
    """Number of a value's cell between the interval's finite ends; infinities and NaN have cells of their own.

    Equal steps narrow most data fastest, steps of equal ratio those that span many magnitudes; the rounds take turns.
    """

    def scaled(x: Column) -> Column:
        # halves, so that the width of the widest interval is still a number
        return F.when(x == 0, 0.0).otherwise(F.signum(x) * (F.log(F.abs(x)) + 750)) if logarithmic else x / 2

    low, high = scaled(F.col("__flo")), scaled(F.col("__fhi"))
    part = F.coalesce(F.try_divide(scaled(value) - low, high - low), F.lit(0.0))
    return (
        F.when(F.isnan(value), cells + 1).when(value == float("inf"), cells).when(value == float("-inf"), -1)
        .otherwise(F.least(F.lit(cells - 1), F.floor(part * cells))).cast("int")
    )


def _spread(value: Column) -> list[Column]:
    """Rows, ends, and finite ends of some values."""
    finite = F.when(F.abs(value) < float("inf"), value)
    return [
        F.count(F.lit(1)).alias("__n"), F.min(value).alias("__lo"), F.max(value).alias("__hi"),
        F.min(finite).alias("__flo"), F.max(finite).alias("__fhi"),
    ]


def _inside(rows: DataFrame, unsettled: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows within an unsettled interval of their group, with its ends; a group has one row of few intervals."""
    ends = F.collect_list(F.struct("__lo", "__hi", "__flo", "__fhi")).alias("__open")
    joined = rows.join(unsettled.groupBy(*keys).agg(ends), list(keys))
    own = F.get(F.filter("__open", lambda x: (x["__lo"] <= F.col("__v")) & (F.col("__v") <= x["__hi"])), F.lit(0))
    return joined.select(*keys, "__v", own.alias("__own")).filter("__own IS NOT NULL").select(*keys, "__v", "__own.*")


def _placed(counts: DataFrame, unsettled: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """Counted pieces of intervals, with the rank of their first row and the wanted ranks they hold."""
    inside = [*keys, *_INTERVAL]
    # at most a few thousand pieces per interval
    earlier = Window.partitionBy(*inside).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    pieces = counts.select("*", F.coalesce(F.sum("__m").over(earlier), F.lit(0)).alias("__below"))
    joined = pieces.join(unsettled.select(*inside, "__before", "__total", "__ranks"), inside)
    first = F.col("__before") + F.col("__below")
    held = F.filter("__ranks", lambda r: (r >= F.col("__first")) & (r < F.col("__first") + F.col("__m")))
    return joined.withColumn("__first", first).withColumn("__held", held).filter(F.size("__held") > 0)


STATE = ("__total", "__before", "__ranks", "__n", "__lo", "__hi", "__flo", "__fhi")


def _ranks(quantiles: Mapping[str, float]) -> Column:
    places = [F.lit(float(p)) * (F.col("__total") - 1) for p in quantiles.values()]
    return F.array_distinct(F.array(*[side(x).cast("long") for x in places for side in (F.floor, F.ceil)]))


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    cells: int = CELLS,
    few: int = FEW,
) -> DataFrame:
    """One row per key with linearly interpolated quantiles; null values and rows
    with a null key are left out.

    The quantile p of n values lies at position p * (n - 1) of the sorted values. NaN is above all numbers.
    """
    if not keys:
        whole = exact_quantiles(df.withColumn("__all", F.lit(0)), ["__all"], value, quantiles, cells, few)
        return whole.drop("__all")
    keys = list(keys)
    rows = df.select(*keys, (F.col(value).cast("double") + F.lit(0.0)).alias("__v")).na.drop("any", subset=keys)
    rows = materialise(rows.filter("__v IS NOT NULL"))
    start = rows.groupBy(*keys).agg(*_spread(F.col("__v"))).withColumns({"__total": F.col("__n"), "__before": F.lit(0).cast("long")})
    state = materialise(start.withColumn("__ranks", _ranks(quantiles)).select(*keys, *STATE))
    logarithmic = False
    while (state.filter("__lo < __hi").agg(F.max("__n")).first()[0] or 0) > few:
        wide = (F.col("__lo") < F.col("__hi")) & (F.col("__n") > few)
        unsettled, held = state.filter(wide), state.filter(~wide)
        inside = _inside(rows, unsettled, keys).withColumn("__cell", _cell(F.col("__v"), cells, logarithmic))
        counts = inside.groupBy(*keys, *_INTERVAL, "__cell").agg(*[
            c.alias(f"__c{i}") for i, c in enumerate(_spread(F.col("__v")))
        ]).withColumn("__m", F.col("__c0"))
        placed = _placed(counts, unsettled, keys, "__cell")
        narrowed = placed.select(
            *keys, "__total", F.col("__first").alias("__before"), F.col("__held").alias("__ranks"),
            *[F.col(f"__c{i}").alias(c) for i, c in enumerate(STATE[3:])],
        )
        state = materialise(held.select(*keys, *STATE).unionByName(narrowed))
        logarithmic = not logarithmic

    unsettled = state.filter("__lo < __hi")
    single = _inside(rows, unsettled, keys).groupBy(*keys, *_INTERVAL, "__v").agg(F.count(F.lit(1)).alias("__m"))
    found = _placed(single, unsettled, keys, "__v").select(*keys, "__total", F.explode("__held").alias("__rank"), "__v")
    settled = state.filter("NOT __lo < __hi").select(*keys, "__total", F.explode("__ranks").alias("__rank"), F.col("__lo").alias("__v"))
    ranked, out = found.unionByName(settled), []
    for name, p in quantiles.items():
        place = F.lit(float(p)) * (F.col("__total") - 1)
        for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            out.append(F.max(F.when(F.col("__rank") == rank, F.col("__v"))).alias(f"__{side}_{name}"))
    values = ranked.groupBy(*keys).agg(F.max("__total").alias("__total"), *out)
    result = []
    for name, p in quantiles.items():
        place = F.lit(float(p)) * (F.col("__total") - 1)
        low, high = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        result.append(F.when(low == high, low).otherwise(low + (high - low) * (place - F.floor(place))).alias(name))
    return values.select(*keys, *result)


def exact_mode(df: DataFrame, keys: Sequence[str], value: str, name: str = "mode") -> DataFrame:
    """Most frequent value, the smallest among ties."""
    counted = (
        df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    )
    best = F.max_by(F.col(value), F.struct(F.col("__n"), -F.col(value)))
    return counted.groupBy(*keys).agg(best.alias(name))
