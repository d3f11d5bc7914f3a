"""Exact percentiles and distinct counts from one table of tallied items.

A percentile is a pair of ranks. Ranks are selected by radix: every double has
an integer with the same order, and running counts over the next 16 bits of
that integer name the cells that hold a wanted rank, until a cell has few
enough distinct values to list them. No task meets an unbounded list, however
close the values lie.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labmart.session import sql_settings, store

#: Bits of one step; a step's running counts have at most 2**16 rows.
DIGIT = 16
#: Distinct values of a cell that one task may list.
LISTED = 1 << DIGIT
#: Tasks among which the rows of a large group are dealt before a join.
SALTS = 256
#: Input of a task that tallies: the groups and items of its rows fit into memory.
TALLY_SPLIT = "16m"

TAG, ITEM, VALUE, PLACE, N = "__tag", "__item", "__value", "__place", "__n"
_ALL, _BEFORE, _UPTO, _CELL, _WITHIN, _SALT = "__all", "__before", "__upto", "__cell", "__within", "__salt"

_EXPONENT = 1 << 52
_LEAST_NORMAL, _LEAST = 2.0**-1022, 2.0**-1074


def ordered_integer(value: Column) -> Column:
    """A 64-bit integer for each double: equal for equal values, and in the same order.

    Exponent and fraction are taken apart by exact divisions by powers of two;
    both zeros are one, NaN is the largest.
    """
    size = F.abs(value)
    near = F.floor(F.log2(size)).cast("int")
    power = F.pow(F.lit(2.0), near)
    # The logarithm may be off by one next to a power of two.
    exponent = near + F.when(size < power, -1).when(size >= power * 2.0, 1).otherwise(0)
    fraction = (size / F.pow(F.lit(2.0), exponent) - 1.0) * float(_EXPONENT)
    magnitude = (
        F.when(F.isnan(value), 2047 * _EXPONENT + 1)
        .when(size == float("inf"), 2047 * _EXPONENT)
        .when(size >= _LEAST_NORMAL, (exponent + 1023).cast("bigint") * _EXPONENT + fraction.cast("bigint"))
        .otherwise((size / _LEAST).cast("bigint"))
    )
    return F.when(value < 0, -magnitude).otherwise(magnitude)


def tally(df: DataFrame, keys: list[str], value: Column | None, items: list[Column]) -> DataFrame:
    """Stored counts of every (group, item): one scan, one exchange, combined before it.

    Tag 0 holds the numeric values with their ordered integers, tag i one row
    for each distinct one of the i-th of ``items``. The exchange is on group
    and item, so a group with most of the rows still spreads. Nulls are left
    out. Files are read in splits of ``TALLY_SPLIT``: a task's items are mostly
    distinct, so what it holds grows with the rows it reads.
    """
    kinds = ([] if value is None else [value.cast("double").alias(VALUE)]) + [
        item.alias(f"{ITEM}{i}") for i, item in enumerate(items, 1)
    ]
    rows = df.select(*keys, *kinds)
    names = rows.columns[len(keys) :]
    counted = rows.groupingSets([[*keys, name] for name in names], *keys, *names).agg(
        F.grouping_id().alias("__set"), F.count(F.lit(1)).alias(N)
    )
    # The bit of a set's own item is the only one of the items that is not set.
    bits = {name: (1 << len(names)) - 1 - (1 << (len(names) - 1 - i)) for i, name in enumerate(names)}
    tag, present = F.lit(None).cast("int"), F.lit(False)
    for name, bit in bits.items():
        own = F.col("__set") == bit
        tag = F.when(own, 0 if name == VALUE else int(name.removeprefix(ITEM))).otherwise(tag)
        present = present | (own & F.col(name).isNotNull())
    counted = counted.where(present).withColumn(TAG, tag).select(
        *keys, TAG, *([VALUE] if VALUE in names else [F.lit(None).cast("double").alias(VALUE)]), N
    )
    place = F.when(F.col(TAG) == 0, ordered_integer(F.col(VALUE)))
    with sql_settings(df.sparkSession, files__maxPartitionBytes=TALLY_SPLIT):
        return store(counted.withColumn(PLACE, place), "tally")


def distinct_items(tallied: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Per group, the number of distinct items of each tag from 1 on."""
    counts = [F.count_if(F.col(TAG) == i).alias(name) for i, name in enumerate(names, 1)]
    return tallied.where(F.col(TAG) > 0).groupBy(*keys).agg(*counts)


def _cell(level: int) -> Column:
    """The leading bits of the ordered integer after so many steps."""
    return F.shiftright(PLACE, 64 - DIGIT * level) if level else F.lit(0).cast("bigint")


def _salted(rows: DataFrame, cells: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with the rows of one key dealt among tasks; ``cells`` is small and repeated."""
    dealt = rows.withColumn(_SALT, F.pmod(F.xxhash64(PLACE), F.lit(SALTS)).cast("int"))
    repeated = cells.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(repeated, [*keys, _SALT], how).drop(_SALT)


def _holds(low: Column, high: Column, ranks: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [(low <= r) & (r < high) for r in ranks])


def percentiles(
    tallied: DataFrame, keys: list[str], names: dict[str, float], listed: int = LISTED
) -> DataFrame:
    """Exact percentiles of the tallied values per group, interpolated between neighbours.

    Groups of at most ``listed`` distinct values are listed in order in one
    task each. Larger ones are taken apart: rows are dealt by a salt to meet
    the group's cell, counts per next digit are combined before they are
    exchanged, and running counts over at most 2**16 digits keep the cells that
    hold a wanted rank. After four steps a cell is a single value.
    """
    values = tallied.where(F.col(TAG) == 0).select(*keys, PLACE, VALUE, N)
    where = {name: (F.col(_ALL) - 1) * F.lit(p) for name, p in names.items()}
    ranks = [f(x) for x in where.values() for f in (F.floor, F.ceil)]
    group = Window.partitionBy(*keys)

    def running(window, order):
        return window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    sizes = values.groupBy(*keys).agg(F.count(F.lit(1)).alias(_WITHIN), F.sum(N).alias(_ALL))
    large = sizes.where(F.col(_WITHIN) > listed)
    if large.isEmpty():
        small, found = values, []
    else:
        large = store(large, "large_groups")
        small = _salted(values, large.select(*keys), keys, "left_anti")
        found = _selected(values, large, keys, ranks, running, listed)
    whole = small.withColumns({_ALL: F.sum(N).over(group), _UPTO: F.sum(N).over(running(group, PLACE))})
    parts = [whole, *found]
    columns = [*keys, VALUE, N, _UPTO, _ALL]
    placed = reduce(lambda a, b: a.unionByName(b), [p.select(*columns) for p in parts])

    before = F.col(_UPTO) - F.col(N)
    ends = {}
    for name, x in where.items():
        for end, f in (("low", F.floor), ("high", F.ceil)):
            here = (before <= f(x)) & (f(x) < F.col(_UPTO))
            ends[f"__{name}_{end}"] = F.max(F.when(here, F.col(VALUE)))
        ends[f"__{name}_part"] = F.max(x - F.floor(x))
    picked = placed.groupBy(*keys).agg(*[v.alias(k) for k, v in ends.items()])
    low, high, part = ((lambda m, e=e: F.col(f"__{m}_{e}")) for e in ("low", "high", "part"))
    return picked.select(
        *keys,
        *[
            F.when(low(m) == high(m), low(m)).otherwise(low(m) + (high(m) - low(m)) * part(m)).alias(m)
            for m in names
        ],
    )


def _selected(values, large, keys, ranks, running, listed) -> list[DataFrame]:
    """Values of the large groups that hold a wanted rank, with their running counts; one frame a step."""
    found = []
    zero = F.lit(0).cast("bigint")
    cells = large.select(*keys, _cell(0).alias(_WITHIN), zero.alias(_BEFORE), _ALL)
    for level in range(1, 64 // DIGIT + 1):
        rows = values.withColumns({_WITHIN: _cell(level - 1), _CELL: _cell(level)})
        counts = (
            _salted(rows, cells, [*keys, _WITHIN])
            .groupBy(*keys, _WITHIN, _CELL)
            .agg(
                F.sum(N).alias(N), F.count(F.lit(1)).alias("__distinct"),
                F.max(_BEFORE).alias(_BEFORE), F.max(_ALL).alias(_ALL),
            )
        )
        digits = running(Window.partitionBy(*keys, _WITHIN), _CELL)
        upto = F.col(_BEFORE) + F.sum(N).over(digits)
        held = counts.withColumn(_UPTO, upto).where(_holds(F.col(_UPTO) - F.col(N), F.col(_UPTO), ranks))
        wanted = store(
            held.select(*keys, _CELL, (F.col(_UPTO) - F.col(N)).alias(_BEFORE), _ALL, "__distinct"), "cells"
        )
        few = wanted.where(F.col("__distinct") <= listed).drop("__distinct")
        inside = _salted(values.withColumn(_CELL, _cell(level)), few, [*keys, _CELL])
        order = running(Window.partitionBy(*keys, _CELL), PLACE)
        found.append(inside.withColumn(_UPTO, F.col(_BEFORE) + F.sum(N).over(order)))
        many = wanted.where(F.col("__distinct") > listed)
        if many.isEmpty():
            break
        cells = many.select(*keys, F.col(_CELL).alias(_WITHIN), _BEFORE, _ALL)
    return found
