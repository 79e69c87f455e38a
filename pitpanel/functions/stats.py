"""Exact median and reproducible sums per group; no group is gathered in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions.keys import spread_join
from pitpanel.functions.stages import stage


# Cuts by equal widths at most; 256 widths each tell any two doubles of one power apart.
_MOST_CUTS = 8


def exact_median(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    out: str,
    buckets: int = 256,
    split_above: int = 4096,
) -> DataFrame:
    """Median of the non-null values of each group.

    The values are counted by sign and power of two, map-side, which shows between
    which two values the middle ranks lie. Where more than ``split_above`` rows are
    left there, they are counted again in ``buckets`` equal widths, until fewer are
    left. Only rows between the last two values are merged and ranked. Every cut is
    monotone and its bounds are values of the group, so rounding in a cut cannot change
    the result. The bounds are found at once, and ``df`` is read once per cut: hand over
    a written table.
    """
    groups = list(groups)
    rows = df.where(F.col(value).isNotNull()).select(*groups, value)
    # A row per date is small by nature; other groups may be many.
    if groups == ["trade_date"]:
        located = lambda span: rows.join(F.broadcast(span), groups)
    else:
        located = lambda span: spread_join(rows, span, groups, [value], "inner")
    within = lambda span: located(span).where(F.col(value).between(F.col("_lo"), F.col("_hi")))
    found = [
        F.count(F.lit(1)).alias("_size"), F.min(value).alias("_lo"), F.max(value).alias("_hi"),
    ]
    carried = ("_before", "_low", "_high")
    # A handful of rows per group reach these windows: its powers of two, or `buckets`.
    order = Window.partitionBy(*groups).orderBy("_bucket")

    def middle(counted: DataFrame) -> DataFrame:
        """Per group the values that enclose both middle ranks."""
        placed = counted.withColumn(
            "_before", F.col("_before") + F.sum("_size").over(order) - F.col("_size")
        )
        return placed.where("_before < _high AND _before + _size >= _low").groupBy(*groups).agg(
            F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.sum("_size").alias("_inside"),
            F.min("_before").alias("_before"), F.max("_low").alias("_low"),
            F.max("_high").alias("_high"),
        )

    x = F.col(value).cast("double")
    power = F.floor(F.log2(F.abs(x))).cast("int") + 1100
    far = F.when(x > 0, 3000).otherwise(-3000)
    bucket = (
        F.when(F.isnan(x), 4000).when(x == 0, 0).when(F.abs(x) == float("inf"), far)
        .when(x > 0, power).otherwise(-power)
    )
    total = F.sum("_size").over(Window.partitionBy(*groups))
    span = middle(
        rows.groupBy(*groups, bucket.alias("_bucket")).agg(*found)
        .withColumns({"_before": F.lit(0).cast("bigint"), "_total": total})
        .withColumns({"_low": F.expr("(_total + 1) div 2"), "_high": F.expr("(_total + 2) div 2")})
    )
    lo, hi = F.col("_lo").cast("double") / 2, F.col("_hi").cast("double") / 2
    share = F.nanvl(F.coalesce(F.try_divide(x / 2 - lo, hi - lo), F.lit(0.0)), F.lit(0.0))
    piece = (
        F.when(F.col(value) <= F.col("_lo"), 0).when(F.col(value) >= F.col("_hi"), buckets)
        .otherwise(F.floor(share * buckets).cast("int"))
    )
    wide = (F.col("_inside") > split_above) & (F.col("_lo") < F.col("_hi"))
    span = stage(span, "median")
    for _ in range(_MOST_CUTS):
        if span.where(wide).isEmpty():
            break
        again = middle(
            within(span.where(wide)).groupBy(*groups, piece.alias("_bucket"))
            .agg(*found, *[F.max(c).alias(c) for c in carried])
        )
        span = stage(span.where(~wide).unionByName(again), "median")
    by_value = Window.partitionBy(*groups).orderBy(value)
    ranked = (
        within(span).groupBy(*groups, value)
        .agg(F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(c) for c in carried])
        .withColumn("_upto", F.sum("_n").over(by_value) + F.col("_before"))
        .withColumn("_from", F.col("_upto") - F.col("_n"))
    )
    low = F.max(F.expr(f"CASE WHEN _from < _low AND _low <= _upto THEN `{value}` END"))
    high = F.max(
        F.expr(f"CASE WHEN _from < _high AND _high <= _upto THEN `{value}` END")
    )
    return ranked.groupBy(*groups).agg(((low + high) / 2).alias(out))


# Whole numbers up to 2^43 are added in two halves, which no number of rows overflows.
_HALF_BITS = 20


def decimal_sum(name: str, precision: int, scale: int) -> Column:
    """Exact sum of doubles cast to decimal(precision, scale), as a double; null without values.

    A double that is the nearest to a whole number of units casts to just that number, so
    these are added as longs; only the others become decimals one by one.
    """
    value, unit = F.col(name), float(10 ** scale)
    count = F.rint(value * unit)
    plain = (F.abs(value) < float(1 << 43) / unit) & (count / unit == value)
    whole = F.when(plain, count.cast("bigint"))
    high = F.sum(F.shiftright(whole, _HALF_BITS))
    low = F.sum(whole.bitwiseAND((1 << _HALF_BITS) - 1))
    odd = F.sum(F.when(plain, None).otherwise(value.cast(f"decimal({precision},{scale})")))
    few = (F.abs(high) < 1 << 32) & (low < 1 << 52)
    step = F.lit(1 << _HALF_BITS)
    joined = high.cast("decimal(20,0)") * step.cast("decimal(8,0)") + low.cast("decimal(20,0)")
    exact = (joined * F.expr(f"CAST({1 / unit:.{scale}f} AS DECIMAL({scale + 1},{scale}))")).cast(f"decimal(38,{scale})")
    total = F.coalesce(exact + odd, odd, exact).cast("double")
    return F.when(odd.isNull() & few, (high * step + low).cast("double") / unit).otherwise(total)


# A part of a double is a whole number of 2^(32 * bin); three parts hold all 53 bits.
_BIN_BITS = 32
_LOWEST_BIN = -30


def reproducible_sums(
    df: DataFrame, groups: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Per group ``<value>_sum`` and ``<value>_count`` of the non-null doubles.

    Doubles are cut into whole numbers of powers of 2^32, which add up exactly in any
    order; their totals are put together in a fixed order at the end. So the sum does
    not depend on partitions, and its error doesn't grow with the number of rows.
    Values that are not finite add up among themselves and then decide the result.
    """
    groups = list(groups)
    pair = lambda name: F.struct(
        F.lit(name).alias("name"), F.col(name).cast("double").alias("v")
    )
    if len(values) == 1:
        long = df.select(*groups, F.lit(values[0]).alias("name"), F.col(values[0]).cast("double").alias("v"))
    else:
        long = df.select(*groups, F.inline(F.array(*[pair(v) for v in values])))
    finite = F.expr("NOT isnan(v) AND abs(v) < double('infinity')")
    lowest = _LOWEST_BIN + 2
    size = F.expr(f"""CASE WHEN v = 0 OR isnan(v) OR abs(v) = double('infinity') THEN {lowest}
        ELSE greatest(CAST(floor(log2(abs(v)) / {_BIN_BITS}) AS INT), {lowest}) END""")
    cut = long.where("v IS NOT NULL").withColumns({"_finite": finite, "_top": size})
    unit = lambda i: f"power(2D, CAST({_BIN_BITS} * (_top - {i}) AS DOUBLE))"
    whole = lambda rest, i: f"CAST({rest} / {unit(i)} AS BIGINT)"
    cut = cut.withColumn("_d0", F.expr(f"CASE WHEN _finite THEN {whole('v', 0)} ELSE 0 END"))
    cut = cut.withColumn("_r1", F.expr(f"CASE WHEN _finite THEN v - _d0 * {unit(0)} ELSE 0D END"))
    cut = cut.withColumn("_d1", F.expr(whole("_r1", 1)))
    cut = cut.withColumn("_d2", F.expr(whole(f"(_r1 - _d1 * {unit(1)})", 2)))
    # Per (group, value, largest bin): at most 32 rows a group and value. Digits, of 34 bits
    # at most, are added in two halves, which no number of rows overflows.
    tops = cut.groupBy(*groups, "name", "_top").agg(
        *[F.sum(F.shiftright(f"_d{i}", 16)).alias(f"_h{i}") for i in range(3)],
        *[F.sum(F.col(f"_d{i}").bitwiseAND(0xFFFF)).alias(f"_l{i}") for i in range(3)],
        F.count(F.lit(1)).alias("_n"), F.sum(F.when(~F.col("_finite"), F.col("v"))).alias("odd"),
    )
    part = lambda i: F.struct(
        (F.col("_top") - i).alias("bin"),
        F.expr(f"CAST(_h{i} AS DECIMAL(20,0)) * 65536BD + _l{i}").cast("decimal(28,0)").alias("digits"),
        (F.col("_n") if i == 0 else F.lit(0).cast("bigint")).alias("counted"), F.col("odd"),
    )
    totals = tops.select(*groups, "name", F.inline(F.array(*[part(i) for i in range(3)]))).groupBy(
        *groups, "name", "bin"
    ).agg(
        F.sum("digits").cast("decimal(30,0)").alias("digits"),
        F.sum("counted").alias("counted"), F.sum("odd").alias("odd"),
    )
    # Each total becomes two numbers that a double holds exactly.
    step = f"{1 << _BIN_BITS}BD"
    high = F.expr(f"CAST(digits div {step} AS DECIMAL(38,0))")
    carried = totals.withColumn("_high", high).withColumn("_low", F.expr(f"digits - _high * {step}"))
    term = lambda digits: F.col(digits).cast("double") * F.pow(
        F.lit(2.0), (F.lit(_BIN_BITS) * F.col("bin")).cast("double")
    )
    terms = F.array_sort(F.flatten(F.collect_list(F.array(
        F.struct((-F.col("bin") - 1).alias("o"), F.lit(0).alias("p"), (term("_high") * float(1 << _BIN_BITS)).alias("x")),
        F.struct((-F.col("bin")).alias("o"), F.lit(1).alias("p"), term("_low").alias("x")),
    ))))
    # Added from the largest bin down, keeping what each addition rounds off.
    folded = """aggregate(_terms, named_struct('s', 0D, 'c', 0D), (a, t) -> named_struct(
        's', a.s + t.x,
        'c', a.c + CASE WHEN abs(a.s) >= abs(t.x) THEN (a.s - (a.s + t.x)) + t.x
                        ELSE (t.x - (a.s + t.x)) + a.s END), a -> a.s + a.c)"""
    summed = carried.groupBy(*groups, "name").agg(
        terms.alias("_terms"), F.sum("counted").alias("_count"), F.sum("odd").alias("_odd")
    ).select(*groups, "name", F.coalesce("_odd", F.expr(folded)).alias("_sum"), "_count")
    mine = lambda v, column: F.max(F.when(F.col("name") == v, F.col(column)))
    found = summed.groupBy(*groups).agg(
        *[mine(v, "_sum").alias(f"{v}_sum") for v in values],
        *[F.coalesce(mine(v, "_count"), F.lit(0)).cast("bigint").alias(f"{v}_count") for v in values],
    )
    return found
