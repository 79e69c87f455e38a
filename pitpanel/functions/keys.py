"""Key handling: required columns, latest per key, uniqueness, hot-key joins."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.schemas import REQUIRED_COLUMNS


def require_columns(df: DataFrame, label: str) -> DataFrame:
    missing = sorted(REQUIRED_COLUMNS[label] - set(df.columns))
    if missing:
        raise ValueError(f"{label} missing columns: " + ", ".join(missing))
    return df


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the greatest by ``order``, then by every other column.

    Spark trims each map partition to one row per key before the shuffle
    (``WindowGroupLimit``), so a key with very many versions stays cheap.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranking = [F.col(c).desc_nulls_last() for c in (*order, *rest)]
    if not ranking:
        return df.dropDuplicates(list(keys))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ranking))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(
        "row_count > 1"
    )


def assert_unique(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Fail when a key repeats; the check itself reads one row back."""
    clash = duplicate_keys(df, keys).limit(1).collect()
    if clash:
        found = ", ".join(f"{k}={clash[0][k]}" for k in keys)
        raise ValueError(f"{label} has repeated key: {found}")
    return df


def unique_or_fail(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """The same rows; the plan fails while it runs when a key repeats.

    The check is part of the plan: no job of its own, and a join on the same keys
    reuses its partitioning. Each task keeps at most two rows of a key, so a key
    with very many copies fails as cheaply as one with two.
    """
    names = [f"_u{i}" for i in range(len(keys))]
    named = df.withColumns({n: F.col(k) for n, k in zip(names, keys, strict=True)})
    place = F.row_number().over(Window.partitionBy(*names).orderBy(*names))
    first_two = named.withColumn("_place", place).where("_place <= 2")
    found = F.concat_ws(", ", *[
        F.concat(F.lit(f"{k}="), F.coalesce(F.col(n).cast("string"), F.lit("null")))
        for n, k in zip(names, keys, strict=True)
    ])
    clash = F.raise_error(F.concat(F.lit(f"{label} has repeated key: "), found))
    checked = first_two.where(F.when(F.col("_place") == 1, True).otherwise(clash.cast("boolean")))
    return checked.drop("_place", *names)


def deal(df: DataFrame, parts: int | None, key: str = "thscode") -> DataFrame:
    """Rows dealt to ``parts`` tasks by their code; without ``parts`` as they are.

    What is grouped, windowed or stacked by date and code afterwards needs no shuffle,
    and the rows of a code, which differ in little, lie side by side when they are sent.
    """
    return df if parts is None else df.repartition(parts, key)


def stack_join(
    base: DataFrame, others: Mapping[str, DataFrame], keys: Sequence[str], label: str
) -> DataFrame:
    """Left join of tables that hold a key once; the plan fails where one repeats a key.

    The rows are stacked and each key is read once, so there are no pairs, a single sort
    serves all tables, and tables dealt by one of the keys are not shuffled again.
    """
    tables = {label: base, **others}
    names = [c for df in tables.values() for c in df.columns if c not in keys]
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    stacked = None
    for place, (name, df) in enumerate(tables.items()):
        rows = (df if place == 0 else df.where(whole)).withColumn("_table", F.lit(place))
        stacked = rows if stacked is None else stacked.unionByName(rows, allowMissingColumns=True)
    counts = {
        f"_rows{place}": F.count(F.when(F.col("_table") == place, 1)) for place in range(len(tables))
    }
    # A value comes from one row only, so the largest is that value.
    found = stacked.groupBy(*keys).agg(
        *[F.max(n).alias(n) for n in names], *[c.alias(n) for n, c in counts.items()]
    )
    shown = F.concat_ws(", ", *[
        F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("null"))) for k in keys
    ])
    present = F.col("_rows0") > 0
    for place, name in enumerate(tables):
        clash = F.raise_error(F.concat(F.lit(f"{name} has repeated key: "), shown))
        present = F.when(F.col(f"_rows{place}") > 1, clash.cast("boolean")).otherwise(present)
    return found.where(present).select(*base.columns, *names[len(base.columns) - len(keys):])


def codes_between(
    df: DataFrame, start: dt.date, end: dt.date, date: str = "as_of_date"
) -> DataFrame:
    """Union of the codes of all dates in a range, each with its first and last date."""
    inside = df.where(F.col(date).between(F.lit(start), F.lit(end)))
    return inside.groupBy("thscode").agg(
        F.min(date).alias("first_date"), F.max(date).alias("last_date")
    )


def spread_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    spread_on: Sequence[str],
    how: str = "left",
    parts: int = 8,
) -> DataFrame:
    """Join a large side to a side unique on ``keys`` without a hot partition.

    Rows of one key are divided over ``parts`` reducers by a hash of
    ``spread_on``; the small side is repeated once per part. Adaptive execution
    still turns this into a broadcast when the small side measures small.
    """
    salt = F.pmod(F.xxhash64(*spread_on), F.lit(parts)).cast("int")
    salted = big.withColumn("_part", salt)
    repeated = small.withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    )
    return salted.join(repeated, [*keys, "_part"], how).drop("_part")


def outside(df: DataFrame, allowed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``df`` that ``allowed`` does not contain."""
    return df.select(*keys).distinct().join(
        allowed.select(*keys).distinct(), list(keys), "left_anti"
    )


def coverage(value: Column) -> Column:
    return F.coalesce(F.try_divide(F.count(value), F.count(F.lit(1))), F.lit(0.0))


def fit_columns(df: DataFrame, fields: Sequence[tuple[str, str]]) -> DataFrame:
    """Project to a fixed schema; an absent column becomes a typed null."""
    have = set(df.columns)
    return df.select(*[
        (F.col(name) if name in have else F.lit(None)).cast(kind).alias(name)
        for name, kind in fields
    ])
