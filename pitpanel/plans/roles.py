"""The driver tables seen as market data, through DataFrame operations."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitpanel.functions.keys import deal
from pitpanel.functions.stats import decimal_sum


def _hours(day: str, hours: int):
    return F.expr(f"CAST({day} AS TIMESTAMP_NTZ) + INTERVAL '{hours}' HOUR")


TICKET = ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
# Suppliers with more lines than this are added up before their lines are shuffled.
MANY_LINES = 1_000_000
# Lines dealt to a task; the rows made of them, the widest included, fit into its memory.
LINES_A_TASK = 100_000
# What is asked of a line, by code.
LINE = ("l_suppkey", "trade_date", *TICKET, "l_quantity", "l_returnflag", "l_linestatus")


def _code(key: str) -> Column:
    """The code of a supplier's number."""
    kind = F.col(key) % 5
    prefix = (
        F.when(kind == 0, "600").when(kind == 1, "688").when(kind == 2, "000")
        .when(kind == 3, "300").otherwise("920")
    )
    suffix = F.when(kind < 2, ".SH").when(kind < 4, ".SZ").otherwise(".BJ")
    number = F.col(key).cast("string")
    # Padded but never cut: every supplier has a code of its own.
    padded = F.lpad(number, F.greatest(F.length(number), F.lit(3)), "0")
    return F.concat(prefix, padded, suffix)


class Roles:
    """Lazy role views over one directory of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def codes(self) -> DataFrame:
        return self.table("supplier").select(
            "s_suppkey", "s_name", "s_acctbal", "s_nationkey", _code("s_suppkey").alias("thscode")
        )

    @cached_property
    def line_count(self) -> int:
        """Read from the ends of the files."""
        return self.table("lineitem").count()

    @cached_property
    def parts(self) -> int:
        """Tasks that the lines are dealt to by code."""
        return max(self.spark.sparkContext.defaultParallelism, -(-self.line_count // LINES_A_TASK))

    @cached_property
    def heavy(self) -> list[int]:
        """Suppliers with more than ``MANY_LINES`` lines: a millionth as many as lines at most."""
        if self.line_count <= MANY_LINES:
            return []
        lines = self.table("lineitem").where("l_suppkey IS NOT NULL")
        counts = lines.groupBy("l_suppkey").count().where(F.col("count") > MANY_LINES)
        return [row[0] for row in counts.select("l_suppkey").collect()]

    def from_lines(self, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """What ``make`` groups the lines to by code and day, dealt by code.

        The lines are dealt once, so groups, windows and stacked joins by code, or by date and
        code, share that shuffle. Lines of heavy suppliers are grouped map-side first.
        """
        lines = self.table("lineitem").withColumns({
            "trade_date": F.to_date("l_shipdate"), "thscode": _code("l_suppkey"),
        }).select("thscode", *LINE)
        if not self.heavy:
            return make(deal(lines, self.parts))
        heavy = F.coalesce(F.col("l_suppkey").isin(self.heavy), F.lit(False))
        return make(deal(lines.where(~heavy), self.parts)).unionByName(
            deal(make(lines.where(heavy)), self.parts)
        )

    def dealt_codes(self, *columns: str) -> DataFrame:
        return deal(self.codes.select("thscode", *columns), self.parts)

    @cached_property
    def bars_raw(self) -> DataFrame:
        """Daily bars per supplier; first and last price by (order, line, part, price)."""
        ticket = F.struct(*TICKET)
        money = lambda c: decimal_sum(c, 18, 2)
        return self.from_lines(lambda lines: lines.groupBy("thscode", "l_suppkey", "trade_date").agg(
            F.min(ticket)["l_extendedprice"].alias("open"),
            F.max("l_extendedprice").alias("high"),
            F.min("l_extendedprice").alias("low"),
            F.max(ticket)["l_extendedprice"].alias("close"),
            money("l_quantity").alias("volume"),
            money("l_extendedprice").alias("amount"),
            (money("l_extendedprice") / F.count(F.lit(1))).alias("avg_price"),
        ))

    @cached_property
    def trade_dates(self) -> DataFrame:
        return (
            self.table("lineitem")
            .select(F.to_date("l_shipdate").alias("trade_date")).distinct()
        )

    @cached_property
    def security_reference(self) -> DataFrame:
        first = self.table("lineitem").groupBy("l_suppkey").agg(
            F.to_date(F.min("l_shipdate")).alias("listing_date")
        )
        shares = lambda base, step: F.when(
            F.col("s_acctbal") >= 0, (base + F.col("s_suppkey") * step).cast("double")
        )
        facts = self.codes.join(first, F.col("s_suppkey") == F.col("l_suppkey")).select(
            "thscode", F.col("s_name").alias("security_name"), "listing_date",
            shares(F.lit(1000000), 1000).alias("total_shares"),
            shares(F.lit(500000), 500).alias("float_a_shares"),
        )
        return deal(facts, self.parts)

    @cached_property
    def coded_bars(self) -> DataFrame:
        codes = self.dealt_codes("s_suppkey", "s_name", "s_acctbal", "s_nationkey")
        return self.bars_raw.join(codes, "thscode").withColumn("security_name", F.col("s_name"))

    @cached_property
    def daily_quotes(self) -> DataFrame:
        order = Window.partitionBy("thscode").orderBy("trade_date")
        shares = (F.lit(1000000) + F.col("s_suppkey") * 1000).cast("double")
        return self.coded_bars.withColumn(
            "pre_close", F.lag("close").over(order)
        ).select(
            "trade_date", "thscode", "security_name", "open", "high", "low", "close",
            "pre_close", "avg_price", "volume", "amount",
            (F.col("volume") / shares * 100).alias("turnover_ratio"),
            ((F.try_divide(F.col("close"), F.col("pre_close")) - 1) * 100)
            .alias("change_ratio"),
        )

    @cached_property
    def quote_moves(self) -> DataFrame:
        """Date, code, change and amount of the daily quotes, with a single shuffle of rows.

        Lines meet at their supplier, so that bars and their look back share one shuffle and
        one sort. Suppliers with very many lines take the other way: added up map-side, so
        that no task reads all of their lines.
        """
        lines = self.table("lineitem").select(
            "l_suppkey", F.to_date("l_shipdate").alias("trade_date"), *TICKET
        ).where("l_suppkey IS NOT NULL")
        # At most a millionth as many rows as lines.
        many = F.broadcast(
            lines.groupBy("l_suppkey").count().where(F.col("count") > MANY_LINES)
            .select("l_suppkey")
        )
        order = Window.partitionBy("l_suppkey").orderBy("trade_date")

        def moves(lines: DataFrame) -> DataFrame:
            bars = lines.groupBy("l_suppkey", "trade_date").agg(
                F.max(F.struct(*TICKET))["l_extendedprice"].alias("close"),
                decimal_sum("l_extendedprice", 18, 2).alias("amount"),
            )
            codes = self.codes.select(F.col("s_suppkey").alias("l_suppkey"), "thscode")
            return bars.join(codes, "l_suppkey").withColumn(
                "pre_close", F.lag("close").over(order)
            ).select(
                "trade_date", "thscode",
                ((F.try_divide(F.col("close"), F.col("pre_close")) - 1) * 100)
                .alias("change_ratio"),
                "amount",
            )

        few = lines.join(many, "l_suppkey", "left_anti").repartition("l_suppkey")
        return moves(few).unionByName(moves(lines.join(many, "l_suppkey", "left_semi")))

    @cached_property
    def bar_keys(self) -> DataFrame:
        """Quoted (date, code) pairs without the price work."""
        pairs = self.from_lines(
            lambda lines: lines.select("thscode", "trade_date").distinct()
        )
        return pairs.join(self.dealt_codes("s_suppkey", "s_name"), "thscode").select(
            "trade_date", "thscode", "s_suppkey", F.col("s_name").alias("security_name")
        )

    @cached_property
    def universe(self) -> DataFrame:
        """A code is listed on the dates it trades and the four days after."""
        # Days up to the next trade only, so that none comes twice and none is shuffled.
        order = Window.partitionBy("thscode", "security_name").orderBy("trade_date")
        following = F.date_sub(F.lead("trade_date").over(order), 1)
        last = F.least(F.date_add("trade_date", 4), following)
        days = F.sequence(F.col("trade_date"), F.col("_last"))
        return (
            self.bar_keys.withColumn("_last", last).where("_last >= trade_date")
            .select(F.explode(days).alias("as_of_date"), "thscode", "security_name")
            .join(
                F.broadcast(self.trade_dates.withColumnRenamed("trade_date", "as_of_date")),
                "as_of_date", "left_semi",
            )
            .select(
                "as_of_date", "thscode", "security_name",
                F.col("security_name").alias("security_name_in_time"),
            )
        )

    @cached_property
    def trading_calendar(self) -> DataFrame:
        day = F.col("trade_date")
        open_day = (F.weekday(day) < 5) & (F.dayofmonth(day) != 1)
        return self.trade_dates.select(
            "trade_date", F.lit("SSE").alias("calendar"), open_day.alias("is_open")
        )

    @cached_property
    def adjustment_factors(self) -> DataFrame:
        split = F.expr("DATE '1999-03-01'")
        factor = lambda early: F.when(F.col("trade_date") < split, early).otherwise(1.0)
        first = self.bar_keys.select(
            "trade_date", "thscode", factor(0.5).alias("adj_factor"),
            _hours("trade_date", 10).alias("known_at"),
        )
        revised = self.bar_keys.where("s_suppkey % 3 = 0").select(
            "trade_date", "thscode", factor(0.25).alias("adj_factor"),
            _hours("trade_date", 58).alias("known_at"),
        )
        return first.unionByName(revised)

    @cached_property
    def corporate_actions(self) -> DataFrame:
        late = F.col("l_linenumber") % 4 == 0
        events = self.from_lines(lambda lines: lines.select(
            "thscode", F.col("trade_date").alias("effective_at"), late.alias("late"),
            F.concat(F.lit("RF_"), "l_returnflag", "l_linestatus").alias("event_type"),
        ).distinct())
        return (
            events.join(self.dealt_codes(), "thscode")
            .select(
                "thscode", "event_type", "effective_at",
                F.when(F.col("late"), _hours("effective_at", 15))
                .otherwise(_hours("effective_at", 9)).alias("known_at"),
                F.lit(None).cast("timestamp_ntz").alias("published_at"),
            )
        )

    @cached_property
    def industry_membership(self) -> DataFrame:
        located = (
            self.codes.join(self.table("nation"), F.expr("s_nationkey = n_nationkey"))
            .join(self.table("region"), F.expr("n_regionkey = r_regionkey"))
        )
        early = F.expr("TIMESTAMP_NTZ '1995-01-01 00:00:00'")
        begin = F.expr("DATE '1995-01-01'")
        never = F.lit(None).cast("date")

        def rows(df, level, code, name, start, end, known):
            return df.select(
                "thscode", F.lit("SW").alias("classification_system"),
                F.lit(level).alias("level"), code.alias("industry_code"),
                name.alias("industry_name"), start.alias("effective_from"),
                end.alias("effective_to"), known.alias("known_at"),
            )

        text = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
        fourth = F.col("s_suppkey") % 4 == 0
        region = rows(
            located, "SW1", text("R", "r_regionkey"), F.col("r_name"), begin, never, early
        )
        nation = rows(
            located, "SW2", text("N", "n_nationkey"), F.col("n_name"), begin,
            F.when(fourth, F.expr("DATE '1998-12-31'")), early,
        )
        moved = rows(
            located.where(fourth), "SW2", text("NX", "n_regionkey"),
            F.lit("RECLASSIFIED"), F.expr("DATE '1999-01-01'"), never,
            F.when(F.col("s_suppkey") % 8 == 0,
                   F.expr("TIMESTAMP_NTZ '1999-06-02 15:00:00'"))
            .otherwise(F.expr("TIMESTAMP_NTZ '1998-12-15 00:00:00'")),
        )
        return region.unionByName(nation).unionByName(moved)

    @cached_property
    def index_membership(self) -> DataFrame:
        lines = self.table("lineitem").select(
            "l_partkey", "l_suppkey", "l_quantity", F.to_date("l_shipdate").alias("day")
        )
        brands = self.table("part").select("p_partkey", "p_brand")
        held = lines.join(brands, F.expr("l_partkey = p_partkey")).groupBy(
            "p_brand", "l_suppkey"
        ).agg(
            F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("weight"),
            F.min("day").alias("effective_from"),
            F.max("day").alias("effective_to"),
        )
        return held.join(self.codes, F.expr("l_suppkey = s_suppkey")).select(
            F.col("p_brand").alias("index_code"), F.col("p_brand").alias("index_name"),
            "thscode", "weight", "effective_from", "effective_to",
            _hours("effective_from", 10).alias("known_at"),
        )

    @cached_property
    def index_quotes(self) -> DataFrame:
        """Mean close per date, over all codes and over the odd ones."""
        odd = F.col("l_suppkey") % 2 == 1
        money = F.col("close").cast("decimal(18,2)")
        sums = self.bars_raw.groupBy("trade_date").agg(
            (F.sum(money).cast("double") / F.count(F.lit(1))).alias("whole"),
            F.try_divide(
                F.sum(F.when(odd, money)).cast("double"), F.count(F.when(odd, 1))
            ).alias("half"),
        )
        pair = F.array(
            F.struct(F.lit("000300.SH").alias("thscode"), F.col("whole").alias("close")),
            F.struct(F.lit("000852.SH").alias("thscode"), F.col("half").alias("close")),
        )
        return sums.select("trade_date", F.inline(pair)).where("close IS NOT NULL")

    @cached_property
    def provider_tradability(self) -> DataFrame:
        key = F.col("s_suppkey")
        kind = key % 5
        limit = F.when(kind.isin(1, 3), 20.0).when(kind == 4, 30.0).otherwise(10.0)
        return self.bar_keys.select(
            F.col("trade_date").alias("as_of_date"), "thscode",
            (key % 11 == 0).alias("is_st"),
            F.when(key % 13 != 0, key % 7 == 0).alias("is_suspended"),
            limit.alias("daily_price_limit_pct"),
            F.when(key % 17 != 0, 100.0).alias("lot_size"),
            F.when(key % 19 == 0, _hours("trade_date", 15))
            .otherwise(_hours("trade_date", 10)).alias("known_at"),
        )
