"""Extremes of the last days (say, a year) of daily prices, kept up day by day by a stream.

What a micro-batch brings is added to daily rows in folders by month and to extremes by
month. A day then reads the two months at the edges of its frame and a row a month and key for
those between, whatever the length of the history.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import windows as W
from ledgerloom.sources.tables import freed, scratch
from ledgerloom.streaming.replay import DailyParts, run_stream


def _months(first: date, back: int, last: date, ahead: int) -> list[str]:
    """The first days of all months from ``back`` months off ``first`` to ``ahead`` months off ``last``, as folders are named."""
    number = lambda d: 12 * d.year + d.month - 1
    return [date(m // 12, m % 12 + 1, 1).isoformat() for m in range(number(first) + back, number(last) + ahead + 1)]


class DailyExtremes:
    """Facts ``low_value, low_day, high_value, high_day`` for each row (keys, day) of a price feed.

    Days may come late, and a date in several micro-batches: rows of the same keys whose
    frames hold a late day are told anew. In order, nothing is told twice. ``schema`` is the
    feed's; of rows that repeat keys and day the values of all count.
    """

    def __init__(self, spark: SparkSession, home: str, schema, keys: Sequence[str], day: str, low: str, high: str, days: int = 365):
        self.spark, self.schema, self.keys, self.day, self.low, self.high, self.days = spark, schema, [*keys], day, low, high, days
        at = lambda name, combine=None: DailyParts(spark, f"{home}/{name}", "month_", combine)
        self.daily = at("daily")
        self.monthly = at("monthly", lambda rows: rows.groupBy(*keys, "month_").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi")))
        self.facts = at("facts", lambda rows: rows.groupBy(*keys, day, "month_").agg(F.max_by(F.struct("low_value", "low_day", "high_value", "high_day"), "batch_").alias("_r")).select(*keys, day, "_r.*", "month_"))

    def _marked(self, rows: DataFrame) -> DataFrame:
        return W.with_extremes(rows, self.day, self.low, self.high)

    def step(self, batch: DataFrame, n: int) -> None:
        """Micro-batch ``n``; run again it writes the same parts."""
        rows = scratch(batch.withColumn("month_", F.trunc(self.day, "month")), "batch")
        with freed(rows.sparkSession):
            months = sorted(r[0] for r in rows.select("month_").distinct().collect() if r[0])  # a row a month
        self.daily.write(rows, n)
        extremes = self._marked(rows).groupBy(*self.keys, "month_").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
        self.monthly.write(extremes, n)
        if months:
            self.facts.write(self._told(rows, months[0], months[-1], n), n)

    @property
    def _span(self) -> int:
        """Months that a frame can reach back."""
        return -(-self.days // 28)

    def _told(self, rows: DataFrame, first: date, last: date, n: int) -> DataFrame:
        """Facts of the rows whose frames hold a day of ``rows``; daily rows are read of their own months and of those in which their frames begin."""
        schema = rows.schema
        had = self.daily.live()
        own_months = [m for m in _months(first, 0, last, self._span) if m in had]
        begin = [d - timedelta(self.days - 1) for m in own_months for d in (date.fromisoformat(m), date.fromisoformat(m) + timedelta(30))]
        edge_months = {*own_months, *(d.replace(day=1).isoformat() for d in begin)}
        own = rows.groupBy(*self.keys).agg(F.min(self.day).alias("_from"), F.date_add(F.max(self.day), self.days - 1).alias("_to")).withColumnsRenamed({k: f"_k_{k}" for k in self.keys})
        near = self.daily.read(schema, own_months)
        asked = near.join(own, [*W.same(near, own, self.keys), near[self.day] >= own["_from"], near[self.day] <= own["_to"]], "left_semi")
        edges = self._marked(self.daily.read(schema, [*edge_months]))
        whole = self.monthly.read(edges.select(*self.keys, "_lo", "_hi", "month_").schema, _months(first, -self._span, last, self._span))
        told = W.rolling_extremes_by_month(asked.select(*self.keys, self.day).distinct(), edges, whole, self.keys, self.day, self.days)
        return told.withColumns({"month_": F.trunc(self.day, "month"), "batch_": F.lit(n)})

    def read(self, months: Sequence[str] | None = None) -> DataFrame:
        """Keys, day, low_value, low_day, high_value, high_day: as of the last complete micro-batch, of these months or all."""
        kinds = self.spark.createDataFrame([], self.schema).schema
        name = lambda c: kinds[c].dataType.simpleString()
        schema = ", ".join(f"{k} {name(k)}" for k in self.keys) + f", {self.day} date, low_value {name(self.low)}, low_day date, high_value {name(self.high)}, high_day date, batch_ int, month_ date"
        return self.facts.read(schema, months).drop("month_")

    def run(self, source: DataFrame, checkpoint: str) -> None:
        """All that the source has now."""
        run_stream(source, self.step, checkpoint)
