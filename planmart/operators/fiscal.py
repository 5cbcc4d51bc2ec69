"""Fiscal calendar dimension and the fiscal context of a revenue snapshot.

The calendar is a day-level dimension, bounded by the days it covers.  Its
joins carry no hint: the planner broadcasts it by its size statistics, and
adaptive execution decides again from the real size.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Calendar:
    """Day-level calendar: Date_Value, Fiscal_Month, Fiscal_Quarter, Fiscal_Year, Month_ID."""

    def __init__(self, df: DataFrame, unique_days: bool = False):
        self.df = df
        # A generated calendar has one row per day: day-level DISTINCTs are no-ops.
        self.unique_days = unique_days

    def _dim(self, *cols: str) -> DataFrame:
        dim = self.df.select(*cols)
        return dim if self.unique_days and "Date_Value" in cols else dim.distinct()

    def days(self) -> DataFrame:
        """DISTINCT (Date_Value, Fiscal_Month)."""
        return self._dim("Date_Value", "Fiscal_Month")

    def days_wide(self) -> DataFrame:
        """DISTINCT (Date_Value, Fiscal_Month, Fiscal_Year, Month_ID)."""
        return self._dim("Date_Value", "Fiscal_Month", "Fiscal_Year", "Month_ID")

    def months(self) -> DataFrame:
        """DISTINCT (Fiscal_Month, Month_ID)."""
        return self._dim("Fiscal_Month", "Month_ID")

    def month_dim(self) -> DataFrame:
        """DISTINCT month attributes: one row per fiscal month."""
        return self._dim("Fiscal_Month", "Fiscal_Quarter", "Fiscal_Year", "Month_ID")


def to_fiscal_month(df: DataFrame, cal: Calendar, date_col: str, keep_date: bool = False,
                    wide: bool = False) -> DataFrame:
    """LEFT JOIN a date column to its fiscal month (NULL when outside the calendar)."""
    days = cal.days_wide() if wide else cal.days()
    out = df.join(days, df[date_col] == days["Date_Value"], "left")
    return out.drop("Date_Value") if keep_date else out.drop("Date_Value", date_col)


class FiscalContext:
    """Cutoff of a revenue snapshot and the fiscal month/year it falls in.

    Everything is read from one scalar subquery over the revenue feed and the
    calendar, so each plan holds its own cutoff and a view over it follows new
    data.  Spark runs the subquery once per query, however often it is used.
    As in the worksheet, a cutoff that the calendar maps to several months is
    an error, and one that it doesn't hold has NULL month and year and selects
    nothing.
    """

    def __init__(self, cutoff: DataFrame, cal: Calendar):
        self.cal = cal
        self._cutoff = cutoff

    @cached_property
    def row(self) -> DataFrame:
        """One row: Cutoff_Date, Fiscal_Month, Fiscal_Year, Month_ID (NULL where the calendar lacks it)."""
        days = self.cal.days_wide()
        return (self._cutoff.join(days, self._cutoff["Cutoff_Date"] == days["Date_Value"], "left")
                .select("Cutoff_Date", "Fiscal_Month", "Fiscal_Year", "Month_ID"))

    @cached_property
    def value(self) -> Column:
        """The row, its date spans and the months left in its year, as one scalar subquery.

        The days of one fiscal year (366 at most) are folded into an array.
        """
        year = (self.cal.df.groupBy(F.col("Fiscal_Year").alias("_y"))
                .agg(F.collect_set(F.struct("Date_Value", "Fiscal_Month", "Month_ID")).alias("_days")))
        row = self.row.join(year, F.col("Fiscal_Year") == F.col("_y"), "left")
        in_month = F.transform(F.filter("_days", lambda d: d["Fiscal_Month"] == F.col("Fiscal_Month")),
                               lambda d: d["Date_Value"])
        dates = F.transform("_days", lambda d: d["Date_Value"])
        future = F.array_distinct(F.transform(
            F.filter("_days", lambda d: (d["Date_Value"] > F.col("Cutoff_Date"))
                     & (d["Fiscal_Month"] != F.col("Fiscal_Month"))),
            lambda d: F.struct(d["Fiscal_Month"].alias("Fiscal_Month"), d["Month_ID"].alias("Month_ID"))))
        return row.select(F.struct(
            "Cutoff_Date", "Fiscal_Month", "Fiscal_Year", "Month_ID",
            F.array_min(in_month).alias("Month_Start"), F.array_max(in_month).alias("Month_End"),
            F.array_min(dates).alias("Year_Start"), F.array_max(dates).alias("Year_End"),
            F.array_max(F.transform(future, lambda m: m["Month_ID"])).alias("Last_ID"),
            future.alias("Future"))).scalar()

    @property
    def cutoff(self) -> Column:
        return self.value["Cutoff_Date"]

    @property
    def fiscal_month(self) -> Column:
        return self.value["Fiscal_Month"]

    @property
    def fiscal_year(self) -> Column:
        return self.value["Fiscal_Year"]

    @property
    def month_id(self) -> Column:
        return self.value["Month_ID"]

    def in_cutoff_month(self, date_col: str) -> Column:
        """Superset pre-filter: dates within the cutoff fiscal month's span."""
        return F.col(date_col).between(self.value["Month_Start"], self.value["Month_End"])

    def in_year(self, date_col: str) -> Column:
        """Superset pre-filter: dates within the cutoff's fiscal year."""
        return F.col(date_col).between(self.value["Year_Start"], self.value["Year_End"])

    def after_cutoff_in_year(self, date_col: str) -> Column:
        """Superset pre-filter: dates after the cutoff, up to the fiscal year's end."""
        return (F.col(date_col) > self.cutoff) & (F.col(date_col) <= self.value["Year_End"])

    def last_months(self, date_col: str, months: int) -> Column:
        """Superset pre-filter: dates of the last `months` fiscal months up to the cutoff's."""
        span = (self.cal.df.where((F.col("Month_ID") > self.month_id - months) & (F.col("Month_ID") <= self.month_id))
                .agg(F.struct(F.min("Date_Value").alias("first"), F.max("Date_Value").alias("last"))).scalar())
        return F.col(date_col).between(span["first"], span["last"])

    def future_array(self) -> Column:
        """The months of the cutoff's fiscal year after the cutoff month, as an
        ``array<struct<Fiscal_Month, Month_ID>>`` (eleven at most).

        Repeating a row for each remaining month is then an ``explode`` of this
        array (a generator inside the row's own stage), not a join.
        """
        return self.value["Future"]

    @property
    def last_future_id(self) -> Column:
        return self.value["Last_ID"]

    def future_months(self) -> DataFrame:
        """Months of the cutoff's fiscal year after the cutoff month."""
        days = self.cal.df.select("Date_Value", "Fiscal_Month", "Month_ID", F.col("Fiscal_Year").alias("_y"))
        now = self.row.select("Cutoff_Date", F.col("Fiscal_Month").alias("_m"), "Fiscal_Year")
        return (days.join(now, F.col("_y") == F.col("Fiscal_Year"))
                .where((F.col("Date_Value") > F.col("Cutoff_Date")) & (F.col("Fiscal_Month") != F.col("_m")))
                .select("Fiscal_Month", "Month_ID").distinct())

    def as_frame(self) -> DataFrame:
        return self.row


def cutoff_of(revenue_summed: DataFrame) -> DataFrame:
    """The same cutoff from the revenue aggregate's ``_nonzero`` flag.

    MAX over groups of their month, among groups holding a raw row with
    Revenue <> 0, equals MAX(Month) WHERE Revenue <> 0 over the feed.
    """
    return (revenue_summed.filter(F.col("_nonzero"))
            .agg(F.max("Fiscal_Month").alias("Cutoff_Date")))


def cutoff_from_raw(revenue_raw: DataFrame) -> DataFrame:
    """Same cutoff straight from the raw feed: MAX(Month) WHERE Revenue <> 0.

    Reads two columns of the feed; the partial aggregate leaves one row per task.
    """
    return (revenue_raw.filter(F.col("Revenue") != 0)
            .agg(F.max("Month").alias("Cutoff_Date")))
