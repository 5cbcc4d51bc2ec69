"""Weekly refresh: the changed rows of a feed are added to its stored aggregate with a sign.

Sums are linear, so the aggregate of this week's feed is last week's plus the
sum of the rows that came (+1) less those that went (-1); a corrected row is one
of each.  The state keeps what a sum alone loses: the number of rows behind a
key (a key without rows goes), of non-NULL values behind each measure (a sum
of NULLs only is NULL) and of rows for which a flag holds.  The result
equals a rebuild from the whole feed, with late rows, corrections and deletions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planmart.options import DEFAULT, PlanOptions
from planmart.plans import clean
from planmart.plans.clean import KEYS, REVENUE_MEASURES
from planmart.sources.store import MartStore, Version

SIGN = "_sign"
MONEY_SUM = "decimal(38,6)"


class OtherState(Exception):
    """The changes don't continue the stored state."""


def row_changes(prev: DataFrame, cur: DataFrame) -> DataFrame:
    """The rows that `cur` has more often (positive _sign) or less often (negative) than `prev`.

    Rows are compared as a whole, NULLs equal NULLs.  Equal rows of a task cancel before
    the shuffle, and rows that both weeks have aren't in the result.
    """
    cols = [f"`{c}`" for c in cur.columns]
    both = prev.select(*cols, F.lit(-1).alias(SIGN)).unionByName(cur.select(*cols, F.lit(1).alias(SIGN)))
    return both.groupBy(*cols).agg(F.sum(SIGN).alias(SIGN)).where(F.col(SIGN) != 0)


@dataclass(frozen=True)
class SignedSums:
    """A maintained GROUP BY `keys`, SUM(`measures`), with a count of rows for each of `flags`."""
    keys: tuple[str, ...]
    measures: tuple[str, ...]
    flags: tuple[str, ...] = ()

    def _counts(self) -> list[str]:
        return ["_rows", *[f"_n_{m}" for m in self.measures], *[f"_n_{f}" for f in self.flags]]

    def of(self, rows: DataFrame, sign: Column | str = SIGN) -> DataFrame:
        """The state of signed `rows`: a new state where all signs are 1, else what to add to one."""
        s = F.col(sign) if isinstance(sign, str) else sign
        value = lambda m: F.coalesce(F.sum(s * F.col(m).cast(MONEY_SUM)), F.lit(0)).cast(MONEY_SUM)
        number = lambda on: F.sum(F.when(on, s).otherwise(0)).cast("long")                         # noqa: E731
        return rows.groupBy(*self.keys).agg(
            *[value(m).alias(m) for m in self.measures], F.sum(s).cast("long").alias("_rows"),
            *[number(F.col(m).isNotNull()).alias(f"_n_{m}") for m in self.measures],
            *[number(F.col(f)).alias(f"_n_{f}") for f in self.flags])

    def add(self, state: DataFrame, changes: DataFrame) -> DataFrame:
        """The state after `changes` (another state, from signed rows); keys without rows go.

        One shuffle of the aggregate; the feed isn't read.  A key left with fewer
        rows than none fails the job: those changes belong to another state.
        """
        both = state.unionByName(changes.select(*state.columns))
        out = both.groupBy(*self.keys).agg(*[F.sum(m).cast(MONEY_SUM).alias(m) for m in self.measures],
                                           *[F.sum(c).alias(c) for c in self._counts()])
        wrong = F.raise_error(F.lit("changes take away rows that the state doesn't hold")).cast("long")
        return out.withColumn("_rows", F.when(F.col("_rows") < 0, wrong).otherwise(F.col("_rows"))).where("_rows <> 0")

    def result(self, state: DataFrame) -> DataFrame:
        """The maintained aggregate; each flag tells whether a row of the key has it."""
        return state.select(*self.keys, *[F.when(F.col(f"_n_{m}") > 0, F.col(m)).alias(m) for m in self.measures],
                            *[(F.col(f"_n_{f}") > 0).alias(f) for f in self.flags])


REVENUE = SignedSums(KEYS, REVENUE_MEASURES, ("_nonzero",))


def revenue_rows(revenue: DataFrame, opts: PlanOptions = DEFAULT) -> DataFrame:
    """Rows of the revenue feed as REVENUE adds them up; a _sign column stays."""
    return clean.split_measures(revenue, opts, with_activity=True, keep=[c for c in revenue.columns if c == SIGN]).select(
        "Account_No", "Fiscal_Month", F.col("Product_Category_2").alias("Product_Category"),
        F.col("Revenue_Actuals").alias("Revenue"), "Partner_Fee", "Registration_Fee", F.col("_nz").alias("_nonzero"),
        *([SIGN] if SIGN in revenue.columns else []))


def revenue_state(revenue: DataFrame, opts: PlanOptions = DEFAULT) -> DataFrame:
    """P1's state from a whole feed."""
    return REVENUE.of(revenue_rows(revenue, opts), F.lit(1))


def refreshed_revenue(state: DataFrame, changes: DataFrame, opts: PlanOptions = DEFAULT) -> DataFrame:
    """P1's state after the signed rows `changes` of the feed."""
    return REVENUE.add(state, REVENUE.of(revenue_rows(changes, opts)))


class RevenueRefresh:
    """P1 kept up to date in a mart store: a version per week, each made from the one before.

    A week that the store has already is not added again, so a refresh that was lost
    after it was shown can be repeated.  A failed refresh leaves the state of the week before.
    """

    def __init__(self, store: MartStore, name: str = "revenue_state", opts: PlanOptions = DEFAULT):
        self.store, self.name, self.opts = store, name, opts

    @property
    def week(self) -> int | None:
        shown = self.store.current(self.name)
        return int(shown.properties["week"]) if shown else None

    def _show(self, state: DataFrame, week: int) -> Version:
        staged = self.store.stage(state, self.name, check=lambda _: {"week": str(week)})
        self.store.show(staged)
        return staged

    def start(self, revenue: DataFrame, week: int) -> None:
        """The first state, from a whole feed."""
        self._show(revenue_state(revenue, self.opts), week)

    def apply(self, changes: DataFrame, week: int) -> bool:
        """Add `week`'s signed rows; False if the state has that week already."""
        now = self.week
        if now is None or week > now + 1:
            raise OtherState(f"week {week} can't follow week {now}")
        if week <= now:
            return False
        self._show(refreshed_revenue(self.store.read(self.name), changes, self.opts), week)
        return True

    def p1(self) -> DataFrame:
        """P1 of the week shown, with `_nonzero`; `Plan(inputs, opts, p1=...)` builds marts from it
        without reading the feed."""
        return REVENUE.result(self.store.read(self.name))
