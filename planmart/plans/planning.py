"""Planning pipelines: baseline, targets, run rate and the combined facts.

P6 revenue ⟗ opportunity, P7 baseline, P9 baseline ⟗ target, P10 run rate,
P11 (baseline ⟗ target) ⟗ run rate, P12 all transactional facts, O6 baseline
variants.  ``Plan`` builds each step once per input set so that the marts
share one lazily evaluated DAG.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from functools import cached_property, reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from planmart.functions import rules as R
from planmart.operators.fiscal import FiscalContext, cutoff_from_raw, cutoff_of, to_fiscal_month
from planmart.operators.joins import (cogroup_full_outer, full_outer_coalesce, full_outer_marked,
                                      full_outer_repeating, marks, union_combine)
from planmart.options import DEFAULT, PlanOptions
from planmart.plans import clean
from planmart.plans import keys as keys_of
from planmart.plans.clean import KEYS, REVENUE_MEASURES
from planmart.session import freed_shuffles, shared_dir
from planmart.sources import files
from planmart.sources.adapters import Inputs

OPPORTUNITY_MEASURES = ("Opportunity_Usage", "Opportunity_Extrapolation")
P12_MEASURES = (*REVENUE_MEASURES, *OPPORTUNITY_MEASURES,
                "Baseline", "Target", "Opportunities_Into_RR")
SHARED_STEPS = ("p1", "p2", "p3", "p8", "ctx")


class Counts:
    """Row counts of a step that is written in several parts, read like one observation."""

    def __init__(self, parts: Sequence[Observation]):
        self.parts = parts

    @property
    def get(self) -> dict[str, int]:
        return {"rows": sum(o.get["rows"] for o in self.parts)}


class Plan:
    """All planning steps over one set of inputs."""

    def __init__(self, inputs: Inputs, opts: PlanOptions = DEFAULT, p1: DataFrame | None = None):
        """`p1`: a maintained revenue aggregate with `_nonzero` (`plans/refresh.py`); the plan
        then reads it, also for the cutoff, in place of the revenue feed."""
        self.raw = inputs
        self.inputs = keys_of.with_normal_keys(inputs, opts.key_collation) if opts.key_collation else inputs
        self.opts = opts
        self.cal = inputs.calendar
        self.given_p1 = self._p1_shared = p1
        # Filled while the plan's frames are written: rows per step (see `counting`).
        self.observations: dict[str, Observation | Counts] | None = None

    def counted(self, step: str, df: DataFrame) -> DataFrame:
        """``df``, with its row count observed under ``step`` when a run asks for counts."""
        if self.observations is None or step in self.observations:
            return df
        self.observations[step] = Observation(step)
        return df.observe(self.observations[step], F.count(F.lit(1)).alias("rows"))

    def counted_parts(self, step: str, parts: list[DataFrame]) -> list[DataFrame]:
        """The same for a step in several parts, whose rows are added up."""
        if self.observations is None or step in self.observations:
            return parts
        each = [Observation(f"{step}_{k}") for k in range(len(parts))]
        self.observations[step] = Counts(each)
        return [df.observe(o, F.count(F.lit(1)).alias("rows")) for df, o in zip(parts, each, strict=True)]

    @contextmanager
    def persisted(self):
        """Scan the revenue feed once for a whole build (both marts, audits).

        The revenue aggregate is persisted (memory, spilling to disk; lost
        blocks are recomputed from lineage) and the cutoff, the baseline and
        the merge all read it.  Registered single queries stay lazy instead.
        """
        whole = (self.given_p1 if self.given_p1 is not None
                 else clean.clean_revenue(self.inputs.revenue, self.opts, with_activity=True))
        shared = whole.persist(StorageLevel.MEMORY_AND_DISK)
        self._share(shared)
        try:
            yield self
        finally:
            self._p1_shared = self.given_p1
            shared.unpersist()

    @contextmanager
    def stored(self):
        """The same for a build that must do with little disk: the revenue aggregate is kept in files on
        shared storage, and the shuffles that made it are gone before the merge begins its own.
        Frames of the plan are to be written out before the context ends.
        """
        if self.given_p1 is not None:
            yield self
            return
        whole = clean.clean_revenue(self.inputs.revenue, self.opts, with_activity=True)
        spark = whole.sparkSession
        path = shared_dir(spark, "aggregate") + "/rows"
        try:
            with freed_shuffles(spark):
                whole.write.parquet(path)
                self._share(spark.read.schema(whole.schema).parquet(path))
                yield self
        finally:
            self._p1_shared = None
            for name in SHARED_STEPS:
                self.__dict__.pop(name, None)
            files.delete(spark, path)

    def _share(self, p1: DataFrame) -> None:
        """The steps that are built from now on read this revenue aggregate."""
        self._p1_shared = p1
        for name in SHARED_STEPS:
            self.__dict__.pop(name, None)

    # -- cleaned feeds -----------------------------------------------------
    @cached_property
    def p1(self) -> DataFrame:
        if self._p1_shared is not None:
            return self.counted("p1_clean_revenue", self._p1_shared.drop("_nonzero"))
        return clean.clean_revenue(self.inputs.revenue, self.opts)

    @cached_property
    def p2(self) -> DataFrame:
        return clean.revenue_by_fiscal_month(self.p1, self.cal)

    @cached_property
    def p3(self) -> DataFrame:
        return self.counted("p3_clean_opportunity",
                            clean.clean_opportunity(self.inputs.opportunities, self.cal, self.opts))

    @cached_property
    def p8(self) -> DataFrame:
        return self.counted("p8_targets", clean.targets_by_fiscal_month(self.inputs.targets, self.cal))

    # -- fiscal context (P4, P5) ---------------------------------------------
    @cached_property
    def ctx(self) -> FiscalContext:
        if self._p1_shared is not None:
            return FiscalContext(cutoff_of(self._p1_shared), self.cal)
        return FiscalContext(cutoff_from_raw(self.inputs.revenue), self.cal)

    def future_months(self) -> DataFrame:
        return self.ctx.future_months()

    # -- P6 ------------------------------------------------------------------
    def revenue_opportunity(self) -> DataFrame:
        return full_outer_coalesce(self.p2,
                                   self.p3.select(*KEYS, *OPPORTUNITY_MEASURES),
                                   KEYS, REVENUE_MEASURES, OPPORTUNITY_MEASURES)

    # -- P7 ------------------------------------------------------------------
    def baseline(self) -> DataFrame:
        """Last closed month's Partner_Fee + Revenue repeated over the future months."""
        if self._p1_shared is not None:
            month_p1 = self.p1.filter(self.ctx.in_cutoff_month("Fiscal_Month"))
        else:
            # Only the cutoff month is read: the span filter reaches the revenue scan.
            month_rev = self.inputs.revenue.filter(self.ctx.in_cutoff_month("Month"))
            month_p1 = clean.clean_revenue(month_rev, self.opts)
        p2 = clean.revenue_by_fiscal_month(month_p1, self.cal)
        last = (p2.filter(F.col("Fiscal_Month") == self.ctx.fiscal_month)
                .select("Account_No", "Product_Category",
                        (F.col("Partner_Fee") + F.col("Revenue")).alias("Baseline")))
        return self._over_future_months(last).select(*KEYS, "Baseline")

    def _over_future_months(self, df: DataFrame) -> DataFrame:
        """Each row once per remaining month of the fiscal year (``Fiscal_Month``).

        The worksheet's CROSS JOIN with at most eleven months, as an explode of
        an array: no join, the row count grows linearly.
        """
        out = df.withColumn("_all", self.ctx.future_array()).withColumn("_f", F.explode("_all")).drop("_all")
        return out.withColumn("Fiscal_Month", F.col("_f.Fiscal_Month")).drop("_f")

    def baseline_avg(self, months: int) -> DataFrame:
        """Mean of the last ``months`` months up to the cutoff (missing month = 0)."""
        p1 = (self.p1.filter(self.ctx.last_months("Fiscal_Month", months)) if self._p1_shared is not None
              else clean.clean_revenue(self.inputs.revenue.filter(self.ctx.last_months("Month", months)), self.opts))
        dated = to_fiscal_month(p1.withColumnRenamed("Fiscal_Month", "_month_date"),
                                self.cal, "_month_date", wide=True)
        cur = self.ctx.month_id
        window = dated.filter((F.col("Month_ID") >= cur - (months - 1)) & (F.col("Month_ID") <= cur))
        avg = (window.groupBy("Account_No", "Product_Category")
               .agg((F.sum(F.col("Partner_Fee") + F.col("Revenue")).cast("double")
                     / F.lit(float(months))).alias("Baseline")))
        return self._over_future_months(avg).select(*KEYS, "Baseline")

    # -- P9 ------------------------------------------------------------------
    def baseline_target(self) -> DataFrame:
        return full_outer_repeating(self.baseline(), self.p8, KEYS, ("Baseline",), ("Target",))

    # -- P10 -----------------------------------------------------------------
    def run_rate_origins(self) -> DataFrame:
        """Future opportunities of the current FY summed by origin month."""
        opps = self.inputs.opportunities.filter(
            self.ctx.after_cutoff_in_year("Opportunity_Est_Date"))
        rows = clean.opportunity_rows(opps, True, self.opts).select(
            "Account_No", "Product_Category", "Opportunity_Est_Date", "Opportunity_Usage")
        dated = to_fiscal_month(rows, self.cal, "Opportunity_Est_Date", keep_date=True, wide=True)
        ctx = self.ctx
        cond = ((F.col("Opportunity_Est_Date") > ctx.cutoff)
                & (F.col("Fiscal_Year") == ctx.fiscal_year))
        if not self.opts.include_current_month:
            cond = cond & (F.col("Fiscal_Month") != ctx.fiscal_month)
        return self.counted("p10_run_rate_origins", dated.filter(cond)
                            .groupBy("Account_No", "Product_Category", "Fiscal_Month", "Month_ID")
                            .agg(F.sum("Opportunity_Usage").alias("Opportunity_Usage")))

    def spread_origins(self, all_months: bool = False) -> DataFrame:
        """Each origin once per remaining month at or after its own month.

        The worksheet's CROSS JOIN + ``Month_ID <=`` filter, as an explode of the
        (at most eleven) future months filtered per row; ``all_months`` skips the
        filter (the plain cross product of the worksheet's intermediate step).
        """
        months = F.col("_all")
        if not all_months:
            months = F.filter(months, lambda m: m["Month_ID"] >= F.col("Month_ID"))
        out = (self.run_rate_origins().withColumn("_all", self.ctx.future_array())
               .withColumn("_f", F.explode(months)))
        return out.select("Account_No", "Product_Category", "Fiscal_Month", "Month_ID",
                          F.col("_f.Fiscal_Month").alias("Future_Fiscal_Months"),
                          F.col("_f.Month_ID").alias("Future_Month_ID"), "Opportunity_Usage")

    def run_rate(self, grain: str | None = None) -> DataFrame:
        """P10: each origin repeated for every remaining month ≥ its own, shifted +1."""
        grain = grain or self.opts.rr_grain
        spread = self.spread_origins()
        shifted = spread.select(
            "Account_No", "Product_Category",
            (F.col("Future_Month_ID") + 1).alias("_est_id"),
            R.clamp_negative("Opportunity_Usage").alias("Opportunities_Into_RR"))
        if self.opts.clip_to_fy:
            shifted = shifted.filter(F.col("_est_id") <= self.ctx.last_future_id)
        months = self.cal.months()
        rr = (shifted.join(months, shifted["_est_id"] == months["Month_ID"], "left")
              .select("Account_No", "Product_Category", "Fiscal_Month", "Opportunities_Into_RR"))
        if grain == "summed":
            rr = (rr.groupBy("Account_No", "Product_Category", "Fiscal_Month")
                  .agg(F.sum("Opportunities_Into_RR").alias("Opportunities_Into_RR")))
        return self.counted("p10_run_rate", rr)

    # -- P11, P12 --------------------------------------------------------------
    def baseline_target_run_rate(self, grain: str | None = None) -> DataFrame:
        """(baseline ⟗ targets) ⟗ run rate; the order of full joins on the same keys doesn't matter,
        so the targets, which may repeat a key, come last."""
        both = full_outer_coalesce(self.baseline(), self.run_rate(grain), KEYS, ("Baseline",), ("Opportunities_Into_RR",))
        out = full_outer_repeating(both, self.p8, KEYS, ("Baseline", "Opportunities_Into_RR"), ("Target",))
        return out.select(*KEYS, "Baseline", "Target", "Opportunities_Into_RR")

    def with_remaining_months(self, df: DataFrame) -> DataFrame:
        """Each row as itself (`_own`), and rows of the cutoff month once more for each remaining
        month of the year, with that as Fiscal_Month."""
        kind = "array<struct<Fiscal_Month:string,Month_ID:int>>"
        own = F.array(F.struct("Fiscal_Month", F.lit(None).cast("int").alias("Month_ID"))).cast(kind)
        later = F.when(F.col("Fiscal_Month") == self.ctx.fiscal_month, self.ctx.future_array().cast(kind))
        rows = (df.withColumn("_all", F.concat(own, F.coalesce(later, F.array().cast(kind))))
                .withColumn("_x", F.explode("_all")))
        # a remaining month has its id
        return rows.withColumns({"Fiscal_Month": F.col("_x.Fiscal_Month"), "_own": F.col("_x.Month_ID").isNull()}).drop("_all", "_x")

    def revenue_with_baseline(self) -> DataFrame:
        """P2 and P7 from one pass over the revenue: each P2 row as itself (``_side`` 0), and rows
        of the cutoff month once more for each remaining month (``_side`` 2) with Baseline.
        Measures of the other side are 0."""
        side = F.when(F.col("_own"), 0).otherwise(2)
        out = self.with_remaining_months(self.p2).select(
            *KEYS, side.alias("_side"),
            *[F.when(F.col("_own"), F.col(m)).otherwise(F.lit(0)).alias(m) for m in REVENUE_MEASURES],
            F.when(~F.col("_own"), F.col("Partner_Fee") + F.col("Revenue")).otherwise(F.lit(0)).alias("Baseline"))
        return self.counted("p2_p7_revenue_and_baseline", out)

    def _facts(self, grain: str) -> list[tuple[DataFrame, dict[int, tuple[str, ...]]]]:
        """The five inputs of P12, by number, from four sources."""
        return [
            (self.revenue_with_baseline(), {0: REVENUE_MEASURES, 2: ("Baseline",)}),
            (self.p3.select(*KEYS, *OPPORTUNITY_MEASURES), {1: OPPORTUNITY_MEASURES}),
            (self.p8.select(*KEYS, "Target"), {3: ("Target",)}),
            (self.run_rate(grain).select(*KEYS, "Opportunities_Into_RR"), {4: ("Opportunities_Into_RR",)}),
        ]

    def facts_with(self, measures: Sequence[str]) -> list[tuple[DataFrame, list[str]]]:
        """The inputs of P12 that hold any of `measures`, each with those; the others aren't read.
        Run rates are by origin month, so they are for adding up."""
        held = lambda names: [m for m in names if m in measures]
        unknown = set(measures) - set(P12_MEASURES)
        if unknown:
            raise ValueError(f"no measures of the marts: {sorted(unknown)}")
        parts: list[tuple[DataFrame, list[str]]] = []
        if "Baseline" in measures:
            parts.append((self.revenue_with_baseline(), [*held(REVENUE_MEASURES), "Baseline"]))
        elif held(REVENUE_MEASURES):
            parts.append((self.p2, held(REVENUE_MEASURES)))
        if held(OPPORTUNITY_MEASURES):
            parts.append((self.p3, held(OPPORTUNITY_MEASURES)))
        if "Target" in measures:
            parts.append((self.p8, ["Target"]))
        if "Opportunities_Into_RR" in measures:
            parts.append((self.run_rate("origin"), ["Opportunities_Into_RR"]))
        return parts

    def facts_by_month(self) -> DataFrame:
        """Actual and Projected of the cutoff's fiscal year by fiscal month: only that year is read
        from the revenue and the opportunities, and nothing is kept by account."""
        ctx = self.ctx
        p1 = (self.p1.filter(ctx.in_year("Fiscal_Month")) if self._p1_shared is not None
              else clean.clean_revenue(self.inputs.revenue.filter(ctx.in_year("Month")), self.opts))
        p2 = clean.revenue_by_fiscal_month(p1, self.cal)
        amount = F.col("Partner_Fee") + F.col("Revenue")
        by_month = p2.groupBy("Fiscal_Month").agg(F.sum(amount).alias("Amount"))
        # one pass: each month as itself, the cutoff month once more for each remaining month
        revenue = self.with_remaining_months(by_month).select(
            "Fiscal_Month", F.when(F.col("_own"), F.col("Amount")).alias("Actual"),
            F.when(~F.col("_own"), F.col("Amount")).alias("Projected"))
        opps = clean.clean_opportunity(self.inputs.opportunities.filter(ctx.in_year("Opportunity_Est_Date")),
                                       self.cal, self.opts)
        rr = self.run_rate("origin")
        return union_combine(
            [(revenue, ("Actual", "Projected")),
             (opps.select("Fiscal_Month", F.col("Opportunity_Usage").alias("Projected")), ("Projected",)),
             (rr.select("Fiscal_Month", F.col("Opportunities_Into_RR").alias("Projected")), ("Projected",))],
            ["Fiscal_Month"])

    def all_transactional(self, grain: str | None = None, combine: str | None = None) -> DataFrame:
        """Every measure by account, fiscal month and category.

        ``combine``:
          * ``"cogroup"`` (default) — the worksheet's nested FULL OUTER JOINs, row for
            row: one shuffle on Account_No for the aggregated inputs, then the
            targets, whose hot keys are split;
          * ``"join"`` — the nested FULL OUTER JOINs themselves (a shuffle per level);
          * ``"union"`` — summed grain: UNION ALL + one grouped SUM.
        """
        return reduce(DataFrame.unionByName, self.all_transactional_parts(grain, combine))

    def all_transactional_parts(self, grain: str | None = None, combine: str | None = None) -> list[DataFrame]:
        """P12 as frames whose rows together are it.

        The union form is one part and the cogroup form two: the facts whose key has no targets, and
        the targets with the facts they met. The union's rows and the facts without targets are
        partitioned by Account_No, so the account and seller lookups of the mart add no shuffle of them.
        """
        grain = grain or self.opts.rr_grain
        combine = combine or self.opts.combine
        if combine == "union":
            if grain != "summed":
                raise ValueError("the union form adds origins up: ask for grain 'summed'")
            parts = [(df, [m for ms in held.values() for m in ms]) for df, held in self._facts("origin")]
            out = union_combine(parts, KEYS, partition_by="Account_No").select(*KEYS, *P12_MEASURES)
            return [self.counted("p12_all_transactional", out)]
        if combine == "cogroup":
            bounded = [(df, held) for df, held in self._facts(grain) if 3 not in held]
            facts = cogroup_full_outer([*bounded, (marks(self.p8, KEYS), {5: ("_marked",)})], KEYS, partition_by="Account_No")
            parts = full_outer_marked(facts, self.p8, KEYS, [m for m in P12_MEASURES if m != "Target"], ("Target",))
            return self.counted_parts("p12_all_transactional", [df.select(*KEYS, *P12_MEASURES) for df in parts])
        return [full_outer_coalesce(self.revenue_opportunity(),
                                    self.baseline_target_run_rate(grain), KEYS,
                                    (*REVENUE_MEASURES, *OPPORTUNITY_MEASURES),
                                    ("Baseline", "Target", "Opportunities_Into_RR"))]
