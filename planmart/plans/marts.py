"""Published marts: revenue summary (P13) and opportunity summary."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planmart.functions import rules as R
from planmart.operators.fiscal import Calendar, to_fiscal_month
from planmart.operators.joins import left_lookup, unique_by
from planmart.plans import clean
from planmart.plans.planning import P12_MEASURES, Plan
from planmart.plans.clean import KEYS
from planmart.plans.keys import spellings

MONTH_ATTRS = ("Fiscal_Quarter", "Fiscal_Year", "Month_ID")
ACCOUNT_ATTRS = ("Account_Name", "Industry", "Vertical", "Segment",
                 "Store_Manager_Alias", "Potential_Account", "Vertical_Manager_Alias")
SELLER_ATTRS = ("General_Seller", "Services_Seller", "Product_Seller", "Support_Seller")
OPPORTUNITY_DETAIL = ("Account_No", "Product_Category", "Fiscal_Month", "Product",
                      "Opportunity_ID", "Opportunity_Name", "Project_Status",
                      "Opportunity_Status", "Opportunity_Stage")


def with_lookups(df: DataFrame, cal: Calendar, accounts: DataFrame, sellers: DataFrame,
                 unique: bool = False) -> DataFrame:
    """Month, account and seller attributes (LEFT JOINs).

    Accounts and sellers are joined to each other first (dimension by
    dimension, one row per key), so the facts meet one lookup on Account_No: a
    single join whose hot accounts adaptive execution can split.  With ``unique``
    a key that a lookup holds twice fails the job that reads the result.
    """
    once = unique_by if unique else lambda dim, key, name: dim
    months = once(cal.month_dim(), "Fiscal_Month", "calendar")
    out = left_lookup(df, months, "Fiscal_Month", "Fiscal_Month", MONTH_ATTRS, True)
    acc = once(accounts.select("AccountNo", F.col("Store").alias("Account_Name"), *ACCOUNT_ATTRS[1:]), "AccountNo", "accounts")
    sell = once(sellers.select("Store_ID", *SELLER_ATTRS), "Store_ID", "sellers")
    both = acc.join(sell, F.col("AccountNo") == F.col("Store_ID"), "full")
    both = both.withColumn("_account", F.coalesce("AccountNo", "Store_ID"))
    # Callers project the final columns, which drops the helper key columns.
    return left_lookup(out, both, "Account_No", "_account", (*ACCOUNT_ATTRS, *SELLER_ATTRS), True)


def spelled(df: DataFrame, plan: Plan) -> DataFrame:
    """`df` with account numbers as the account lookup spells them, where keys were normalised."""
    if not plan.opts.key_collation:
        return df
    names = spellings(plan.raw.accounts, plan.opts.key_collation)
    out = left_lookup(df, names, "Account_No", "Normal_No", ["Spelled_No"], True)
    return out.withColumn("Account_No", F.coalesce("Spelled_No", "Account_No"))


def account_lookup(df: DataFrame, plan: Plan, columns: Sequence[str]) -> DataFrame:
    """`columns` of the account and seller lookups by Account_No; only the lookups that hold one are read."""
    i, out = plan.inputs, df
    of_account, of_seller = ([c for c in columns if c in names] for names in (ACCOUNT_ATTRS, SELLER_ATTRS))
    if of_account:
        out = left_lookup(out, i.accounts.withColumnRenamed("Store", "Account_Name"), "Account_No", "AccountNo", of_account)
    if of_seller:
        out = left_lookup(out, i.sellers, "Account_No", "Store_ID", of_seller)
    return out


def revenue_summary(plan: Plan, grain: str | None = None, combine: str | None = None) -> DataFrame:
    """All transactional facts + calendar, account and seller lookups (25 columns)."""
    i = plan.inputs
    # Part by part: one that is partitioned by Account_No meets the account lookups where it is.
    full = [with_lookups(facts, plan.cal, i.accounts, i.sellers, plan.opts.unique_lookups)
            for facts in plan.all_transactional_parts(grain, combine)]
    columns = (*KEYS, *P12_MEASURES, *MONTH_ATTRS, *ACCOUNT_ATTRS, *SELLER_ATTRS)
    return reduce(DataFrame.unionByName, [spelled(df, plan).select(*columns) for df in full])


def opportunity_detail(plan: Plan, drop_inactive: bool | None = None) -> DataFrame:
    """Usage by the nine opportunity attributes, extrapolated over the whole FY."""
    opts = plan.opts
    if drop_inactive is None:
        drop_inactive = opts.drop_inactive_in_summary
    rows = clean.opportunity_rows(plan.inputs.opportunities, drop_inactive, opts)
    dated = to_fiscal_month(rows, plan.cal, "Opportunity_Est_Date")
    summed = (dated.groupBy(*OPPORTUNITY_DETAIL)
              .agg(F.sum("Opportunity_Usage").alias("Opportunity_Usage")))
    return plan.counted("p14_opportunity_detail", clean.with_extrapolation(summed, include_current=True, opts=opts))


def opportunity_summary(plan: Plan, compat_aliases: bool | None = None,
                        drop_inactive: bool | None = None) -> DataFrame:
    """Opportunity detail, two value bands and the lookups (28 columns).

    ``compat_aliases`` reproduces the worksheet's two missing commas: the
    column named Account_Name then holds Month_ID and General_Seller holds
    Vertical_Manager_Alias (26 columns).
    """
    if compat_aliases is None:
        compat_aliases = plan.opts.compat_aliases
    detail = opportunity_detail(plan, drop_inactive)
    banded = detail.withColumns({
        "Opportunity_Usage_Range": R.value_band("Opportunity_Usage", plan.opts.null_band),
        "Opportunity_Extrapolation_Range": R.value_band("Opportunity_Extrapolation",
                                                        plan.opts.null_band),
    })
    i = plan.inputs
    full = spelled(with_lookups(banded, plan.cal, i.accounts, i.sellers, plan.opts.unique_lookups), plan)
    head = (*OPPORTUNITY_DETAIL, "Opportunity_Usage", "Extrap_Month_Left_For_FY",
            "Opportunity_Extrapolation", "Opportunity_Usage_Range",
            "Opportunity_Extrapolation_Range")
    if not compat_aliases:
        return full.select(*head, *MONTH_ATTRS, *ACCOUNT_ATTRS, *SELLER_ATTRS)
    return full.select(
        *head, "Fiscal_Quarter", "Fiscal_Year",
        F.col("Month_ID").alias("Account_Name"),
        "Industry", "Vertical", "Segment", "Store_Manager_Alias", "Potential_Account",
        F.col("Vertical_Manager_Alias").alias("General_Seller"),
        "Services_Seller", "Product_Seller", "Support_Seller")
