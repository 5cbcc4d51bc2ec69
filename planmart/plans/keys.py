"""Planning keys under a collation: one normal form for joins and groupings, one spelling to publish.

Keys that are equal under a collation get the same text before the first
grouping, so every join and GROUP BY stays binary (hashes, no collation keys),
and marts show the account lookup's spelling again.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planmart.functions import rules as R
from planmart.sources.adapters import Inputs

#: Collations that a normal form stands for: what it does to a text.
COLLATIONS = {"UTF8_LCASE": (True, False), "UTF8_LCASE_RTRIM": (True, True), "UTF8_BINARY_RTRIM": (False, True)}


def normal(c: str | Column, collation: str) -> Column:
    """The text that all spellings of a key share under `collation`."""
    if collation not in COLLATIONS:
        raise ValueError(f"keys have a normal form under {', '.join(COLLATIONS)}; not {collation}")
    lower, trim = COLLATIONS[collation]
    out = F.col(c) if isinstance(c, str) else c
    out = F.rtrim(out) if trim else out
    return F.lower(out) if lower else out


def _category(c: str, collation: str) -> Column:
    """A target's category as the mapping rules spell it; any other one in its normal form."""
    known = [*dict.fromkeys(name for _, name in R.REVENUE_CATEGORY_RULES), R.UNMAPPED]
    out = normal(c, collation)
    for name in known:
        out = F.when(normal(c, collation) == normal(F.lit(name), collation), F.lit(name)).otherwise(out)
    return out


def with_normal_keys(inputs: Inputs, collation: str) -> Inputs:
    """`inputs` with account numbers in normal form and target categories as the rules spell them."""
    def put(df: DataFrame, key: str) -> DataFrame:
        return df.withColumn(key, normal(key, collation))

    return replace(
        inputs, revenue=put(inputs.revenue, "StoreNo"), opportunities=put(inputs.opportunities, "Store_No"),
        targets=put(inputs.targets, "Store_Number").withColumn("Product_Category", _category("Product_Category", collation)),
        accounts=put(inputs.accounts, "AccountNo"), sellers=put(inputs.sellers, "Store_ID"))


def spellings(accounts: DataFrame, collation: str) -> DataFrame:
    """Normal_No and Spelled_No: the smallest spelling of each account number in the lookup.
    Numbers that the lookup lacks are published in normal form."""
    return (accounts.where("AccountNo IS NOT NULL").groupBy(normal("AccountNo", collation).alias("Normal_No"))
            .agg(F.min("AccountNo").alias("Spelled_No")))
