"""Column builders for the business rules of the planning marts.

Every builder returns a ``Column`` made of built-in expressions only, so the
rules stay inside whole-stage codegen and never leave the JVM.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the worksheet's literals) ---------------------
ACTUALS = "Actuals"
PARTNER_FEE = "Partner Fee"
REGISTRATION_FEE = "Registration Fee"
UNMAPPED = "Need Mapping"
INACTIVE = "Inactive"
NULL_TEXT = "NULL"

# (substring, category) pairs, first match wins.
REVENUE_CATEGORY_RULES = (
    ("Service", "Services"),
    ("Support", "Support"),
    ("Product", "Products"),
)
OPPORTUNITY_CATEGORY_RULES_V1 = (
    ("Services:", "Services"),
    ("Support:", "Support"),
    ("Products:", "Products"),
)
OPPORTUNITY_CATEGORY_RULES = (
    ("Services:", "Services"),
    ("Support:", "Support"),
    ("Products:", "Products"),
    ("Product:", "Products"),
)

# (month name, months left after it in a July-June fiscal year), first match wins.
MONTHS_LEFT = (
    ("July", 11), ("August", 10), ("September", 9), ("October", 8), ("November", 7), ("December", 6),
    ("January", 5), ("February", 4), ("March", 3), ("April", 2), ("May", 1), ("June", 0),
)
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)

BAND_BELOW = "Below $0"
# (label, low, high): inclusive bounds, checked in this order.
VALUE_BANDS = (
    ("$0 to $10,000", 0, 10000),
    ("$10000 to $50,000", 10000, 50000),
    ("$50000 to $100,000", 50000, 100000),
    ("$100,000 to $200,000", 100000, 200000),
)
BAND_TOP = "$200,000 +"
# --- end of fixed values ----------------------------------------------------

MONEY = "decimal(18,2)"
# Amounts that come as text: every digit that a real amount has is kept.
AMOUNT = "decimal(38,6)"
MORE_DECIMALS = r"\.[0-9]{6}[0-9]*[1-9]"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_contains(c: str | Column, needle: str, collation: str | None = None) -> Column:
    """``c LIKE '%needle%'``; binary by default, or under a Spark collation."""
    c = _col(c)
    if collation:
        c = F.collate(c, collation)
    return c.contains(needle)


def lookup(c: str | Column, mapping: Mapping[str, str] | Sequence[tuple], default=None) -> Column:
    """Exact-match mapping as a CASE chain; unmatched values get ``default``."""
    c = _col(c)
    items = mapping.items() if isinstance(mapping, Mapping) else mapping
    out = None
    for key, value in items:
        out = (F.when(c == key, F.lit(value)) if out is None
               else out.when(c == key, F.lit(value)))
    return out.otherwise(F.lit(default)) if default is not None else out


def categorise(c: str | Column, rules=REVENUE_CATEGORY_RULES, collation: str | None = None,
               default: str = UNMAPPED) -> Column:
    """Ordered substring rules → category; NULL input falls through to ``default``."""
    out = None
    for needle, category in rules:
        cond = text_contains(c, needle, collation)
        out = F.when(cond, F.lit(category)) if out is None else out.when(cond, F.lit(category))
    return out.otherwise(F.lit(default))


def collated(c: str | Column, collation: str | None = None) -> Column:
    """``c``, compared under a Spark collation if one is given."""
    return F.collate(_col(c), collation) if collation else _col(c)


def measure_split(type_col: str | Column, value_col: str | Column, wanted: str,
                  collation: str | None = None) -> Column:
    """``IIF(type = wanted, value, 0)``: an unknown/NULL type yields 0."""
    value = _col(value_col)
    return F.when(collated(type_col, collation) == wanted, value).otherwise(F.lit(0).cast(MONEY))


def parse_amount(c: str | Column, scale_type: str = AMOUNT) -> Column:
    """Text with thousands commas → exact decimal; unparsable text → NULL."""
    return F.replace(_col(c), F.lit(","), F.lit("")).try_cast(scale_type)


def amount_issue(c: str | Column) -> Column:
    """What `parse_amount` loses of a text: unparsable, overflow or rounded; NULL if nothing."""
    text = F.replace(_col(c), F.lit(","), F.lit(""))
    return (F.when(_col(c).isNull(), F.lit(None).cast("string"))
             .when(text.try_cast("double").isNull(), F.lit("unparsable"))
             .when(parse_amount(c).isNull(), F.lit("overflow"))
             .when(text.rlike(MORE_DECIMALS), F.lit("rounded")))


def is_present(c: str | Column, collation: str | None = None) -> Column:
    """Neither SQL NULL nor the text sentinel ``'NULL'``."""
    c = _col(c)
    return c.isNotNull() & (collated(c, collation) != NULL_TEXT)


def months_left(fiscal_month: str | Column, include_current: bool = False,
                collation: str | None = None) -> Column:
    """Months left in a July–June fiscal year, looked up by month name.

    July → 11 … June → 0, or July → 12 … June → 1 when ``include_current``;
    NULL when no month name is found.
    """
    out = None
    for name, after in MONTHS_LEFT:
        left = after + (1 if include_current else 0)
        cond = text_contains(fiscal_month, name, collation)
        out = F.when(cond, F.lit(left)) if out is None else out.when(cond, F.lit(left))
    return out


def extrapolate(usage: str | Column, months: str | Column) -> Column:
    """``IIF(usage < 0, 0, months * usage)``; NULL usage or months stay NULL."""
    usage = _col(usage)
    return F.when(usage < 0, F.lit(0)).otherwise(_col(months) * usage)


def clamp_negative(c: str | Column) -> Column:
    """``IIF(c < 0, 0, c)``; NULL stays NULL (unlike ``greatest``)."""
    c = _col(c)
    return F.when(c < 0, F.lit(0)).otherwise(c)


def value_band(c: str | Column, null_label: str | None = None) -> Column:
    """Six value bands, first match wins; NULL lands in the top band
    (the worksheet's ELSE), or in ``null_label`` when one is given."""
    c = _col(c)
    out = F.when(c < 0, F.lit(BAND_BELOW))
    if null_label is not None:
        out = F.when(c.isNull(), F.lit(null_label)).when(c < 0, F.lit(BAND_BELOW))
    for label, low, high in VALUE_BANDS:
        out = out.when(c.between(low, high), F.lit(label))
    return out.otherwise(F.lit(BAND_TOP))


def scale_money(c: str | Column, factor: str) -> Column:
    """Exact decimal scaling (never through binary floating point)."""
    return (_col(c) * F.lit(Decimal(factor))).cast(MONEY)
