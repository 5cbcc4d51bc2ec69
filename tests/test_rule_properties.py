"""Property tests: the rule Column builders against plain-Python specifications."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from planmart.functions import rules as R

YEAR = [name for name, _ in R.MONTHS_LEFT]
SETTINGS = settings(max_examples=8, deadline=None)
WORDS = ["Service", "Services:", "Support", "Support:", "Product", "Products:", "Product:",
         "Desk", "Bundle", "x", " ", "NULL", *YEAR, ", 2001"]
text = st.one_of(st.none(), st.lists(st.sampled_from(WORDS), max_size=4).map("".join))


def spec_categorise(s, rules):
    if s is None:
        return R.UNMAPPED
    return next((cat for needle, cat in rules if needle in s), R.UNMAPPED)


def spec_months_left(s, incl):
    if s is None:
        return None
    # July has eleven months after it, June none; the first name that the text holds counts
    for after, name in zip(range(11, -1, -1), YEAR, strict=True):
        if name in s:
            return after + (1 if incl else 0)
    return None


def spec_band(v):
    if v is None or v >= 0 and not any(lo <= v <= hi for _, lo, hi in R.VALUE_BANDS):
        return R.BAND_TOP
    if v < 0:
        return R.BAND_BELOW
    return next(label for label, lo, hi in R.VALUE_BANDS if lo <= v <= hi)


@SETTINGS
@given(st.lists(text, min_size=1, max_size=30))
def test_categorise_and_months_left(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    rows = df.select(
        "s",
        R.categorise("s", R.REVENUE_CATEGORY_RULES).alias("rev"),
        R.categorise("s", R.OPPORTUNITY_CATEGORY_RULES).alias("opp"),
        R.months_left("s").alias("m"),
        R.months_left("s", True).alias("mi")).collect()
    for r in rows:
        assert r["rev"] == spec_categorise(r["s"], R.REVENUE_CATEGORY_RULES)
        assert r["opp"] == spec_categorise(r["s"], R.OPPORTUNITY_CATEGORY_RULES)
        assert r["m"] == spec_months_left(r["s"], False)
        assert r["mi"] == spec_months_left(r["s"], True)


money = st.one_of(st.none(), st.decimals(min_value=-300000, max_value=300000, places=2,
                                         allow_nan=False, allow_infinity=False))


@SETTINGS
@given(st.lists(money, min_size=1, max_size=30))
def test_bands_and_clamps(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v decimal(18,2)")
    rows = df.select("v", R.value_band("v").alias("b"), R.clamp_negative("v").alias("c"),
                     R.extrapolate("v", R.months_left(R._col("v").cast("string"))).alias("e")
                     ).collect()
    for r in rows:
        v = r["v"]
        assert r["b"] == spec_band(v)
        assert r["c"] == (None if v is None else (0 if v < 0 else v))


@SETTINGS
@given(st.lists(st.decimals(min_value=-10**12, max_value=10**12, places=7,
                            allow_nan=False, allow_infinity=False), min_size=1, max_size=30))
def test_parse_amount_with_thousands_separators(spark, values):
    texts = [f"{v:,}" for v in values]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["p"] for r in df.select(R.parse_amount("t").alias("p")).collect()]
    want = [Decimal(t.replace(",", "")).quantize(Decimal("0.000001"), ROUND_HALF_UP) for t in texts]
    assert got == want
