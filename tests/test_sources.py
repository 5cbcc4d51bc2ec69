"""Typed CSV ingest, publishing and scans."""

import os

import pytest

from pyspark.sql import functions as F

from planmart.session import shared_dir
from planmart.sources import readers, schemas


def test_seller_csv_with_spaced_headers_and_leading_zeros(spark):
    folder = shared_dir(spark, "t_csv")
    lines = ["Store ID,Company,General Seller,Services Seller,Support Seller,Product Seller",
             "00012345,Alpha; Beta Co,g1,s1,u1,pNULL",
             "12345678,Gamma,g2,s2,u2,p2",
             "01000000,NULL,g3,s3,u3,p3"]
    with open(os.path.join(folder, "sellers.csv"), "w", newline="") as fh:
        fh.write("\r\n".join(lines) + "\r\n")
    df = readers.read_sellers_csv(spark, folder)
    assert df.columns == ["Store_ID", "Company", "General_Seller", "Services_Seller",
                          "Support_Seller", "Product_Seller"]
    rows = {r["Store_ID"]: r for r in df.collect()}
    assert set(rows) == {"00012345", "12345678", "01000000"}
    assert rows["00012345"]["Product_Seller"] == "pNULL"      # not a null marker
    assert rows["01000000"]["Company"] == "NULL"              # text kept as data
    assert rows["12345678"]["Product_Seller"] == "p2"         # no trailing CR


def test_csv_roundtrip_and_header_normalisation(spark):
    folder = shared_dir(spark, "t_csv_rt")
    src = spark.createDataFrame([("00000001", "A", "g", "s", "u", "p")], schemas.SELLERS)
    readers.write_csv_table(src, folder, schemas.SELLERS_FILE_COLUMNS)
    raw = spark.read.option("header", True).csv(folder)
    assert readers.normalise_headers(raw).columns == [c.name for c in schemas.SELLERS.fields]
    assert readers.read_sellers_csv(spark, folder).collect() == src.collect()


def test_preview_is_ordered_top_k(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"))
    out = readers.preview(df, 3, "k")
    assert [r["k"] for r in out.collect()] == ["0", "1", "10"]
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()


def test_plan_from_csv_tables_matches_adapters(spark, small_dir):
    from planmart.plans import marts
    from planmart.plans.planning import Plan
    from planmart.sources import adapters, tables
    inp = adapters.load(spark, small_dir)
    folder = shared_dir(spark, "t_tables")
    tables.to_csv(inp, folder)
    loaded = tables.from_csv(spark, folder)
    assert loaded.sellers.filter(F.col("Store_ID").startswith("0")).count() > 0
    a = marts.revenue_summary(Plan(loaded))
    b = marts.revenue_summary(Plan(inp)).select(*a.columns)
    assert a.count() == 6812
    assert a.exceptAll(b).count() == 0


def test_plan_from_catalog(spark, small_dir):
    from planmart.plans.planning import Plan
    from planmart.sources import adapters, tables
    inp = adapters.load(spark, small_dir)
    frames = {"Revenue_Wk25": inp.revenue, "Opportunities_Wk25": inp.opportunities,
              "Business_Targets": inp.targets, "Calendar_Lookup": inp.calendar.df,
              "Account_Lookup": inp.accounts, "Sellers_Lookup": inp.sellers}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    plan = Plan(tables.from_catalog(spark))
    assert plan.all_transactional().count() == 6812


def test_catalog_columns_conformed_by_name_and_type(spark):
    from planmart.sources import tables
    raw = spark.createDataFrame(
        [("00001234", "2001-01-01", "Actuals", "O", "Services", "1-URGENT", "12.50")],
        "storeno string, month string, revenue_type string, revenue_motion string, "
        "product_category string, motion string, revenue string")
    got = tables._conform(raw, "revenue")
    assert [f.name for f in got.schema.fields] == [
        "StoreNo", "Month", "Revenue_Type", "Revenue_Motion", "Product_Category", "Motion", "Revenue"]
    row = got.first()
    assert row["StoreNo"] == "00001234" and str(row["Month"]) == "2001-01-01"
    assert str(row["Revenue"]) == "12.50"


def test_missing_columns_are_an_error(spark):
    from planmart.sources import tables
    raw = spark.createDataFrame([("1", "Services", "2001-01-01", "5")],
                                "Store_Number string, Service_Comp_Group string, Fiscal_Month string, Target string")
    with pytest.raises(ValueError, match="Product_Category"):
        tables._conform(raw, "targets")


def test_csv_columns_are_taken_by_name(spark):
    folder = shared_dir(spark, "t_csv_order")
    with open(os.path.join(folder, "sellers.csv"), "w") as fh:
        fh.write("Product Seller,Store ID,Company,General Seller,Services Seller,Support Seller\np,00000001,c,g,s,u\n")
    row = readers.read_sellers_csv(spark, folder).first()
    assert (row["Store_ID"], row["Product_Seller"], row["Support_Seller"]) == ("00000001", "p", "u")


def test_used_database_decides_what_is_read(spark, small_dir):
    """The scanned name has no database in it: another used database gives other rows."""
    from planmart import catalog
    before = spark.catalog.currentDatabase()
    spark.range(3).createOrReplaceTempView("Account_Lookup")          # a name that the session uses otherwise
    top = catalog.REGISTRY["scan_preview"](spark, small_dir)
    assert spark.catalog.currentDatabase() == before
    assert any(r["AccountNo"].endswith("0") for r in top.collect())
    for database, some in (("planmart_wk24", False), ("planmart_wk25", True)):
        readers.use_database(spark, database)
        try:
            rows = readers.scan(spark, "Account_Lookup")
        finally:
            readers.use_database(spark, before)
        assert bool(rows.where("AccountNo LIKE '%0'").count()) is some
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        readers.scan(spark, "Account_Lookup")
    spark.catalog.dropTempView("Account_Lookup")
