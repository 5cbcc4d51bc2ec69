"""CSV lines that can't be typed rows: split off, counted, an error when too many."""

import os

import pytest

from planmart.session import shared_dir
from planmart.sources import adapters, readers, rejects, schemas, tables

HEADER = "Revenue,StoreNo,Month,Revenue Type,Revenue_Motion,Product_Category,Motion,Extra"
GOOD = ['12.30,00000001,2001-01-01,Actuals,O,"Services, all",u,x', ",00000002,2001-02-01,,O,NULL,u,", '1e2,3,2001-03-01,"",O,c,u,x']
BAD = {"abc,1,2001-01-01,Actuals,O,c,u,x": [("Revenue", "not a decimal(18,2)")],
       "1.005,1,2001-01-01,Actuals,O,c,u,x": [("Revenue", "more than 2 decimals")],
       "1e40,1,yesterday,Actuals,O,c,u,x": [("Revenue", "too large for decimal(18,2)"), ("Month", "not a date")],
       "1.00,1,2001-01-01": [(None, "not 8 values")],
       "1.00,1,2001-01-01,Actuals,O,c,u,x,more": [(None, "not 8 values")]}


def folder(spark, lines, sep="\r\n"):
    path = shared_dir(spark, "t_rejects")
    for i in range(2):
        with open(os.path.join(path, f"{i}.csv"), "w", newline="") as f:
            f.write(sep.join([HEADER, *lines[i::2], "", ""]))
    return path


def test_rows_and_rejects(spark):
    found = rejects.ingest_csv(spark, folder(spark, [*GOOD, *BAD]), schemas.REVENUE, 1.0)
    assert (found.n_rows, found.n_rejected) == (len(GOOD), len(BAD))
    assert found.rows.schema.simpleString() == schemas.REVENUE.simpleString()
    rows = {r["StoreNo"]: r for r in found.rows.collect()}
    assert set(rows) == {"00000001", "00000002", "3"}
    assert rows["00000001"]["Product_Category"] == "Services, all" and str(rows["00000001"]["Month"]) == "2001-01-01"
    assert rows["00000002"]["Revenue"] is None and rows["00000002"]["Product_Category"] == "NULL"
    assert str(rows["3"]["Revenue"]) == "100.00"
    got = {}
    for r in found.rejects.collect():
        assert r["file"].endswith(".csv")
        got.setdefault(r["line"], []).append((r["column"], r["reason"]))
    assert {k: sorted(v, key=str) for k, v in got.items()} == {k: sorted(v, key=str) for k, v in BAD.items()}


def test_too_many_rejects_is_an_error_that_holds_them(spark):
    path = folder(spark, [*GOOD, *BAD])
    with pytest.raises(rejects.TooManyRejects, match="5 of 8 lines") as error:
        rejects.ingest_csv(spark, path, schemas.REVENUE, 0.5)
    assert error.value.rejects.select("line").distinct().count() == len(BAD)
    assert rejects.ingest_csv(spark, folder(spark, GOOD), schemas.REVENUE, 0.0).rejects.count() == 0


def test_headers(spark):
    with pytest.raises(ValueError, match="Store_ID"):
        rejects.ingest_csv(spark, folder(spark, GOOD), schemas.SELLERS)
    empty = shared_dir(spark, "t_rejects")
    open(os.path.join(empty, "a.csv"), "w").close()
    with pytest.raises(ValueError, match="no header"):
        rejects.ingest_csv(spark, empty, schemas.SELLERS)


def test_inputs_through_the_reject_channel(spark, small_dir):
    inputs = adapters.load(spark, small_dir)
    path = shared_dir(spark, "t_inputs")
    tables.to_csv(inputs, path)
    readers.write_csv_table(adapters.revenue_dirty(spark, small_dir), f"{path}/Revenue_Wk25.csv")
    with pytest.raises(rejects.TooManyRejects):
        tables.ingest_csv(spark, path, max_share=0.001)
    loaded, found = tables.ingest_csv(spark, path, max_share=0.2)
    assert found["revenue"].n_rejected > 0 and all(found[k].n_rejected == 0 for k in found if k != "revenue")
    assert loaded.revenue.count() == inputs.revenue.count() - found["revenue"].n_rejected
    for kind in ("opportunities", "targets", "accounts", "sellers"):
        a, b = getattr(loaded, kind), getattr(inputs, kind)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("text", ["n/a", "1e60", "1.23456789"])
def test_on_bad_fail_fails_on_all_that_the_audit_lists(spark, text):
    from pyspark.sql import functions as F

    from planmart.options import PlanOptions
    from planmart.plans import clean
    rows = spark.createDataFrame([("a", "Product: x", text), ("b", "Product: x", "1,234.560000")],
                                 "Store_No string, Product string, Opportunity_Usage string")
    df = rows.select("*", *[F.lit(None).cast("string").alias(c) for c in (
        "Opportunity_ID", "Opportunity_Name", "Project_Status", "Opportunity_Status", "Opportunity_Stage")],
        F.current_date().alias("Opportunity_Est_Date"))
    strict = PlanOptions(on_bad="fail")
    with pytest.raises(Exception, match="Opportunity_Usage: "):
        clean.opportunity_rows(df, False, strict).collect()
    assert clean.opportunity_rows(df.where("Store_No = 'b'"), False, strict).count() == 1
