"""Explicit schemas of the six planning inputs (no type inference)."""

from pyspark.sql import types as T

_S = T.StringType()
_D = T.DateType()
_M = T.DecimalType(18, 2)

REVENUE = T.StructType([
    T.StructField("StoreNo", _S), T.StructField("Month", _D),
    T.StructField("Revenue_Type", _S), T.StructField("Revenue_Motion", _S),
    T.StructField("Product_Category", _S), T.StructField("Motion", _S),
    T.StructField("Revenue", _M),
])

OPPORTUNITIES = T.StructType([
    T.StructField("Store_No", _S), T.StructField("Opportunity_Est_Date", _D),
    T.StructField("Product", _S), T.StructField("Opportunity_ID", _S),
    T.StructField("Opportunity_Name", _S), T.StructField("Project_Status", _S),
    T.StructField("Opportunity_Status", _S), T.StructField("Opportunity_Stage", _S),
    T.StructField("Opportunity_Usage", _S),
])

TARGETS = T.StructType([
    T.StructField("Store_Number", _S), T.StructField("Product_Category", _S),
    T.StructField("Fiscal_Month", _D), T.StructField("Target", _M),
])

CALENDAR = T.StructType([
    T.StructField("Date_Value", _D), T.StructField("Fiscal_Month", _S),
    T.StructField("Fiscal_Quarter", _S), T.StructField("Fiscal_Year", _S),
    T.StructField("Month_ID", T.IntegerType()),
])

ACCOUNTS = T.StructType([
    T.StructField(n, _S) for n in (
        "AccountNo", "Store", "Industry", "Vertical", "Segment",
        "Store_Manager_Alias", "Potential_Account", "Vertical_Manager_Alias")
])

# Column order of the seller lookup file; headers carry spaces there.
SELLERS_FILE_COLUMNS = ("Store ID", "Company", "General Seller", "Services Seller",
                        "Support Seller", "Product Seller")
SELLERS = T.StructType([T.StructField(n.replace(" ", "_"), _S) for n in SELLERS_FILE_COLUMNS])

BY_NAME = {
    "revenue": REVENUE, "opportunities": OPPORTUNITIES, "targets": TARGETS,
    "calendar": CALENDAR, "accounts": ACCOUNTS, "sellers": SELLERS,
}
