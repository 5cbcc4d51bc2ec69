"""Planning inputs from user tables: a catalog database or a folder of CSV files.

The worksheet's six inputs are named tables (loaded from CSV files).  These
loaders apply the explicit schemas, so codes with leading zeros stay text,
dates are dates and money is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from planmart.operators.fiscal import Calendar
from planmart.sources import readers, rejects, schemas
from planmart.sources.adapters import Inputs

# Table names of the worksheet's database.
DEFAULT_NAMES = {
    "revenue": "Revenue_Wk25",
    "opportunities": "Opportunities_Wk25",
    "targets": "Business_Targets",
    "calendar": "Calendar_Lookup",
    "accounts": "Account_Lookup",
    "sellers": "Sellers_Lookup",
}


def _conform(df: DataFrame, kind: str) -> DataFrame:
    """The schema's columns of ``kind`` by name; a missing one is an error."""
    return readers.conform(df, schemas.BY_NAME[kind])


def from_catalog(spark: SparkSession, database: str | None = None,
                 names: dict[str, str] | None = None,
                 prev_opportunities: str | None = None) -> Inputs:
    """Inputs from catalog tables (``USE database`` first when given)."""
    if database:
        readers.use_database(spark, database)
    names = {**DEFAULT_NAMES, **(names or {})}
    t = {k: _conform(spark.table(v), k) for k, v in names.items()}
    prev = _conform(spark.table(prev_opportunities), "opportunities") if prev_opportunities else None
    return Inputs(revenue=t["revenue"], opportunities=t["opportunities"], targets=t["targets"],
                  calendar=Calendar(t["calendar"]), accounts=t["accounts"],
                  sellers=t["sellers"], opportunities_prev=prev)


def from_csv(spark: SparkSession, folder: str, names: dict[str, str] | None = None) -> Inputs:
    """Inputs from ``<folder>/<name>.csv`` files (or folders of part files).

    Files are read as text with headers and conformed to the schemas; the text
    ``NULL`` stays data, as in the source files.
    """
    names = {**DEFAULT_NAMES, **(names or {})}

    def read(kind: str) -> DataFrame:
        raw = (spark.read.option("header", True).option("mode", "FAILFAST")
               .csv(f"{folder.rstrip('/')}/{names[kind]}.csv"))
        return _conform(raw, kind)

    return Inputs(revenue=read("revenue"), opportunities=read("opportunities"),
                  targets=read("targets"), calendar=Calendar(read("calendar")),
                  accounts=read("accounts"), sellers=read("sellers"))


def ingest_csv(spark: SparkSession, folder: str, names: dict[str, str] | None = None,
               max_share: float = 0.01) -> tuple[Inputs, dict[str, rejects.Ingest]]:
    """Inputs from CSV files through the reject channel: a bad line doesn't end the load.

    Returns the inputs and, by input, what came in and what was rejected; an
    input with more than `max_share` rejected lines is an error.
    """
    names = {**DEFAULT_NAMES, **(names or {})}
    read = {kind: rejects.ingest_csv(spark, f"{folder.rstrip('/')}/{name}.csv", schemas.BY_NAME[kind], max_share)
            for kind, name in names.items()}
    rows = {kind: found.rows for kind, found in read.items()}
    return Inputs(**(rows | {"calendar": Calendar(rows["calendar"])})), read


def to_csv(inputs: Inputs, folder: str, names: dict[str, str] | None = None) -> None:
    """Write the six inputs as CSV files in the worksheet's layout (for exchange)."""
    names = {**DEFAULT_NAMES, **(names or {})}
    frames = {"revenue": inputs.revenue, "opportunities": inputs.opportunities,
              "targets": inputs.targets, "calendar": inputs.calendar.df,
              "accounts": inputs.accounts, "sellers": inputs.sellers}
    for kind, df in frames.items():
        readers.write_csv_table(df, f"{folder.rstrip('/')}/{names[kind]}.csv")
