"""Sources and sinks: typed CSV/Parquet ingest, catalog scans, publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from planmart.session import shared_dir
from planmart.sources import schemas


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header row; columns are taken by name and cast to the schema's types.

    Headers such as ``Store ID`` stand for ``Store_ID``, in any order; no type
    is inferred, so codes with leading zeros stay text.  The text ``NULL`` is
    left as data (it is not a marker in these files).
    """
    raw = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    return conform(raw, schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns of ``df`` by name (case-insensitive, blanks as underscores), cast to its types.

    A column that ``df`` lacks is an error, never a column of NULLs.
    """
    df = normalise_headers(df)
    by_lower = {c.lower(): c for c in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in by_lower]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")
    return df.select(*[F.col(f"`{by_lower[f.name.lower()]}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def normalise_headers(df: DataFrame) -> DataFrame:
    """Header names with spaces → underscores (``Store ID`` → ``Store_ID``)."""
    return df.withColumnsRenamed({c: c.replace(" ", "_") for c in df.columns if " " in c})


def write_csv_table(df: DataFrame, path: str, header_names=None) -> str:
    """Write a lookup as CSV files with the given header names (CRLF lines)."""
    out = df.toDF(*header_names) if header_names else df
    (out.write.mode("overwrite").option("header", True)
        .option("lineSep", "\r\n").csv(path))
    return path


def read_sellers_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_table(spark, path, schemas.SELLERS)


def use_database(spark: SparkSession, name: str) -> None:
    """``USE [db]``: set the current catalog database."""
    spark.catalog.setCurrentDatabase(name)


def scan(spark: SparkSession, name: str) -> DataFrame:
    """Full scan of a table or view of the used database (``SELECT * FROM t``).

    A name without a database is looked up in the one that ``USE`` set, also where a temporary
    view of the session has the same name.
    """
    return spark.table(name if "." in name else f"`{spark.catalog.currentDatabase()}`.`{name}`")


def preview(df: DataFrame, n: int = 10, order_by=None) -> DataFrame:
    """``TOP n``; ordering first makes it deterministic (top-k, no full sort)."""
    if order_by is not None:
        cols = [order_by] if isinstance(order_by, str) else list(order_by)
        df = df.orderBy(*cols)
    return df.limit(n)


def save_table(df: DataFrame, database: str, name: str) -> None:
    """Store ``df`` as the table ``name`` of ``database`` (made if it isn't there), in a folder on shared storage."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{shared_dir(spark, database)}'")
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
    df.write.format("parquet").option("path", shared_dir(spark, database, name) + "/rows").saveAsTable(f"`{database}`.`{name}`")


def money_as_double(df: DataFrame) -> DataFrame:
    """Exact decimals are kept through the plan and published as double."""
    casts = {f.name: F.col(f.name).cast("double") for f in df.schema.fields
             if isinstance(f.dataType, T.DecimalType)}
    return df.withColumns(casts) if casts else df
