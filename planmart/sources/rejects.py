"""CSV ingest with a reject channel: one pass gives typed rows and the lines that can't be.

Lines are read as they are and taken apart by `from_csv` into text; each value is
cast by `try_cast`.  A line is rejected, with its file, text, column and reason,
where it has too few or too many values, a value isn't of its column's type, or
an amount has more decimals than its column keeps.  Both parts are written by
the same job, so the files are read once.  Quoted values may hold commas, not line ends.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from planmart.session import shared_dir

_CORRUPT = "_corrupt"


class TooManyRejects(Exception):
    """More of the lines were rejected than allowed; `rejects` holds them."""

    def __init__(self, message: str, rejects: DataFrame):
        super().__init__(message)
        self.rejects = rejects


@dataclass(frozen=True)
class Ingest:
    rows: DataFrame         # the schema's columns
    rejects: DataFrame      # file, line, column, reason: a row for each value at fault
    n_rows: int
    n_rejected: int         # lines


def _name(text: str) -> str:
    return text.strip().replace(" ", "_").lower()


def _header(lines: DataFrame, schema: T.StructType) -> tuple[str, list[str]]:
    """The header line and its names; every column of the schema must be among them."""
    first = lines.where(F.trim("value") != "").select("value").first()
    if first is None:
        raise ValueError("the files have no header line")
    names = [_name(n) for n in lines.sparkSession.createDataFrame([(first["value"],)], "v string").select(
        F.split(F.regexp_replace("v", "\"|﻿", ""), ",").alias("n")).first()["n"]]
    missing = [f.name for f in schema.fields if _name(f.name) not in names]
    if missing:
        raise ValueError(f"missing columns {missing}; the header has {names}")
    return first["value"], names


def _fault(text: Column, kind: T.DataType) -> Column:
    """Why a value can't be of a type; NULL if it can."""
    wrong = F.when(text.isNotNull() & text.try_cast(kind).isNull(), F.lit(f"not a {kind.simpleString()}"))
    if isinstance(kind, T.DecimalType):
        # a double tells a number that is too large or too fine from a text that is none
        return (F.when(text.try_cast("double").isNotNull() & text.try_cast(kind).isNull(), F.lit(f"too large for {kind.simpleString()}"))
                .when(text.rlike(rf"\.[0-9]{{{kind.scale}}}[0-9]*[1-9]"), F.lit(f"more than {kind.scale} decimals"))
                .otherwise(wrong))
    return wrong


def ingest_csv(spark: SparkSession, path: str, schema: T.StructType, max_share: float = 0.01,
               out_dir: str | None = None) -> Ingest:
    """Typed rows and rejects of the CSV files at `path`, by the names of their header.

    All files have the same header line.  Blank lines and columns that the schema
    lacks are passed over.  If more than `max_share` of the lines are rejected,
    TooManyRejects is raised; both parts stay in `out_dir` (a new shared folder by default).
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    header, names = _header(lines, schema)
    text_schema = ", ".join([*[f"c{i} string" for i in range(len(names))], f"{_CORRUPT} string"])
    body = lines.where((F.trim("value") != "") & (F.col("value") != header))
    parsed = body.select("file", "value", F.from_csv("value", text_schema, {
        "columnNameOfCorruptRecord": _CORRUPT, "mode": "PERMISSIVE"}).alias("t"))
    of = {f.name: F.col(f"t.c{names.index(_name(f.name))}") for f in schema.fields}
    # a value beyond the header's columns has no column of its own: the line's shape is at fault
    shape = F.when(F.col(f"t.{_CORRUPT}").isNotNull(), F.struct(F.lit(None).cast("string").alias("column"),
                                                                F.lit(f"not {len(names)} values").alias("reason")))
    values = [F.when(F.col(f"t.{_CORRUPT}").isNull() & _fault(of[f.name], f.dataType).isNotNull(),
                     F.struct(F.lit(f.name).alias("column"), _fault(of[f.name], f.dataType).alias("reason")))
              for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    checked = parsed.withColumn("faults", F.array_compact(F.array(shape, *values)))
    bad = F.size("faults") > 0
    made = checked.select(
        bad.alias("_bad"), F.when(bad, F.col("file")).alias("_file"), F.when(bad, F.col("value")).alias("_line"),
        F.when(bad, F.col("faults")).alias("_faults"),
        *[F.when(~bad, of[f.name].try_cast(f.dataType)).alias(f.name) for f in schema.fields])
    out = out_dir or shared_dir(spark, "ingest") + "/split"
    count = Observation()
    (made.observe(count, F.count(F.lit(1)).alias("lines"), F.coalesce(F.sum(F.col("_bad").cast("long")), F.lit(0)).alias("bad"))
     .write.partitionBy("_bad").parquet(out))
    lines_, n_bad = count.get["lines"], count.get["bad"]
    both = spark.read.schema(made.schema).parquet(out)
    rejects = (both.where("_bad").select("_file", "_line", F.explode("_faults").alias("f"))
               .select(F.col("_file").alias("file"), F.col("_line").alias("line"), "f.column", "f.reason"))
    rows = both.where("NOT _bad").select(*[f.name for f in schema.fields])
    if n_bad > max_share * lines_:
        raise TooManyRejects(f"{n_bad} of {lines_} lines of {path} were rejected; they are in {out}", rejects)
    return Ingest(rows, rejects, lines_ - n_bad, n_bad)
