"""Lasting, versioned views: each build is an immutable table, and a view says which one counts.

A build is written as an external Parquet table in a folder of its own
(`<base>/<name>/v<number>-<id>`).  Only when its data, its checks and its marker file are
complete does one catalog step (CREATE OR REPLACE VIEW) point the view at it.
Readers therefore see the old rows or the new ones, never a part; DataFrames
opened before keep reading the folder they were opened on; and a build that
fails leaves the view as it was.

The view and the tables are objects of the session's catalog: with a Hive
metastore they last and other applications see them.  The in-process catalog
ends with the application; `attach` makes the objects again from the marker files.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from planmart.sources import files

MARKER = "_mart.json"        # readers of Parquet pass over names with an underscore


@dataclass(frozen=True)
class Version:
    name: str
    number: int
    path: str
    schema: T.StructType
    partition_by: tuple[str, ...]
    properties: dict[str, str]

    @property
    def table(self) -> str:
        """Its table, named after its own folder: builds of any writer never share one."""
        return f"{self.name}__{self.path.rsplit('/', 1)[1].replace('-', '_')}"

    def to_json(self) -> str:
        return json.dumps({"name": self.name, "number": self.number, "schema": json.loads(self.schema.json()),
                           "partition_by": self.partition_by, "properties": self.properties})

    @classmethod
    def of(cls, path: str, text: str) -> Version:
        d = json.loads(text)
        return cls(d["name"], d["number"], path, T.StructType.fromJson(d["schema"]), tuple(d["partition_by"]), d["properties"])


def _quoted(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


class MartStore:
    """The marts of one database, whose builds lie below `base` on shared storage."""

    def __init__(self, spark: SparkSession, base: str, database: str = "planmart_marts"):
        self.spark, self.base, self.database = spark, base.rstrip("/"), database
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)} LOCATION '{self.base}/_database'")

    # -- versions ------------------------------------------------------------------
    def versions(self, name: str) -> list[Version]:
        """Complete builds, oldest first."""
        found = []
        for folder in files.folders(self.spark, f"{self.base}/{name}"):
            path = f"{self.base}/{name}/{folder}"
            if re.fullmatch(r"v\d+-\w+", folder) and files.exists(self.spark, f"{path}/{MARKER}"):
                found.append(Version.of(path, files.read_text(self.spark, f"{path}/{MARKER}")))
        return sorted(found, key=lambda v: v.number)

    def version(self, name: str, number: int | None = None) -> Version:
        """A complete build; the newest without a number."""
        found = [v for v in self.versions(name) if number in (None, v.number)]
        if not found:
            raise LookupError(f"{name} has no build {number or ''}".rstrip())
        return found[-1]

    def current(self, name: str) -> Version | None:
        """The build that the view shows; None before the first."""
        if not self.spark.catalog.tableExists(f"{self.database}.{name}"):
            return None
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {_quoted(self.database, name)}").collect()
        path = dict(map(tuple, rows))["planmart.path"]
        return Version.of(path, files.read_text(self.spark, f"{path}/{MARKER}"))

    # -- publishing ------------------------------------------------------------------
    def stage(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = (),
              check: Callable[[DataFrame], dict[str, str] | None] | None = None, rebalance: bool = True) -> Version:
        """Write a build of `name` that no view shows yet.

        `check` gets the written rows; if it raises, the build is dropped.  What it returns is
        kept as properties of the build.  A partitioned build has few files per value, hot values
        split, for which all its rows are shuffled once more; without `rebalance` each task that
        made rows writes a file per value, and nothing is shuffled.
        """
        taken = [int(f[1:].split("-")[0]) for f in files.folders(self.spark, f"{self.base}/{name}") if re.fullmatch(r"v\d+-\w+", f)]
        number = max(taken, default=0) + 1
        path = f"{self.base}/{name}/v{number:06d}-{uuid.uuid4().hex[:12]}"
        by = tuple(partition_by)
        made = Version(name, number, path, df.schema, by, {})
        rows = df.hint("rebalance", *by) if by and rebalance else df
        try:
            rows.write.format("parquet").mode("errorifexists").option("path", path).partitionBy(*by).saveAsTable(
                f"{self.database}.{made.table}")
            kept = check(self._rows(made)) if check else None
            made = Version(name, number, path, df.schema, by, dict(kept or {}))
            files.write_text(self.spark, f"{path}/{MARKER}", made.to_json())
        except BaseException:
            self.spark.sql(f"DROP TABLE IF EXISTS {_quoted(self.database, made.table)}")
            files.delete(self.spark, path)
            raise
        return made

    def show(self, version: Version) -> DataFrame:
        """Point the view at a build: one step in the catalog."""
        self._register(version)
        columns = ", ".join(_quoted(f.name) for f in version.schema.fields)
        self.spark.sql(f"CREATE OR REPLACE VIEW {_quoted(self.database, version.name)} "
                       f"TBLPROPERTIES ('planmart.path' = '{version.path}') "
                       f"AS SELECT {columns} FROM {_quoted(self.database, version.table)}")
        return self.read(version.name)

    def publish(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = (),
                check: Callable[[DataFrame], dict[str, str] | None] | None = None, rebalance: bool = True) -> DataFrame:
        return self.show(self.stage(df, name, partition_by, check, rebalance))

    # -- reading ------------------------------------------------------------------
    def read(self, name: str, number: int | None = None) -> DataFrame:
        """The rows that the view shows now, or those of a build."""
        if number is None:
            return self.spark.table(f"{self.database}.{name}")
        version = self.version(name, number)
        self._register(version)
        return self._rows(version)

    def attach(self, name: str) -> DataFrame:
        """Make the view and table of the newest complete build in this session's catalog."""
        return self.show(self.version(name))

    # -- upkeep ------------------------------------------------------------------
    def vacuum(self, name: str, keep: int = 2) -> list[int]:
        """Drop builds but the newest `keep` and the one shown, and folders that a lost writer
        left without a marker below the newest number; returns the numbers of dropped builds."""
        shown, found = self.current(name), self.versions(name)
        stay = {v.number for v in found[-keep:]} | ({shown.number} if shown else set())
        gone = [v for v in found if v.number not in stay]
        for v in gone:
            self.spark.sql(f"DROP TABLE IF EXISTS {_quoted(self.database, v.table)}")
            files.delete(self.spark, v.path)
        complete = {v.path for v in found}
        for folder in files.folders(self.spark, f"{self.base}/{name}"):
            path = f"{self.base}/{name}/{folder}"
            if found and re.fullmatch(r"v\d+-\w+", folder) and path not in complete and int(folder[1:].split("-")[0]) < found[-1].number:
                files.delete(self.spark, path)
        return [v.number for v in gone]

    def _rows(self, version: Version) -> DataFrame:
        return self.spark.table(f"{self.database}.{version.table}").select(*[f"`{f.name}`" for f in version.schema.fields])

    def _register(self, version: Version) -> None:
        if not self.spark.catalog.tableExists(f"{self.database}.{version.table}"):
            # the schema in the file's own column order: partition columns last
            last = [f for f in version.schema.fields if f.name in version.partition_by]
            columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}"
                                for f in [*[f for f in version.schema.fields if f not in last], *last])
            by = f"PARTITIONED BY ({', '.join(map(_quoted, version.partition_by))})" if version.partition_by else ""
            table = _quoted(self.database, version.table)
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {by} LOCATION '{version.path}'")
            if version.partition_by:
                self.spark.sql(f"MSCK REPAIR TABLE {table}")
