"""Tables that are published whole: readers follow a manifest, and a cycle that breaks off leaves the old one in force.

Every publication writes the parts it replaces (a month, say) to a new folder and
then adds one small manifest file that names the folder of every part of every
table. A reader takes the highest manifest and reads only the folders it names,
so it never sees half a publication, and an older version can still be read.
Plain Spark reads and writes, on any store that Spark knows.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "version bigint, table string, part string, folder string, columns string"


def read_if_there(spark: SparkSession, path: str, schema: str | T.StructType, fmt: str = "parquet") -> DataFrame:
    """The files of a folder, or an empty table where the folder is not there yet; any other fault is raised."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def among(column: Column, values) -> Column:
    """Whether the column is one of the values, null being a value like others."""
    known = [v for v in values if v is not None]
    some = column.isin(known) if known else F.lit(False)
    return some if len(known) == len(values) else column.isNull() | some


class Snapshots:
    """Tables under one path; ``parts`` names the string column that each is published by."""

    def __init__(self, spark: SparkSession, path: str, parts: dict[str, str]):
        self.spark, self.path, self.parts = spark, path, parts

    def _manifest(self, version: int | None = None) -> list:
        """The rows of a version, one per part (as many as there are months)."""
        rows = read_if_there(self.spark, f"{self.path}/manifest", MANIFEST, "json")
        if version is None:
            version = self.version()
        return rows.where(F.col("version") == version).collect()

    def version(self) -> int:
        """The number of the last publication, 0 before the first."""
        rows = read_if_there(self.spark, f"{self.path}/manifest", MANIFEST, "json")
        return rows.agg(F.max("version")).first()[0] or 0

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """A table as a version has it; filters on its part column prune folders."""
        rows = [r for r in self._manifest(version) if r["table"] == table]
        if not rows:
            raise LookupError(f"{table} has not been published")
        schema = T.StructType.fromJson(json.loads(rows[-1]["columns"]))
        folders: dict[str, list[str | None]] = {}
        for r in rows:
            if r["folder"]:
                folders.setdefault(r["folder"], []).append(r["part"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        base = f"{self.path}/{table}"
        reader = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("in_folder", T.StringType())]))
        found = reader.option("basePath", base).parquet(*[f"{base}/in_folder={f}" for f in folders])
        by = F.col(self.parts[table])
        wanted = [(F.col("in_folder") == f) & among(by, parts) for f, parts in folders.items()]
        return found.where(reduce(lambda a, b: a | b, wanted)).select(*schema.names)

    def publish(self, changes: dict[str, tuple[DataFrame, list[str | None]]]) -> int:
        """Replace parts of tables, all or none: table -> (rows, the parts they replace). Gives the new version.

        Rows of other parts than the named ones are refused by leaving them out
        of the manifest; a named part without rows is empty from then on.
        Two publications at once must be kept apart by the caller: the one that
        writes its manifest second builds on a version that is not the last.
        """
        before = self._manifest()
        last = max((r["version"] for r in before), default=0)
        rows = []
        for table, (df, replaced) in changes.items():
            folder, by = uuid.uuid4().hex, self.parts[table]
            ordered = [c for c in df.columns if c != by] + [by]
            df = df.select(*ordered)
            # few files for small parts, several tasks for a large one
            df.hint("rebalance", F.col(by)).write.partitionBy(by).parquet(f"{self.path}/{table}/in_folder={folder}")
            columns = df.schema.json()
            kept = [(r["part"], r["folder"]) for r in before if r["table"] == table and r["folder"] and r["part"] not in set(replaced)]
            # a table without parts has one row without a folder
            named = kept + [(p, folder) for p in replaced] or [(None, "")]
            rows += [(last + 1, table, p, f, columns) for p, f in named]
        rows += [(last + 1, r["table"], r["part"], r["folder"], r["columns"]) for r in before if r["table"] not in changes]
        # one file, so that it is there whole or not at all
        manifest = self.spark.createDataFrame(rows, MANIFEST).coalesce(1)
        manifest.write.mode("append").option("ignoreNullFields", "false").json(f"{self.path}/manifest")
        return last + 1
