"""Builds whose tables readers see all at once, or not at all.

A build writes its tables to a folder of its own, ``builds/<id>/<table>``, which nobody reads yet. When all
are stored, one line is added to ``manifest``: that line is the pointer. Readers take the last line and
the tables it names, so a build that ends half-way, or two at the same time, never mix their tables, and what an open
reader has planned stays where it is. Everything goes through Spark, so the folder can be in any store.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siftmark.sources.scratch import folder_exists, remove_folder
from siftmark.sources.writers import save_as_table, write_table

MANIFEST_SCHEMA = "number bigint, build string, tables array<struct<name: string, schema: string>>"


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row a published build, none before the first."""
    if not folder_exists(spark, f"{folder}/manifest"):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).json(f"{folder}/manifest")


def last_build(spark: SparkSession, folder: str) -> Row | None:
    return manifest(spark, folder).orderBy(F.desc("number"), F.desc("build")).first()


class TableBuild:
    """The tables of one build; ``publish`` makes them the current ones.

    With ``database`` each table is also a catalog table named ``<table>__<build>``.
    """

    def __init__(self, spark: SparkSession, folder: str, database: str | None = None):
        self.spark, self.folder, self.database = spark, folder, database
        self.build = uuid.uuid4().hex
        self.schemas: dict[str, StructType] = {}

    def store(self, name: str, df: DataFrame, sort_by: Sequence[str] = ()) -> DataFrame:
        """Write a table of this build and return it as stored."""
        if not re.fullmatch(r"\w+", name):
            raise ValueError(f"{name!r} is no table name")
        path = table_path(self.folder, self.build, name)
        if self.database:
            save_as_table(df, catalog_name(self.database, self.build, name), path, sort_by)
        else:
            write_table(df, path, sort_by)
        self.schemas[name] = df.schema
        return self.spark.read.schema(df.schema).parquet(path)

    def publish(self) -> None:
        """Add this build to the manifest, after all of its tables are stored."""
        last = last_build(self.spark, self.folder)
        tables = [Row(name=n, schema=s.json()) for n, s in self.schemas.items()]
        line = [Row(number=last.number + 1 if last else 1, build=self.build, tables=tables)]
        self.spark.createDataFrame(line, MANIFEST_SCHEMA).coalesce(1).write.mode("append").json(f"{self.folder}/manifest")


def table_path(folder: str, build: str, name: str) -> str:
    return f"{folder}/builds/{build}/{name}"


def catalog_name(database: str, build: str, name: str) -> str:
    return f"`{database}`.`{name}__{build}`"


def current_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All tables of the build that was published last."""
    last = last_build(spark, folder)
    if last is None:
        raise LookupError(f"no build was published in {folder}")
    return {
        t.name: spark.read.schema(StructType.fromJson(json.loads(t.schema))).parquet(table_path(folder, last.build, t.name))
        for t in last.tables
    }


def point_views(spark: SparkSession, folder: str, database: str) -> list[str]:
    """Let ``<database>.<table>`` be views of the last published build's catalog tables; returns their names.

    Views are replaced one by one; a reader that needs several tables of one build takes ``current_tables``.
    """
    last = last_build(spark, folder)
    if last is None:
        raise LookupError(f"no build was published in {folder}")
    for t in last.tables:
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{t.name}` AS SELECT * FROM {catalog_name(database, last.build, t.name)}")
    return [t.name for t in last.tables]


def prune_builds(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Remove the tables of all published builds but the last ``keep``; builds that are not published stay."""
    if keep < 1:
        raise ValueError("the current build must stay")
    older = manifest(spark, folder).orderBy(F.desc("number"), F.desc("build")).offset(keep).collect()
    gone = [r.build for r in older if folder_exists(spark, f"{folder}/builds/{r.build}")]
    for build in gone:
        remove_folder(spark, f"{folder}/builds/{build}")
    return gone
