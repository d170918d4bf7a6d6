"""Tables of the session catalog."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from tableferry.sources.files import NO_FILTER, matching


# Properties of a table whose columns were dropped: what each column is called in the files, where that isn't its
# name, and the names in files that no column has any more.
FILE_NAMES, RETIRED = "tableferry.file_names", "tableferry.retired"


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def file_names(spark: SparkSession, table: str) -> dict[str, str]:
    """What columns are called in a table's files, where it isn't their name.

    A column that was dropped and added again is another column: old files hold the old one under its name, so the new
    one gets a name of its own there.
    """
    return json.loads(table_properties(spark, table).get(FILE_NAMES, "{}"))


def named(rows: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rows as the files name their columns, under the columns' names."""
    return rows.withColumnsRenamed({f: n for n, f in names.items()}) if names else rows


def read_table(spark: SparkSession, table: str, columns: Sequence[str] = ("*",),
               where: str | Column = NO_FILTER) -> DataFrame:
    """Rows of a table under its columns' names, also where files call them otherwise."""
    return matching(named(spark.table(table), file_names(spark, table)), where).select(*columns)


def is_external(spark: SparkSession, table: str) -> bool:
    return spark.catalog.getTable(table).tableType == "EXTERNAL"


def list_tables(spark: SparkSession, database: str, external: bool = True) -> list[str]:
    """Qualified names of a database's tables, without the external ones where asked."""
    kinds = ("MANAGED", "EXTERNAL") if external else ("MANAGED",)
    return [f"{database}.{t.name}" for t in spark.catalog.listTables(database)
            if t.tableType in kinds and not t.isTemporary]


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
