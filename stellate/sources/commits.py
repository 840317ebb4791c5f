"""A commit log for published tables: one entry switches them all.

The tables of a mart lie under ``root/<table>/_v=<version>``, one folder a run.
``root/commits`` is a Parquet table that names, for each committed run, its
sequence number, its version and the columns of each of its tables. An entry is
one file, so it is there whole or not at all.

Views do not name a version. They read ``root/<table>`` where ``_v`` is the
version of the log's last entry: ``_v`` is a partition column and the version a
scalar subquery, so a query lists and reads the files of that version alone. The
commit is therefore the only switch. A run that ends before it leaves every view
on the old version, and one that ends after it leaves none behind.

One run commits at a time. Should two take the same number, the one whose version
sorts last wins, for all tables.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "commits"
ENTRY = "seq bigint, version string, table string, columns string"


@dataclass(frozen=True)
class Commit:
    seq: int
    version: str
    columns: dict[str, str]


def folder_name(version: str) -> str:
    """The version as it names a folder: never something that reads as a number or a date."""
    return f"v{version}" if re.match(r"[\d.+-]|(nan|inf)", version, re.IGNORECASE) else version


def table_path(root: str, table: str, version: str) -> str:
    return f"{root.rstrip('/')}/{table}/_v={version}"


def entries(spark: SparkSession, root: str) -> DataFrame:
    """The log; without rows where nothing was committed yet."""
    try:
        return spark.read.schema(ENTRY).parquet(f"{root.rstrip('/')}/{LOG}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ENTRY)


def last(spark: SparkSession, root: str) -> Commit | None:
    """The entry that views read through."""
    log = entries(spark, root)
    newest = log.agg(F.max(F.struct("seq", "version")).alias("at")).select("at.*")
    rows = log.join(F.broadcast(newest), ["seq", "version"]).collect()  # one row for each table of one entry
    return Commit(rows[0]["seq"], rows[0]["version"], {r["table"]: r["columns"] for r in rows}) if rows else None


def commit(spark: SparkSession, root: str, version: str, tables: Mapping[str, DataFrame]) -> Commit:
    """Make ``version`` the one that is read, for all ``tables`` at once.

    Their columns must be those of the last entry: views name them, and a scan
    over several versions has one schema.
    """
    columns = {t: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) for t, df in tables.items()}
    before = last(spark, root)
    changed = [t for t in columns if before and before.columns.get(t, columns[t]) != columns[t]]
    if changed:
        raise ValueError(f"columns of {', '.join(sorted(changed))} changed: publish under a folder of its own")
    seq = before.seq + 1 if before else 1
    rows = [(seq, version, t, c) for t, c in columns.items()]
    spark.createDataFrame(rows, ENTRY).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/{LOG}")
    return Commit(seq, version, columns)


def create_switched_view(
    spark: SparkSession, view: str, root: str, table: str, columns: list[str], fmt: str = "parquet", temp: bool = True
) -> None:
    """A view over ``table`` as of the log's last entry, whatever that is when it is read."""
    root = root.rstrip("/")
    kind = "TEMP VIEW" if temp else "VIEW"
    names = ", ".join(f"`{c}`" for c in columns)
    spark.sql(
        f"CREATE OR REPLACE {kind} {view} AS SELECT {names} FROM {fmt}.`{root}/{table}` WHERE _v ="
        f" (SELECT max_by(version, struct(seq, version)) FROM parquet.`{root}/{LOG}`)"
    )


def snapshot(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """All tables of the last entry, pinned: later commits do not change what these frames read."""
    at = last(spark, root)
    if at is None:
        raise ValueError(f"nothing was committed under {root}")
    return {t: spark.read.format(fmt).load(table_path(root, t, at.version)) for t in at.columns}
