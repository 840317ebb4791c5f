"""Helpers shared by the operators: word rules, shared-storage tables, row keys."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.session import shared_dir

# Words are separated by the ASCII white space characters only.
SPACES = r"[\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def whole(text: str | Column) -> Column:
    """The text, a null read as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Let a job's shuffle files go as soon as the job has ended."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def freeze(df: DataFrame, name: str = "frame", folder: str = "") -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it back.

    Cuts the lineage: a lost executor does not recompute what was written,
    and every later use sees the same rows. Each call takes a folder of its
    own below ``spark.checkpoint.dir``, within ``folder`` where one is given.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "llm", *filter(None, [folder]), f"{name}-{uuid.uuid4().hex}")
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let_go(spark: SparkSession, folder: str) -> None:
    """Delete what was frozen within ``folder``, once no frame that is still to be computed reads it."""
    path = shared_dir(spark, "llm", folder)
    try:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        conf = spark._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001  (Spark Connect: no access to the file system; the files stay)
        return
    at.getFileSystem(conf).delete(at, True)


def content_key(*cols: str | Column) -> Column:
    """128 bits that stand for the values of ``cols`` (nulls included).

    Rows that are equal in these columns share the key; it serves to match a
    verdict back to its row where ``doc_id`` may be null or repeated.
    """
    c = [F.col(x) if isinstance(x, str) else x for x in cols]
    nulls = [x.isNull() for x in c]
    return F.struct(
        F.xxhash64(F.lit(17), *c, *nulls).alias("a"), F.xxhash64(*nulls, F.lit(40503), *c).alias("b")
    )


def digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of a string's UTF-8 bytes, or of bytes."""
    return F.sha2(text, 256)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
