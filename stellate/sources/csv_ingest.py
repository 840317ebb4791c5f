"""CSV -> Parquet ingestion of a raw extract.

The raw review extract has free-text columns whose quotes, line breaks and
accents break naive loaders, so the load used to drop them. Spark's CSV reader
handles them when told about multi-line quoted fields; dropping the free text
stays an option (``drop``) because the mart does not use it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(
    spark: SparkSession,
    src: str,
    schema: StructType | str,
    header: bool = True,
    encoding: str = "UTF-8",
    multi_line: bool = True,
    corrupt: str | None = None,
) -> DataFrame:
    """Read a CSV extract with an explicit schema (no inference pass).

    ``multi_line`` lets a quoted field span lines; a file is then read by one
    task, so large extracts should come as many files. Without it files are
    split, for extracts whose fields hold no line breaks. ``escape='"'`` reads
    the doubled quote ``""`` as one quote character (RFC 4180). Malformed rows
    are kept with NULLs (PERMISSIVE); ``corrupt`` names a column that then
    holds the row's text, NULL for sound rows.
    """
    if corrupt:
        schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        schema = StructType([*schema.fields, StructField(corrupt, StringType())])
    reader = spark.read.schema(schema)
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return (
        reader
        .option("header", header)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
        .csv(src)
    )


def ingest_csv(
    spark: SparkSession,
    src: str,
    dst: str,
    schema: StructType | str,
    drop: list[str] | tuple[str, ...] = (),
    header: bool = True,
    encoding: str = "UTF-8",
    multi_line: bool = True,
    corrupt: str | None = None,
) -> DataFrame:
    """Convert a CSV extract to Parquet at ``dst`` (overwrite) and return the scan of it."""
    df = read_csv(spark, src, schema, header, encoding, multi_line, corrupt)
    if drop:
        df = df.drop(*drop)
    df.write.mode("overwrite").parquet(dst)
    return spark.read.parquet(dst)
