"""A translated table that is only published if the translation did not multiply its rows.

A left join to a lookup table keeps every row once as long as no key of the lookup
repeats. Checking the lookup first costs a job and can be stale by the time of the
join; here the join's own job counts: rows going in, rows coming out and rows left
untranslated are observed while the table is written. Only if as many rows came
out as went in does the version enter the commit log, so readers never see a
table with multiplied rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stellate.operators.quality import duplicate_keys
from stellate.plans import mart
from stellate.plans.publish import read_back, write_table
from stellate.sources import commits


class RepeatedKey(ValueError):
    """A lookup table has a key more than once."""


def publish_translation(
    products: DataFrame, translation: DataFrame, root: str, table: str = "product_translation",
    key: str = "product_category_name",
) -> tuple[DataFrame, dict[str, int]]:
    """Write the translated products below ``root``, commit them, and return them with the observed counts.

    Raises ``RepeatedKey``, naming some keys, where rows were multiplied; nothing
    is committed then. A re-run stage may count rows again, so a difference is
    only believed if a key does repeat.
    """
    spark = products.sparkSession
    before, after = Observation(), Observation()
    translated = mart.product_translation(products.observe(before, F.count(F.lit(1)).alias("rows_in")), translation)
    observed = translated.observe(
        after,
        F.count(F.lit(1)).alias("rows_out"),
        F.count_if(F.col("product_category_name_english").isNull()).alias("untranslated"),
    )
    version = "v" + uuid.uuid4().hex
    path = write_table(observed, commits.table_path(root, table, version))
    counts = before.get | after.get
    if counts["rows_in"] != counts["rows_out"]:
        again = duplicate_keys(translation.where(F.col(key).isNotNull()), key).orderBy(key).limit(5).collect()
        if again:
            raise RepeatedKey(f"{key} repeats in the translation: {', '.join(str(r[key]) for r in again)}")
    stored = read_back(spark, path)
    commits.commit(spark, root, version, {table: stored})
    return stored, counts
