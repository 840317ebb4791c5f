"""The headline queries as plain Spark SQL, without this library: an independent baseline.

Statements are those of the oracle where Spark SQL can run them as they are,
else the plainest form of the same result. Same sink, session and timing as
``bench.py``; prints one JSON line {query: [plain seconds, library seconds]}.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
NAMES = (
    "fact_order_payments", "order_customer", "review_order_customer", "duplicate_rows_join", "duplicate_rows_semi",
    "duplicate_customer_match", "dim_payments", "duplicate_review_customers",
)
PLAIN = {
    "duplicate_rows_join": (
        "WITH again AS (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)"
        " SELECT lineitem.* FROM lineitem JOIN again USING (l_orderkey) ORDER BY l_orderkey"
    ),
    "duplicate_review_customers": (
        "WITH again AS (SELECT l_partkey FROM lineitem GROUP BY l_partkey HAVING count(*) > 1)"
        " SELECT l_partkey, l_orderkey, c_custkey, c_name FROM lineitem JOIN again USING (l_partkey)"
        " JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey"
        " ORDER BY l_partkey, l_orderkey, c_custkey, c_name"
    ),
}


def main() -> None:
    from stellate.plans.catalog import ORACLE, QUERIES
    from stellate.session import get_session

    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="stellate-plain-")
    conf = {"spark.driver.memory": "8g", "spark.sql.warehouse.dir": f"{scratch}/warehouse", "spark.local.dir": f"{scratch}/local"}
    spark = get_session(f"local[{cpus}]", app_name="stellate-plain", shuffle_partitions=cpus * 2, extra=conf)
    for t in TABLES:
        spark.read.parquet(f"{root}/{t}.parquet").createOrReplaceTempView(t)

    def best(make) -> float:
        runs = []
        for _ in range(2):
            t0 = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        return round(min(runs), 2)

    spark.sql("SELECT count(*) FROM lineitem").collect()
    out = {n: [best(lambda n=n: spark.sql(PLAIN.get(n, ORACLE[n]))), best(lambda n=n: QUERIES[n](spark, root))] for n in NAMES}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
