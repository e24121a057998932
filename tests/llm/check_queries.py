"""``python tests/llm/check_queries.py [sf_dir] [name ...]``: run the operators' queries against their SQL, with times."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession

from sensorloom.llm import queries
from tests import oracle


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle.connect(sf_dir)
    for name, query in queries.QUERIES.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        result = query(spark, sf_dir)
        if name in queries.ORACLES:
            outcome = f"ok, {oracle.check(result, connection, queries.ORACLES[name])} rows"
        else:
            rows = result.collect()
            outcome = f"no oracle, {len(rows)} rows, {rows[:3]}"
        print(f"{name}: {outcome} ({time.time() - start:.1f} s)", flush=True)


if __name__ == "__main__":
    main()
