"""``python tests/check_queries.py [sf_dir] [name ...]``: run queries against their oracles, with times."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession

from sensorloom import plans
from tests import oracle


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    connection = oracle.connect(sf_dir)
    oracles = plans.oracles()
    for name, query in plans.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            result = query(spark, sf_dir)
            if name in oracles:
                outcome = f"ok, {oracle.check(result, connection, oracles[name])} rows"
            else:
                outcome = f"no oracle, {len(result.collect())} rows"
        except Exception as error:  # report all queries
            outcome = f"FAILED {type(error).__name__}: {str(error)[:700]}"
        print(f"{name}: {outcome} ({time.time() - start:.1f} s)", flush=True)


if __name__ == "__main__":
    main()
