"""Run every query at one scale and compare it with its SQL: ``python tests/check_all.py DIR [name ...]``."""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parent.parent)]

from oracle import compare, connect  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

sf_dir = sys.argv[1]
spark = (
    SparkSession.builder.master("local[8]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.driver.memory", "8g")
    .config("spark.ui.showConsoleProgress", "false")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
con = connect(sf_dir)
oracles = entry.oracle_sql()
failed = 0
for name, run in entry.queries().items():
    if sys.argv[2:] and name not in sys.argv[2:]:
        continue
    start = time.time()
    try:
        df = run(spark, sf_dir)
        found = compare(df, con, oracles[name]) if name in oracles else f"no SQL, {df.count()} rows"
    except Exception as error:  # noqa: BLE001
        found = f"{type(error).__name__}: {str(error)[:600]}"
    failed += found is not None and not found.startswith("no SQL")
    print(f"{time.time() - start:6.2f}s {name}: {found or 'ok'}", flush=True)
print("failed", failed)
