"""Time deduplication when one key holds a third of all rows, by both ways.

Usage: python tools/skew.py [copies of the events table] [sf_dir]
"""

import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from streamfuse.operators.dedup import dedup_ttl, find_hot_keys  # noqa: E402
from streamfuse.plans import samples  # noqa: E402


def main(copies: int, sf_dir: str) -> None:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "64")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="streamfuse-"))
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    n = F.col("event_id") * copies + F.col("copy")
    rows = (
        samples.read_events(spark, sf_dir)
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        .select("event_id", samples.event_ms().alias("ts"), "copy")
        .select(
            n.alias("seq"),
            (F.col("ts") + F.col("copy") * 37).alias("received_ms"),
            F.when(n % 3 == 0, -1).otherwise(F.call_function("div", n, F.lit(4))).alias("key"),
        )
    )
    began = time.time()
    hot = find_hot_keys(rows, "key", 1_000_000)
    took = time.time() - began
    print(f"{rows.count()} rows, {len(hot)} hot key(s) found in {took:.1f}s", flush=True)
    for name, keys in (("hot keys by blocks", hot), ("one task per key", [])):
        began = time.time()
        judged = dedup_ttl(rows, "key", "received_ms", 60_000, ["seq"], hot_keys=keys)
        counted = judged.groupBy("is_duplicate").count().collect()
        print(name, sorted(tuple(r) for r in counted), f"{time.time() - began:.1f}s", flush=True)


if __name__ == "__main__":
    arguments = dict(zip(("copies", "sf_dir"), sys.argv[1:], strict=False))
    main(int(arguments.get("copies", 300)), arguments.get("sf_dir", "/root/testdata/sf0.1"))
