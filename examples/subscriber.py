"""One subscription from the merged feed to readable events and minute statistics.

Usage: python examples/subscriber.py [sf_dir]
"""

import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from streamfuse.functions import payload, text  # noqa: E402
from streamfuse.functions.render import preview, render_binary  # noqa: E402
from streamfuse.operators import counts  # noqa: E402
from streamfuse.plans import samples  # noqa: E402
from streamfuse.plans.feed import Feed  # noqa: E402

REQUEST = {
    "transactions": {
        "clicks": {"accountInclude": ["tclick"], "vote": False, "failed": False},
    },
    "commitment": "confirmed",
}


def main(sf_dir: str) -> None:
    spark = SparkSession.builder.master("local[*]").getOrCreate()
    feed = Feed(samples.ENDPOINTS, request=REQUEST)
    events = samples.read_events(spark, sf_dir)
    sources = [
        samples.endpoint_deliveries(events, i) for i in range(1, len(samples.ENDPOINTS) + 1)
    ]
    judged = feed.judge(feed.select(feed.merge(sources)))

    first = counts.first_messages(judged.filter(~F.col("is_duplicate")), samples.ORDER, 5)
    shown = feed.transactions(first, ["signature", "slot", "fee", "meta_json"])
    meta = F.parse_json("data.meta_json")
    shown.select(
        text.iso_time(F.col("timestamp")).alias("received"),
        text.short_signature(F.col("signature"), 12).alias("signature"),
        text.endpoint_label(F.col("source")).alias("source"),
        payload.tx_status(meta).alias("status"),
        payload.slot_text(F.col("data.slot")).alias("slot"),
    ).show(truncate=False)
    for row in preview(render_binary(shown), 10).select("preview", "more_lines").take(1):
        print("\n".join(row.preview), f"\n... and {row.more_lines} more lines")

    counts.dedup_counts(judged, window_ms=60_000).orderBy("window_start_ms").show(5)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001")
