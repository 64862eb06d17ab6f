"""Time the design choices against their alternatives on one derived raw feed.

usage: python tools/variants.py [SF_DIR]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.feeds import feed
from wattframe.functions.measures import percent
from wattframe.operators.shares import group_share, join_totals_sliced, row_share
from wattframe.plans.cleaning import CLEANING
from wattframe.plans.tables import state_fuel_mix, state_fuel_shares, state_shares
from wattframe.session import keep, local_session, scratch_path
from wattframe.sources.files import read_csv, write_csv


def seconds(build, repeats: int = 3) -> float:
    """Best of some full executions."""
    best = float("inf")
    for _ in range(repeats):
        start = time.perf_counter()
        for frame in build():
            frame.write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - start)
    return round(best, 2)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    folder = scratch_path(spark, "raw-seds")
    write_csv(feed(spark, sf_dir, "seds").repartition(8), folder)
    raw = read_csv(spark, folder)
    marts = (state_fuel_shares, state_shares, state_fuel_mix)

    clean = CLEANING["seds"](raw)
    sorted_clean = clean.orderBy("year", "state_id", "series_code")
    print("three tables, sort only at the sink  ", seconds(lambda: [m(clean) for m in marts]))
    print("three tables, sort in the clean step ", seconds(lambda: [m(sorted_clean) for m in marts]))

    def from_stored():
        stored = keep(CLEANING["seds"](raw))
        return [mart(stored) for mart in marts]

    print("three tables, cleaned rows stored    ", seconds(from_stored))

    stored = keep(clean)
    groups = stored.groupBy("year", "state_id", "fuel_prefix").agg(F.sum("value").alias("v"))
    totals = F.sum("v").over(Window.partitionBy("year", "fuel_prefix"))
    windowed = groups.withColumn("t", totals).withColumn("p", percent("v", "t", 4))
    shared = group_share(groups, "v", ["year", "fuel_prefix"], total="t", share="p")
    print("group share, aggregate and join      ", seconds(lambda: [shared]))
    print("group share, window sum              ", seconds(lambda: [windowed]))

    keys = ["year", "fuel_prefix"]
    totals = stored.groupBy(*keys).agg(F.sum("value").alias("t"))
    row_window = stored.withColumn("t", F.sum("value").over(Window.partitionBy(*keys)))
    print("row share, measured broadcast        ", seconds(lambda: [row_share(stored, "value", keys, total="t", share="p")]))
    print("row share, sliced join               ", seconds(lambda: [join_totals_sliced(stored, totals, keys)]))
    print("row share, window sum                ", seconds(lambda: [row_window]))


if __name__ == "__main__":
    main()
