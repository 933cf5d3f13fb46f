"""Time the queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all), BENCH_QUERIES (comma
separated keys, or "all"), BENCH_ROWS (default 10,000,000: the table of the maintenance jobs).
Every query is run twice and the better time is kept; its rows are produced but not shown.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import functions as F

from tallymark.operators.maintenance import delete_where
from tallymark.plans import QUERIES
from tallymark.session import local_session, scratch_path
from tallymark.sources.files import read_table, write_table
from tallymark.sources.generate import series

HEADLINE = (
    "r02_store_revenue_since", "r03_top5_with_ties", "r05_top3_staff_revenue",
    "r06_top5_rentals_rating_age", "r08_gap_between_events", "r09_top5_customers_per_channel",
    "r10_quarter_crosstab", "r11_top300_in_all_years", "r12_month_category_region",
    "r13_pct_vs_previous_period", "r14_weekly_cumsum_centered_avg", "r15_frame_modes_by_category",
    "r16_frame_modes_by_date", "r18_most_popular_by_group", "r19_last_rental_by_title",
    "r20_customer_balance_asof", "r23_latest_quarter_analytics", "r24_most_active_customer",
    "r27_sales_per_employee_flag", "c01_inner_equi", "d02_count_distinct", "d12_describe",
    "d16_string_agg", "e01_rank", "e04_partition_total", "e05_running_rows",
    "j02_on_conflict_do_nothing", "j12_add_transaction", "k01_primary_key", "k06_check_range_order",
    "l01_build_inverted_index", "l02_query_all_words", "l03_query_batch", "l04_word_count_topk",
    "n01_clamped_score",
)


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def maintenance_jobs(spark, rows: int) -> dict[str, float]:
    """The reference's published figures are for these jobs at 10^7 rows."""
    full, kept, none, empty = (scratch_path(spark, f"bench-{n}") for n in ("full", "kept", "none", "empty"))
    prefix = "veeeeeeery_long_string"
    texts = series(spark, 1, rows).select(F.concat(F.lit(prefix), F.col("x").cast("string")).alias("col"))
    number = F.replace("col", F.lit(prefix), F.lit("")).cast("bigint")
    return {
        "ctas_generated_strings": seconds(lambda: write_table(texts, full)),
        "delete_one_third": seconds(
            lambda: write_table(delete_where(read_table(spark, full), number % 3 == 0), kept)),
        "delete_all_rows": seconds(
            lambda: write_table(delete_where(read_table(spark, full), number > 0), none)),
        "truncate": seconds(lambda: write_table(read_table(spark, full).limit(0), empty)),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    wanted = os.environ.get("BENCH_QUERIES", "")
    keys = list(QUERIES) if wanted == "all" else [k for k in wanted.split(",") if k] or list(HEADLINE)
    spark = local_session(cpus, partitions=int(cpus))
    spark.read.parquet(f"{sf_dir}/region.parquet").count()  # start-up is not part of any figure

    def run(key: str) -> None:
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {key: min(seconds(lambda: run(key)) for _ in range(2)) for key in keys}
    times.update(maintenance_jobs(spark, int(os.environ.get("BENCH_ROWS", 10_000_000))))
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
