"""Headline queries at one scale; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from subtlake.plans import QUERIES  # noqa: E402
from subtlake.session import local_session  # noqa: E402

HEADLINE = [
    "q_count_by_month", "q_rollup_date", "q_repeated_blocks", "q_ad_candidates", "q_remove_ads", "q_token_table",
    "q_fts_and", "q_lookup_batch", "q_shard_status", "q_release_semi", "q_id_gaps", "q_id_islands",
    "q_group_by_catalogue_id", "q_chunk_by_count", "q_dedupe_latest", "q_moving_avg", "q_route_to_provider",
    "q_parse_zip_name", "q_verify_members", "q_dump_parse", "q_write_shards", "q_unpack_archives", "q_same_text",
    "q_explode_cues",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "subtlake-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM's compilers and the Python workers outside the measurement
    spark.read.parquet(f"{sf_dir}/documents.parquet").groupBy("lang").count().collect()
    spark.range(8).mapInPandas(lambda frames: frames, "id long").count()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name.removeprefix("q_")] = round(time.perf_counter() - start, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline queries, total wall time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
