"""Time the term report (Q4) on a larger URL corpus derived from the tables.

Usage: python tools/scale_check.py [copies] [sf_dir]

The link URLs of ``pages`` are repeated ``copies`` times with distinct
query strings ``?c=<n>`` (every URL stays distinct and the per-URL work
scales; "c" and numbers are filtered words, so the term mix is unchanged),
written once as Parquet into a fresh folder under the checkpoint folder,
then Q4 runs twice (the second run is the warm time).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from pyspark.sql import functions as F

    from weblex.plans import jobs
    from weblex.session import build_session, scratch_path
    from weblex.sources.pages import link_corpus
    from weblex.sources.suffixes import fixture_rules

    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 100
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 64, extra={"spark.driver.memory": "12g"})
    path = scratch_path(spark, f"urls-x{copies}")
    copy = F.explode(F.sequence(F.lit(1), F.lit(copies)))
    (link_corpus(spark, sf_dir).select("url", copy.alias("c"))
        .select(F.concat("url", F.lit("?c="), F.col("c").cast("string")).alias("url"))
        .write.parquet(path))
    urls = spark.read.parquet(path)
    n = urls.count()
    rules = fixture_rules(spark)
    runs = []
    for _ in range(2):
        t = time.time()
        terms_kept = len(jobs.term_frequency(urls, rules).collect())
        runs.append(round(time.time() - t, 2))
    print(json.dumps({"urls": n, "copies": copies, "q4_sec": runs, "warm_urls_per_sec": round(n / runs[-1]),
                      "terms_kept": terms_kept}))


if __name__ == "__main__":
    main()
