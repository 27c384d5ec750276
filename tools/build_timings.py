"""

    python tools/build_timings.py [/root/testdata/sf0.1] [runs]

Builds into a fresh folder under the session's checkpoint folder per run,
times every step, prints one JSON line with the median seconds per step.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import uuid
import time
from datetime import datetime, timezone

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def one_run(spark, sf_dir: str) -> dict[str, float]:
    from reelhouse.operators import dims, facts, marts, staging
    from reelhouse.operators.scd2 import SNAPSHOT_SPECS
    from reelhouse.plans.build import run_checks
    from reelhouse.plans.tables import TableStore
    from reelhouse.sources.fixtures import raw_relations

    from reelhouse.session import checkpoint_dir
    # scratch tables next to the checkpoints: shared storage on a cluster
    root = f"{checkpoint_dir(spark).rstrip('/')}/bench-build-{uuid.uuid4().hex[:12]}"
    store = TableStore(spark, root)
    raw = raw_relations(spark, sf_dir)
    out: dict[str, float] = {}

    def step(name, fn):
        t = time.perf_counter()
        fn()
        out[name] = out.get(name, 0.0) + time.perf_counter() - t

    r = store.read
    # land the raw relations first so staging times exclude the fixture derivation
    step("bronze", lambda: [store.full_refresh(f"raw_{k}", v) for k, v in raw.items()])
    landed = {k: r(f"raw_{k}") for k in raw}
    step("staging", lambda: [store.full_refresh(n, d) for n, d in staging.staging(landed).items()])
    step("dims", lambda: (store.full_refresh("dim_movies", dims.dim_movies(r("stg_movies"), r("stg_links"))),
                          store.full_refresh("dim_users", dims.dim_users(r("stg_ratings"), r("stg_tags"), sort=False))))
    step("fact_ratings_full", lambda: store.merge_upsert(
        "fact_ratings", facts.fact_ratings(r("stg_ratings"), r("dim_movies"), None), years=facts.PARTITION_YEARS))
    step("fact_ratings_one_year_upsert", lambda: store.merge_upsert(
        "fact_ratings", facts.fact_ratings(r("stg_ratings"), r("dim_movies"), None, [1997]), years=[1997]))
    step("fact_tags_fmgr", lambda: (
        store.full_refresh("fact_tags", facts.fact_tags(r("stg_tags"), r("dim_movies"), None)),
        store.full_refresh("fact_movie_genre_ratings",
                           facts.fact_movie_genre_ratings(r("fact_ratings"), r("dim_movies")))))
    as_of = datetime(2025, 1, 1, tzinfo=timezone.utc)
    step("mart_movie_analytics", lambda: store.full_refresh("mart_movie_analytics", marts.mart_movie_analytics(
        r("fact_ratings"), r("fact_tags"), r("dim_movies"), as_of)))
    step("mart_user_behavior", lambda: store.full_refresh("mart_user_behavior", marts.mart_user_behavior(
        r("fact_ratings"), r("fact_tags"), r("dim_movies"), None, as_of)))
    step("mart_genre_performance", lambda: store.full_refresh("mart_genre_performance", marts.mart_genre_performance(
        r("fact_ratings"), r("fact_tags"), r("dim_movies"), as_of)))
    for label, ts in (("scd2_first", as_of), ("scd2_second", datetime(2025, 2, 1, tzinfo=timezone.utc))):
        step(label, lambda ts=ts: [store.snapshot(f"snap_{m}", r(m), k, c, ts)
                                   for m, (k, c) in SNAPSHOT_SPECS.items()])
    step("checks_c1_c10", lambda: run_checks(store).collect())
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    runs = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    from reelhouse.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra_conf={"spark.driver.memory": "16g"})
    results = [one_run(spark, sf_dir) for _ in range(runs)]
    med = {k: round(statistics.median(r[k] for r in results), 2) for k in results[0]}
    print(json.dumps({"sf_dir": sf_dir, "runs": runs, "seconds": med}))


if __name__ == "__main__":
    main()
