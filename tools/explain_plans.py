"""Write PLANS.md: the physical plan of each main operator as the build runs
it (over stored Parquet tables), with a count of exchanges and join kinds.

    python tools/explain_plans.py [/root/testdata/sf0.1] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import sys
import uuid
from datetime import datetime, timezone

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from reelhouse.operators import checks, dims, facts, marts, rollups, scd2, upsert
    from reelhouse.plans.build import build_gold, build_silver
    from reelhouse.plans.tables import TableStore
    from reelhouse.session import build_session, checkpoint_dir
    from reelhouse.sources.fixtures import raw_relations

    spark = build_session("local[8]", shuffle_partitions=8)
    root = f"{checkpoint_dir(spark).rstrip('/')}/plans-{uuid.uuid4().hex[:12]}"
    store = TableStore(spark, root)
    build_silver(store, raw_relations(spark, sf_dir))
    build_gold(store, datetime(2025, 1, 1, tzinfo=timezone.utc))
    r = store.read
    ts = datetime(2025, 2, 1, tzinfo=timezone.utc)
    key, cols = scd2.SNAPSHOT_SPECS["mart_user_behavior"]
    cases = [
        ("dim_movies", dims.dim_movies(r("stg_movies"), r("stg_links"))),
        ("dim_users (sorted query form)", dims.dim_users(r("stg_ratings"), r("stg_tags"))),
        ("fact_ratings, one year", facts.fact_ratings(r("stg_ratings"), r("dim_movies"), None, [1997])),
        ("fact_movie_genre_ratings", facts.fact_movie_genre_ratings(r("fact_ratings"), r("dim_movies"))),
        ("mart_movie_analytics", marts.mart_movie_analytics(r("fact_ratings"), r("fact_tags"), r("dim_movies"))),
        ("mart_user_behavior", marts.mart_user_behavior(r("fact_ratings"), r("fact_tags"), r("dim_movies"))),
        ("mart_genre_performance", marts.mart_genre_performance(
            r("fact_ratings"), r("fact_tags"), r("dim_movies"))),
        ("mart_genre_performance from the years' rollups", marts.genre_mart(
            rollups.by_movie(r("rollup_movies")), rollups.by_genre_raters(r("rollup_genre_raters")), r("fact_tags"), r("dim_movies"))),
        ("rollup of one year's raters", rollups.genre_raters(r("fact_ratings").filter("year = 1997"), r("dim_movies"))),
        ("upsert of one year into its partition", upsert.upsert(
            r("fact_ratings").filter("year = 1997"),
            facts.fact_ratings(r("stg_ratings"), r("dim_movies"), None, [1997]))),
        ("scd2 merge (current partition only)", scd2.scd2_merge(
            store.read_history("snap_mart_user_behavior", current_only=True),
            r("mart_user_behavior"), key, cols, ts)),
        ("check C2 unique key", checks.check_fact_ratings_unique_key(r("fact_ratings"))),
        ("check C5 exploded totals", checks.check_fmgr_preserves_totals(
            r("fact_ratings"), r("dim_movies"), r("fact_movie_genre_ratings"))),
    ]
    print("# PLANS — physical plans as the build runs them\n")
    print(f"Generated by `python tools/explain_plans.py {sf_dir}` (Spark {spark.version}, "
          "AQE on; plans before AQE re-optimisation).  Inputs are the stored Parquet tables "
          "of a build, so scans show their pushed filters and read schemas.\n")
    for title, df in cases:
        text = formatted(df)
        tree = text.split("\n\n")[0]
        body = text[len(tree):]
        scans = [ln for ln in body.splitlines()
                 if ln.startswith(("PushedFilters", "ReadSchema", "PartitionFilters"))]
        print(f"## {title}\n")
        print(f"Exchanges: {tree.count('Exchange') - tree.count('BroadcastExchange')} shuffle, "
              f"{tree.count('BroadcastExchange')} broadcast; joins: "
              f"{tree.count('BroadcastHashJoin')} broadcast-hash, {tree.count('SortMergeJoin')} sort-merge.\n")
        print("```\n" + tree.strip() + "\n```\n")
        if scans:
            print("Scans:\n\n```\n" + "\n".join(sorted(set(scans))) + "\n```\n")


if __name__ == "__main__":
    main()
