"""The whole build over CSV sources and over the sf0.001 relations."""

import os

from reelhouse.plans.build import build_lakehouse
from reelhouse.plans.tables import TableStore
from reelhouse.sources.fixtures import raw_relations
from tests.conftest import SMALL

RATINGS = 5585  # valid ratings of sf0.001, by the oracle


def test_build_from_fixture_relations(spark, scratch):
    out = build_lakehouse(spark, scratch, raw=raw_relations(spark, SMALL), database="gold_test")
    counts = {r["table"]: r["row_count"] for r in out["reports"]}
    assert counts["fact_ratings"] == RATINGS
    assert counts["dim_movies"] == 332
    assert counts["snap_mart_movie_analytics"] == counts["mart_movie_analytics"]
    assert all(r.passed for r in out["checks"].collect())
    assert len(out["registered"]) == 6
    assert spark.table("gold_test.mart_genre_performance").count() == counts["mart_genre_performance"]
    # a second build over the same data opens no new versions
    out2 = build_lakehouse(spark, scratch, raw=raw_relations(spark, SMALL))
    counts2 = {r["table"]: r for r in out2["reports"]}
    for snap in ("snap_mart_movie_analytics", "snap_mart_user_behavior",
                 "snap_mart_genre_performance"):
        assert counts2[snap]["row_count"] == counts2[snap]["current_row_count"]
    # the upsert re-merged the same years: no duplicates
    assert TableStore(spark, scratch).read("fact_ratings").count() == RATINGS


def test_build_from_csv(spark, scratch):
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    files = {
        "movies.csv": "movieId,title,genres\n1,A (1995),Drama|Comedy\n2,B (2001),Drama\n",
        "links.csv": "movieId,imdbId,tmdbId\n1,0114709,862\n",
        "ratings.csv": "userId,movieId,rating,timestamp\n1,1,4.0,964982703\n2,2,3.5,964982800\n",
        "tags.csv": "userId,movieId,tag,timestamp\n3,1, Funny ,964982703\n",
    }
    for name, text in files.items():
        with open(os.path.join(src, name), "w") as f:
            f.write(text)
    out = build_lakehouse(spark, os.path.join(scratch, "lake"), src_dir=src)
    counts = {r["table"]: r["row_count"] for r in out["reports"]}
    assert counts["fact_ratings"] == 2 and counts["fact_tags"] == 1
    assert counts["mart_user_behavior"] == 2 and counts["mart_genre_performance"] == 2
    assert all(r.passed for r in out["checks"].collect())
    assert counts["bronze_ratings"] == 2 and counts["bronze_movies"] == 2
    sizes = {r["table"]: r["file_size_bytes"] for r in out["reports"] if r["table"].startswith("bronze_")}
    assert sizes["bronze_tags"] == os.path.getsize(os.path.join(src, "tags.csv"))
    assert all(r.passed for r in out["bronze_checks"].collect())


def test_catalog_snapshot_types(spark, scratch):
    out = build_lakehouse(spark, scratch, raw=raw_relations(spark, SMALL), database="gold_types")
    t = spark.table("gold_types.snap_mart_user_behavior")
    assert dict(t.dtypes)["is_current"] == "boolean"
    assert t.filter("is_current").count() == {r["table"]: r for r in out["reports"]}[
        "snap_mart_user_behavior"]["current_row_count"]


def test_tables_survive_a_new_session(spark, scratch):
    import subprocess
    import sys
    build_lakehouse(spark, scratch, raw=raw_relations(spark, SMALL))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from reelhouse.session import build_session\n"
        "from reelhouse.plans.tables import TableStore\n"
        "from reelhouse.plans.catalog import register_stored\n"
        "s = build_session('local[2]', shuffle_partitions=2)\n"
        "st = TableStore(s, %r)\n"
        "register_stored(s, 'again', st, ['fact_ratings'])\n"
        "print(st.read('fact_ratings').count(), s.table('again.fact_ratings').count(), "
        "st.read('snap_mart_movie_analytics').filter('is_current').count())\n"
    ) % (os.path.dirname(os.path.dirname(os.path.abspath(__file__))), scratch)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True,
                         timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    fact, catalog, current = map(int, out.stdout.split()[-3:])
    assert fact == catalog == RATINGS
    assert current == TableStore(spark, scratch).read("mart_movie_analytics").count()
