"""Streaming feed: files arriving in two rounds end in the same table as a
one-shot load of all of them."""

import os

from reelhouse.plans.tables import TableStore
from reelhouse.streaming import PENDING, release_pending, start_ratings_feed

HEADER = "userId,movieId,rating,timestamp\n"


def test_feed_merges_new_files(spark, scratch):
    store = TableStore(spark, os.path.join(scratch, "lake"))
    dim = spark.createDataFrame([(1, "A (1995)", 1995, "drama", 1), (2, "B (1996)", 1996, "drama", 1)],
                                "movie_id int, title string, year int, genres string, genre_count bigint")
    store.full_refresh("dim_movies", dim)
    store.full_refresh("dim_users", spark.createDataFrame([(u,) for u in (1, 2, 3, 4, 5)], "user_id int"))
    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    ckpt = os.path.join(scratch, "stream-ckpt")
    with open(os.path.join(landing, "r1.csv"), "w") as f:
        # 946684800 = 2000-01-01; 978307200 = 2001-01-01; movie 9 is unknown; 7.0 invalid
        f.write(HEADER + "1,1,4.0,946684800\n2,2,3.0,946684900\n3,9,4.0,946685000\n4,1,7.0,946685100\n")
    q = start_ratings_feed(spark, store, landing, ckpt)
    q.awaitTermination(120)
    assert store.read("fact_ratings").count() == 2
    with open(os.path.join(landing, "r2.csv"), "w") as f:
        # a correction of (1,1,2000-01-01) and a new 2001 rating
        # and a user the dimension doesn't know
        f.write(HEADER + "1,1,2.5,946684800\n5,2,5.0,978307200\n77,2,5.0,978307200\n")
    q = start_ratings_feed(spark, store, landing, ckpt)
    q.awaitTermination(120)
    got = sorted((r.user_id, r.movie_id, r.rating, r.year)
                 for r in store.read("fact_ratings").collect())
    assert got == [(1, 1, 2.5, 2000), (2, 2, 3.0, 2000), (5, 2, 5.0, 2001)]


def test_ratings_of_later_users_and_movies_appear(spark, scratch):
    store = TableStore(spark, os.path.join(scratch, "lake"))
    schema = "movie_id int, title string, year int, genres string, genre_count bigint"
    movie = lambda *ids: spark.createDataFrame([(i, "A (1995)", 1995, "drama", 1) for i in ids], schema)
    users = lambda *ids: store.full_refresh("dim_users", spark.createDataFrame([(u,) for u in ids], "user_id int"))
    fact = lambda: sorted((r.user_id, r.movie_id, r.rating) for r in store.read("fact_ratings").collect())
    store.full_refresh("dim_movies", movie(1))
    users(1)
    landing, ckpt = os.path.join(scratch, "landing"), os.path.join(scratch, "stream-ckpt")
    os.makedirs(landing)

    def arrive(name, rows):
        with open(os.path.join(landing, name), "w") as f:
            f.write(HEADER + "".join(r + "\n" for r in rows))
        q = start_ratings_feed(spark, store, landing, ckpt)
        q.awaitTermination(120)

    arrive("r1.csv", ["1,1,4.0,946684800", "2,1,3.0,946684900", "1,9,2.0,946684950", "3,1,9.0,946684900", ",1,3.0,946684900"])
    assert fact() == [(1, 1, 4.0)] and store.read(PENDING).count() == 2
    arrive("r2.csv", ["2,1,3.5,946684900", "4,1,1.0,946684900"])  # a correction of a rating that waits
    assert fact() == [(1, 1, 4.0)] and store.read(PENDING).count() == 3
    users(1, 2)
    assert release_pending(store) == 2 and fact() == [(1, 1, 4.0), (2, 1, 3.5)]
    store.full_refresh("dim_movies", movie(1, 9))
    users(1, 2, 4)
    assert release_pending(store) == 0 and release_pending(store) == 0
    assert fact() == [(1, 1, 4.0), (1, 9, 2.0), (2, 1, 3.5), (4, 1, 1.0)]
