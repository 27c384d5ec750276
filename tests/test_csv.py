"""Raw CSV reading edge cases (FIXTURES §4) and staging casts."""

import os

from reelhouse.operators.staging import stg_links, stg_movies, stg_ratings
from reelhouse.sources.csv import land_raw, read_raw_csv


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_csv_edge_quotes(spark, scratch):
    p = write(os.path.join(scratch, "movies.csv"),
              'movieId,title,genres\n1,"Toy, Story (1995)",A|B\n'
              '2,"The ""Great"" One, Part 2 (2001)",Drama\n3,No year,(no genres listed)\n4,,\n')
    rows = {r.movieId: r for r in read_raw_csv(spark, p, "movies").collect()}
    assert len(rows) == 4
    assert rows["1"].title == "Toy, Story (1995)"
    assert rows["2"].title == 'The "Great" One, Part 2 (2001)' and rows["2"].genres == "Drama"
    assert rows["4"].title is None and rows["4"].genres is None


def test_csv_newline_in_quotes(spark, scratch):
    p = write(os.path.join(scratch, "tags.csv"),
              'userId,movieId,tag,timestamp\n1,2,"two\nlines",5\n')
    assert read_raw_csv(spark, p, "tags", multi_line=True).count() == 1
    assert read_raw_csv(spark, p, "tags", multi_line=False).count() == 2


def test_bad_casts_become_null(spark):
    raw = spark.createDataFrame([("",), ("x",), ("99999999999",), (" 12 ",), ("12.7",)],
                                "movieId string")
    got = [r.movie_id for r in stg_movies(raw.selectExpr("movieId", "'t' title", "'g' genres"))
           .collect()]
    assert got == [None, None, None, 12, 12]


def test_staging_types(spark):
    raw = spark.createDataFrame([("1", "2", "4.5", "0")], "userId string, movieId string, "
                                "rating string, timestamp string")
    r = stg_ratings(raw).collect()[0]
    assert (r.user_id, r.movie_id, r.rating) == (1, 2, 4.5)
    assert str(r.created_at) == "1970-01-01 00:00:00"
    links = spark.createDataFrame([("1", "0114709", "862")], "movieId string, imdbId string, "
                                  "tmdbId string")
    l = stg_links(links).collect()[0]
    assert (l.movie_id, l.imdb_id, l.tmdb_id) == (1, "0114709", 862)


def test_land_raw_roundtrip(spark, scratch):
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    write(os.path.join(src, "movies.csv"), "movieId,title,genres\n1,A (1995),Drama|Comedy\n")
    write(os.path.join(src, "links.csv"), "movieId,imdbId,tmdbId\n1,0114709,862\n")
    write(os.path.join(src, "ratings.csv"), "userId,movieId,rating,timestamp\n1,1,4.0,964982703\n")
    write(os.path.join(src, "tags.csv"), "userId,movieId,tag,timestamp\n1,1, Funny ,964982703\n")
    out = land_raw(spark, src, os.path.join(scratch, "bronze"))
    assert {k: v.count() for k, v in out.items()} == {"movies": 1, "links": 1, "ratings": 1,
                                                      "tags": 1}
    assert out["tags"].collect()[0].tag == " Funny "
