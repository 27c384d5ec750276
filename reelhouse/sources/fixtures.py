"""Raw movies / links / ratings / tags relations derived from the test tables.

The driver ships TPC-H-like Parquet tables, not rating CSVs.  These
functions re-shape ``part``, ``lineitem``, ``orders`` and ``events`` into the
four raw relations (every column a string, as a header-only CSV read gives)
with deliberate twists: titles without a year or with trailing blanks, NULL
and padded genre lists, missing links, out-of-range ratings, unknown movie
ids, blank tags and tag-only users.  The definitions are deterministic and
mirror the DuckDB text in ``FIXTURES.md`` so both engines see the same rows.

All four are plain projections / one equi-join over the inputs, so they
scale with the tables they read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("part", "lineitem", "orders", "events")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c):
    return c.cast("string")


def raw_movies(part: DataFrame) -> DataFrame:
    p = F.col("p_partkey")
    year_txt = _s(F.lit(1960) + p % 68)
    second_word = F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))
    title = (F.when(p % 97 == 0, F.col("p_name"))
             .when(p % 5 == 0, F.concat(F.col("p_name"), F.lit(" ("), year_txt, F.lit(")  ")))
             .otherwise(F.concat(F.col("p_name"), F.lit(" ("), year_txt, F.lit(")"))))
    genres = (F.when(p % 201 == 0, F.lit(None).cast("string"))
              .when(p % 199 == 0, F.lit("(no genres listed)"))
              .when(p % 3 == 0, F.col("p_type"))
              .when(p % 7 == 0, F.concat(F.col("p_type"), F.lit("| "), second_word, F.lit(" |")))
              .otherwise(F.concat(F.col("p_type"), F.lit("|"), second_word)))
    return part.select(_s(p).alias("movieId"), title.alias("title"), genres.alias("genres"))


def raw_links(part: DataFrame) -> DataFrame:
    p = F.col("p_partkey")
    padded = F.lpad(_s(p), 7, "0")
    imdb = (F.when(p % 7 == 0, F.lit(None).cast("string"))
            .when(p % 3 == 0, F.concat(F.lit("tt"), padded))
            .otherwise(padded))
    tmdb = F.when(p % 11 == 0, F.lit(None).cast("string")).otherwise(_s(p * 10 + 3))
    return (part.filter(p % 13 != 0)
            .select(_s(p).alias("movieId"), imdb.alias("imdbId"), tmdb.alias("tmdbId")))


def raw_ratings(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    od = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    b = li.join(od, "l_orderkey")
    c = F.col("o_custkey")
    u = (F.when(c % 10 == 0, c % 100).when(c % 10 == 1, c % 50)
         .when(c % 10 == 2, c % 300).otherwise(c))
    pk, ln = F.col("l_partkey"), F.col("l_linenumber")
    m = (F.when((pk % 50 == 7) & (ln == 7), pk + 9000000)
         .when(pk % 20 == 0, pk % 400)
         .when((pk % 20 == 1) & (ln > 1), (pk - 1) % 400).otherwise(pk))
    b = b.select(u.alias("u"), m.alias("m"), F.col("l_quantity").alias("q"),
                 F.col("l_shipdate").alias("d"), ln.alias("n"), F.col("l_orderkey").alias("k"))
    q, uu, mm = F.col("q"), F.col("u"), F.col("m")
    stars = F.greatest(F.lit(1), F.least(F.lit(10),
                       F.ceil(q / 5).cast("int") + mm % 5 - 2 + uu % 5 - 2))
    rating = (F.when(q == 1, F.lit("0.0")).when(q == 2, F.lit("5.5"))
              .when(q == 3, F.lit(None).cast("string"))
              .otherwise(_s(stars.cast("double") / 2)))
    epoch = F.unix_seconds(F.col("d").cast("timestamp"))
    ts = epoch + F.col("n") * 3600 + F.col("k") % 3600
    return b.select(_s(uu).alias("userId"), _s(mm).alias("movieId"),
                    rating.alias("rating"), _s(ts).alias("timestamp"))


def raw_tags(events: DataFrame, part: DataFrame) -> DataFrame:
    # One-row scalar subquery: the movie-id modulus grows with the part table.
    modulus = part.select((F.max("p_partkey") + 21).alias("m")).scalar()
    e = F.col("event_id")
    tag = (F.when(e % 10 == 0, F.lit("  ")).when(e % 10 == 1, F.lit(None).cast("string"))
           .otherwise(F.concat(F.lit(" "), F.upper(F.col("event_type")), F.lit(" "))))
    ts = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("bigint")
    return events.select(_s(F.col("user_id") * 11).alias("userId"), _s(e % modulus).alias("movieId"),
                         tag.alias("tag"), _s(ts).alias("timestamp"))


def raw_relations(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """``{"movies", "links", "ratings", "tags"}`` raw (all-string) relations."""
    part = read_table(spark, sf_dir, "part")
    return {
        "movies": raw_movies(part),
        "links": raw_links(part),
        "ratings": raw_ratings(read_table(spark, sf_dir, "lineitem"),
                               read_table(spark, sf_dir, "orders")),
        "tags": raw_tags(read_table(spark, sf_dir, "events"), part),
    }
