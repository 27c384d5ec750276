"""DuckDB reference SQL for every registered query.

Written independently of the Spark code, straight from the semantics: the
raw relations are rebuilt from the base tables with the text of
``FIXTURES.md`` and every later layer is plain SQL on top.  Each oracle is
one statement: ``WITH <all layers> SELECT ...`` (DuckDB inlines the CTEs a
statement does not use).

Comparison conventions shared with :mod:`reelhouse.plans.queries`: sample
standard deviations are rounded to 6 places (the engines differ in the last
bit), timestamps are naive UTC, ``refreshed_at`` is the fixed ``AS_OF``.
"""

from __future__ import annotations

AS_OF_SQL = "TIMESTAMP '2025-01-01 00:00:00'"
T1_SQL = "TIMESTAMP '2024-06-01 00:00:00'"
T2_SQL = "TIMESTAMP '2025-01-01 00:00:00'"

LAYERS = r"""
raw_movies AS (
 SELECT CAST(p_partkey AS VARCHAR) AS "movieId",
  CASE WHEN p_partkey % 97 = 0 THEN p_name
       WHEN p_partkey % 5 = 0 THEN p_name || ' (' || CAST(1960 + p_partkey % 68 AS VARCHAR) || ')  '
       ELSE p_name || ' (' || CAST(1960 + p_partkey % 68 AS VARCHAR) || ')' END AS title,
  CASE WHEN p_partkey % 201 = 0 THEN NULL
       WHEN p_partkey % 199 = 0 THEN '(no genres listed)'
       WHEN p_partkey % 3 = 0 THEN p_type
       WHEN p_partkey % 7 = 0 THEN p_type || '| ' || split_part(p_name, ' ', 2) || ' |'
       ELSE p_type || '|' || split_part(p_name, ' ', 2) END AS genres
 FROM part),
raw_links AS (
 SELECT CAST(p_partkey AS VARCHAR) AS "movieId",
  CASE WHEN p_partkey % 7 = 0 THEN NULL
       WHEN p_partkey % 3 = 0 THEN 'tt' || lpad(CAST(p_partkey AS VARCHAR), 7, '0')
       ELSE lpad(CAST(p_partkey AS VARCHAR), 7, '0') END AS "imdbId",
  CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(p_partkey * 10 + 3 AS VARCHAR) END AS "tmdbId"
 FROM part WHERE p_partkey % 13 <> 0),
raw_b AS (
 SELECT CASE WHEN o_custkey % 10 = 0 THEN o_custkey % 100 WHEN o_custkey % 10 = 1 THEN o_custkey % 50
             WHEN o_custkey % 10 = 2 THEN o_custkey % 300 ELSE o_custkey END AS u,
        CASE WHEN l_partkey % 50 = 7 AND l_linenumber = 7 THEN l_partkey + 9000000
             WHEN l_partkey % 20 = 0 THEN l_partkey % 400
             WHEN l_partkey % 20 = 1 AND l_linenumber > 1 THEN (l_partkey - 1) % 400 ELSE l_partkey END AS m,
        l_quantity AS q, l_shipdate AS d, l_linenumber AS n, l_orderkey AS k
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
raw_ratings AS (
 SELECT CAST(u AS VARCHAR) AS "userId", CAST(m AS VARCHAR) AS "movieId",
  CASE WHEN q = 1 THEN '0.0' WHEN q = 2 THEN '5.5' WHEN q = 3 THEN NULL
       ELSE CAST(CAST(greatest(1, least(10, CAST(ceil(q / 5) AS INTEGER) + m % 5 - 2 + u % 5 - 2)) AS DOUBLE) / 2 AS VARCHAR) END AS rating,
  CAST(CAST(epoch(d) AS BIGINT) + n * 3600 + k % 3600 AS VARCHAR) AS "timestamp"
 FROM raw_b),
raw_tags AS (
 SELECT CAST(user_id * 11 AS VARCHAR) AS "userId",
  CAST(event_id % (SELECT max(p_partkey) + 21 FROM part) AS VARCHAR) AS "movieId",
  CASE WHEN event_id % 10 = 0 THEN '  ' WHEN event_id % 10 = 1 THEN NULL
       ELSE ' ' || upper(event_type) || ' ' END AS tag,
  CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) AS "timestamp"
 FROM events),
stg_movies AS (
 SELECT TRY_CAST("movieId" AS INTEGER) AS movie_id, title, genres FROM raw_movies),
stg_links AS (
 SELECT TRY_CAST("movieId" AS INTEGER) AS movie_id, "imdbId" AS imdb_id,
        TRY_CAST("tmdbId" AS INTEGER) AS tmdb_id FROM raw_links),
stg_ratings AS (
 SELECT TRY_CAST("userId" AS INTEGER) AS user_id, TRY_CAST("movieId" AS INTEGER) AS movie_id,
        TRY_CAST(rating AS DOUBLE) AS rating,
        make_timestamp(TRY_CAST("timestamp" AS BIGINT) * 1000000) AS created_at
 FROM raw_ratings),
stg_tags AS (
 SELECT * FROM (
  SELECT TRY_CAST("userId" AS INTEGER) AS user_id, TRY_CAST("movieId" AS INTEGER) AS movie_id,
         lower(trim(tag)) AS tag,
         make_timestamp(TRY_CAST("timestamp" AS BIGINT) * 1000000) AS created_at
  FROM raw_tags) t
 WHERE tag IS NOT NULL AND tag <> ''),
links_norm AS (
 SELECT movie_id, CASE WHEN imdb_id IS NOT NULL THEN 'tt' || regexp_replace(imdb_id, '^tt', '') END AS imdb_id,
        tmdb_id FROM stg_links),
movie_genre_rows AS (
 SELECT movie_id, title, year, lower(trim(genre_raw)) AS genres, imdb_id, tmdb_id
 FROM (SELECT m.movie_id, m.title,
              TRY_CAST(regexp_extract(m.title, '\((\d{4})\)\s*$', 1) AS INTEGER) AS year,
              unnest(string_split(coalesce(m.genres, '(no genres listed)'), '|')) AS genre_raw,
              l.imdb_id, l.tmdb_id
       FROM stg_movies m LEFT JOIN links_norm l ON m.movie_id = l.movie_id) s),
dim_movies AS (
 SELECT movie_id, title, year, genres,
        count(*) OVER (PARTITION BY movie_id) AS genre_count,
        imdb_id,
        CASE WHEN imdb_id IS NOT NULL THEN 'https://www.imdb.com/title/' || imdb_id || '/' END AS imdb_url,
        tmdb_id,
        CASE WHEN tmdb_id IS NOT NULL THEN 'https://www.themoviedb.org/movie/' || CAST(tmdb_id AS VARCHAR) END AS tmdb_url
 FROM movie_genre_rows WHERE genres <> ''),
dim_users AS (
 SELECT DISTINCT user_id FROM (SELECT user_id FROM stg_ratings UNION ALL SELECT user_id FROM stg_tags) u),
valid_ratings AS (
 SELECT user_id, movie_id, rating, created_at, CAST(year(created_at) AS INTEGER) AS year
 FROM stg_ratings
 WHERE rating BETWEEN 0.5 AND 5.0
   AND movie_id IN (SELECT movie_id FROM dim_movies)
   AND user_id IN (SELECT user_id FROM dim_users WHERE user_id IS NOT NULL)),
fact_ratings AS (
 SELECT * FROM valid_ratings WHERE year BETWEEN 1995 AND 2023),
fact_tags AS (
 SELECT user_id, movie_id, tag, created_at, CAST(year(created_at) AS INTEGER) AS year
 FROM stg_tags
 WHERE movie_id IN (SELECT movie_id FROM dim_movies)
   AND user_id IN (SELECT user_id FROM dim_users WHERE user_id IS NOT NULL)),
fmgr AS (
 SELECT r.movie_id, d.title, d.year, d.genres, count(*) AS rating_count, avg(r.rating) AS avg_rating,
        min(r.rating) AS min_rating, max(r.rating) AS max_rating
 FROM fact_ratings r JOIN dim_movies d ON r.movie_id = d.movie_id
 GROUP BY r.movie_id, d.title, d.year, d.genres)
"""

# Mart templates over a ratings relation named {fr}; the snapshot oracles
# instantiate them over a year-restricted ratings relation as well.
MOVIE_MART = r"""
 SELECT i.movie_id, i.title, i.year, i.all_genres, i.genre_count,
        r.total_ratings, r.avg_rating, r.min_rating, r.max_rating, r.stddev_rating,
        r.first_rating_date, r.last_rating_date,
        CAST(datediff('day', r.first_rating_date, r.last_rating_date) AS INTEGER) AS rating_span_days,
        coalesce(t.total_tags, 0) AS total_tags, coalesce(t.unique_taggers, 0) AS unique_taggers,
        t.first_tag_date, t.last_tag_date,
        CASE WHEN r.total_ratings >= 100 THEN 'Highly Rated' WHEN r.total_ratings >= 50 THEN 'Well Rated'
             WHEN r.total_ratings >= 10 THEN 'Moderately Rated' ELSE 'Limited Ratings' END AS engagement_tier,
        CASE WHEN r.avg_rating >= 4.0 THEN 'Excellent' WHEN r.avg_rating >= 3.5 THEN 'Good'
             WHEN r.avg_rating >= 3.0 THEN 'Average' WHEN r.avg_rating >= 2.0 THEN 'Below Average'
             ELSE 'Poor' END AS quality_tier,
        {as_of} AS refreshed_at
 FROM (SELECT movie_id, any_value(title) AS title, any_value(year) AS year,
              array_to_string(list_sort(list_distinct(list(genres))), ', ') AS all_genres,
              count(DISTINCT genres) AS genre_count
       FROM dim_movies GROUP BY movie_id) i
 JOIN (SELECT movie_id, count(*) AS total_ratings, avg(rating) AS avg_rating, min(rating) AS min_rating,
              max(rating) AS max_rating, stddev_samp(rating) AS stddev_rating,
              min(created_at) AS first_rating_date, max(created_at) AS last_rating_date
       FROM {fr} GROUP BY movie_id) r ON i.movie_id = r.movie_id
 LEFT JOIN (SELECT movie_id, count(*) AS total_tags, count(DISTINCT user_id) AS unique_taggers,
                   min(created_at) AS first_tag_date, max(created_at) AS last_tag_date
            FROM fact_tags GROUP BY movie_id) t ON i.movie_id = t.movie_id
"""

USER_MART = r"""
 SELECT r.user_id, r.total_ratings, r.unique_movies_rated, r.avg_rating_given, r.min_rating_given,
        r.max_rating_given, r.stddev_rating, r.first_rating_date, r.last_rating_date, r.active_days,
        coalesce(t.total_tags, 0) AS total_tags, coalesce(t.unique_movies_tagged, 0) AS unique_movies_tagged,
        t.first_tag_date, t.last_tag_date,
        p.genres AS preferred_genre, p.cnt AS preferred_genre_count, p.avg_r AS preferred_genre_avg_rating,
        CASE WHEN r.total_ratings >= 1000 THEN 'Power' WHEN r.total_ratings >= 500 THEN 'Heavy'
             WHEN r.total_ratings >= 100 THEN 'Active' WHEN r.total_ratings >= 20 THEN 'Regular'
             ELSE 'Light' END AS user_segment,
        CASE WHEN r.avg_rating_given >= 4.0 THEN 'Positive Rater' WHEN r.avg_rating_given >= 3.0 THEN 'Neutral Rater'
             ELSE 'Critical Rater' END AS rating_style,
        CASE WHEN r.active_days > 0 THEN r.total_ratings / r.active_days ELSE 0.0 END AS avg_ratings_per_day,
        {as_of} AS refreshed_at
 FROM (SELECT user_id, count(*) AS total_ratings, count(DISTINCT movie_id) AS unique_movies_rated,
              avg(rating) AS avg_rating_given, min(rating) AS min_rating_given, max(rating) AS max_rating_given,
              stddev_samp(rating) AS stddev_rating, min(created_at) AS first_rating_date,
              max(created_at) AS last_rating_date, count(DISTINCT CAST(created_at AS DATE)) AS active_days
       FROM {fr} WHERE user_id IN (SELECT user_id FROM dim_users) GROUP BY user_id) r
 LEFT JOIN (SELECT user_id, count(*) AS total_tags, count(DISTINCT movie_id) AS unique_movies_tagged,
                   min(created_at) AS first_tag_date, max(created_at) AS last_tag_date
            FROM fact_tags GROUP BY user_id) t ON r.user_id = t.user_id
 LEFT JOIN (SELECT * FROM (
              SELECT user_id, genres, cnt, avg_r,
                     row_number() OVER (PARTITION BY user_id ORDER BY cnt DESC, avg_r DESC, genres ASC) AS rn
              FROM (SELECT f.user_id, d.genres, count(*) AS cnt, avg(f.rating) AS avg_r
                    FROM {fr} f JOIN dim_movies d ON f.movie_id = d.movie_id
                    GROUP BY f.user_id, d.genres) g) x WHERE rn = 1) p ON r.user_id = p.user_id
"""

GENRE_MART = r"""
 SELECT m.genres, m.unique_movies, d.total_ratings, d.unique_raters, d.avg_rating, m.min_rating, m.max_rating,
        d.stddev_rating, d.first_rating_date, d.last_rating_date,
        CAST(datediff('day', d.first_rating_date, d.last_rating_date) AS INTEGER) AS rating_span_days,
        coalesce(t.total_tags, 0) AS total_tags, coalesce(t.unique_taggers, 0) AS unique_taggers,
        y.movies_2020s, y.movies_2010s, y.movies_2000s, y.movies_1990s, y.movies_before_1990,
        CASE WHEN d.total_ratings >= 100000 THEN 'Highly Popular' WHEN d.total_ratings >= 50000 THEN 'Very Popular'
             WHEN d.total_ratings >= 10000 THEN 'Popular' WHEN d.total_ratings >= 1000 THEN 'Moderately Popular'
             ELSE 'Niche' END AS popularity_tier,
        CASE WHEN d.avg_rating >= 3.8 THEN 'Top Rated' WHEN d.avg_rating >= 3.5 THEN 'Well Rated'
             WHEN d.avg_rating >= 3.2 THEN 'Average Rated' ELSE 'Below Average' END AS quality_tier,
        CASE WHEN m.unique_movies > 0 THEN d.total_ratings / m.unique_movies ELSE 0.0 END AS avg_ratings_per_movie,
        {as_of} AS refreshed_at
 FROM (SELECT r.genres_k AS genres, count(DISTINCT r.movie_id) AS unique_movies,
              min(r.rating) AS min_rating, max(r.rating) AS max_rating
       FROM (SELECT f.movie_id, f.rating, d.genres AS genres_k FROM {fr} f JOIN dim_movies d ON f.movie_id = d.movie_id) r
       GROUP BY r.genres_k) m
 JOIN (SELECT d.genres, count(*) AS total_ratings, avg(f.rating) AS avg_rating,
              count(DISTINCT f.user_id) AS unique_raters, stddev_samp(f.rating) AS stddev_rating,
              min(f.created_at) AS first_rating_date, max(f.created_at) AS last_rating_date
       FROM {fr} f JOIN dim_movies d ON f.movie_id = d.movie_id GROUP BY d.genres) d ON m.genres = d.genres
 LEFT JOIN (SELECT d.genres, count(*) AS total_tags, count(DISTINCT t.user_id) AS unique_taggers
            FROM fact_tags t JOIN dim_movies d ON t.movie_id = d.movie_id GROUP BY d.genres) t ON m.genres = t.genres
 LEFT JOIN (SELECT genres,
              CAST(sum(CASE WHEN year >= 2020 AND year < 2030 THEN 1 ELSE 0 END) AS BIGINT) AS movies_2020s,
              CAST(sum(CASE WHEN year >= 2010 AND year < 2020 THEN 1 ELSE 0 END) AS BIGINT) AS movies_2010s,
              CAST(sum(CASE WHEN year >= 2000 AND year < 2010 THEN 1 ELSE 0 END) AS BIGINT) AS movies_2000s,
              CAST(sum(CASE WHEN year >= 1990 AND year < 2000 THEN 1 ELSE 0 END) AS BIGINT) AS movies_1990s,
              CAST(sum(CASE WHEN year < 1990 THEN 1 ELSE 0 END) AS BIGINT) AS movies_before_1990
            FROM dim_movies GROUP BY genres) y ON m.genres = y.genres
"""


def with_layers(body: str, extra: str = "") -> str:
    extra = ("," + extra) if extra else ""
    return "WITH " + LAYERS.strip() + extra + "\n" + body.strip()


def movie_mart(fr: str = "fact_ratings", as_of: str = AS_OF_SQL) -> str:
    return MOVIE_MART.format(fr=fr, as_of=as_of)


def user_mart(fr: str = "fact_ratings", as_of: str = AS_OF_SQL) -> str:
    return USER_MART.format(fr=fr, as_of=as_of)


def genre_mart(fr: str = "fact_ratings", as_of: str = AS_OF_SQL) -> str:
    return GENRE_MART.format(fr=fr, as_of=as_of)


def scd2_sql(mart_t1: str, mart_t2: str, key: str, watched: list[str],
             t1: str = T1_SQL, t2: str = T2_SQL) -> str:
    """History after a first load of ``mart_t1`` at t1 and a merge of ``mart_t2`` at t2."""
    changed = " OR ".join(f"h.{c} IS DISTINCT FROM s.{c}" for c in watched)
    return f"""
 WITH h1 AS (SELECT *, {t1} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
             FROM ({mart_t1}) m1),
      src AS ({mart_t2})
 SELECT h.* REPLACE (
          CASE WHEN s.{key} IS NOT NULL AND ({changed}) THEN {t2} ELSE h.valid_to END AS valid_to,
          CASE WHEN s.{key} IS NOT NULL AND ({changed}) THEN FALSE ELSE h.is_current END AS is_current)
 FROM h1 h LEFT JOIN src s ON h.{key} = s.{key}
 UNION ALL
 SELECT s.*, {t2} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
 FROM src s LEFT JOIN h1 h ON h.{key} = s.{key}
 WHERE h.{key} IS NULL OR ({changed})
"""


def scd2_steps(loads: list[tuple[str, str]], key: str, watched: list[str]) -> str:
    """History after loads of (mart, clock) in that order; the first opens it."""
    changed = " OR ".join(f"h.{c} IS DISTINCT FROM s.{c}" for c in watched)
    ctes = [f"h0 AS (SELECT *, {loads[0][1]} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current FROM ({loads[0][0]}) m0)"]
    for i, (mart, ts) in enumerate(loads[1:], 1):
        ends = f"h.is_current AND s.{key} IS NOT NULL AND ({changed})"
        ctes.append(f"s{i} AS ({mart})")
        ctes.append(f"""h{i} AS (
 SELECT h.* REPLACE (CASE WHEN {ends} THEN {ts} ELSE h.valid_to END AS valid_to, CASE WHEN {ends} THEN FALSE ELSE h.is_current END AS is_current)
 FROM h{i - 1} h LEFT JOIN s{i} s ON h.{key} = s.{key}
 UNION ALL
 SELECT s.*, {ts}, CAST(NULL AS TIMESTAMP), TRUE FROM s{i} s LEFT JOIN (SELECT * FROM h{i - 1} WHERE is_current) h ON h.{key} = s.{key}
 WHERE h.{key} IS NULL OR ({changed}))""")
    return f"WITH {', '.join(ctes)} SELECT * FROM h{len(loads) - 1}"
