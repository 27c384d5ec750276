"""The oracle statement for each registered query key."""

from __future__ import annotations

from reelhouse.oracle_sql import (
    T1_SQL,
    T2_SQL,
    genre_mart,
    movie_mart,
    scd2_sql,
    scd2_steps,
    user_mart,
    with_layers,
)

STDDEV6 = "round(stddev_rating, 6) AS stddev_rating"
FR_T1 = "fact_ratings_t1 AS (SELECT * FROM fact_ratings WHERE year BETWEEN 1995 AND 1999)"


def _q(body: str, extra: str = "") -> str:
    return with_layers(body, extra)


def _rounded(sql: str) -> str:
    return f"SELECT * REPLACE ({STDDEV6}) FROM ({sql}) x"


def _check(name: str, metrics_sql: str, passed: str, cols: list[str]) -> str:
    return _q(f"SELECT '{name}' AS \"check\", {passed} AS passed, {', '.join(cols)} "
              f"FROM ({metrics_sql}) m")


def oracle() -> dict[str, str]:
    mm, um, gm = movie_mart(), user_mart(), genre_mart()
    q = {
        "stg_movies": _q("SELECT * FROM stg_movies"),
        "stg_links": _q("SELECT * FROM stg_links"),
        "stg_ratings": _q("SELECT * FROM stg_ratings"),
        "stg_tags": _q("SELECT * FROM stg_tags"),
        "dim_movies": _q("SELECT * FROM dim_movies"),
        "dim_users": _q("SELECT user_id FROM dim_users ORDER BY user_id"),
        "fact_ratings": _q("SELECT * FROM fact_ratings"),
        "fact_tags": _q("SELECT * FROM fact_tags"),
        "fact_movie_genre_ratings": _q("SELECT * FROM fmgr"),
        "mart_movie_analytics": _q(_rounded(mm)),
        "mart_user_behavior": _q(_rounded(um)),
        "mart_genre_performance": _q(_rounded(gm)),
        # §2.D primitives
        "join_inner": _q("SELECT d.genres, count(*) AS rating_count FROM fact_ratings f "
                         "JOIN dim_movies d ON f.movie_id = d.movie_id GROUP BY d.genres"),
        "join_left": _q("SELECT m.movie_id, m.title, l.imdb_id, l.tmdb_id FROM stg_movies m "
                        "LEFT JOIN stg_links l ON m.movie_id = l.movie_id"),
        "join_semi": _q("SELECT * FROM stg_ratings r WHERE EXISTS "
                        "(SELECT 1 FROM dim_movies d WHERE d.movie_id = r.movie_id)"),
        "join_anti": _q("SELECT * FROM stg_ratings r WHERE NOT EXISTS "
                        "(SELECT 1 FROM dim_movies d WHERE d.movie_id = r.movie_id)"),
        "agg_basic": _q("SELECT movie_id, count(*) AS total_ratings, avg(rating) AS avg_rating, "
                        "min(rating) AS min_rating, max(rating) AS max_rating, "
                        "round(stddev_samp(rating), 6) AS stddev_rating FROM fact_ratings GROUP BY movie_id"),
        "agg_distinct": _q("SELECT user_id, count(DISTINCT movie_id) AS unique_movies_rated, "
                           "count(DISTINCT CAST(created_at AS DATE)) AS active_days "
                           "FROM fact_ratings GROUP BY user_id"),
        "agg_weighted": _q("SELECT d.genres, CAST(count(*) AS BIGINT) AS total_ratings, "
                           "sum(f.rating) / count(*) AS avg_rating FROM fact_ratings f "
                           "JOIN dim_movies d ON f.movie_id = d.movie_id GROUP BY d.genres"),
        "agg_string": _q("SELECT movie_id, array_to_string(list_sort(list_distinct(list(genres))), ', ') "
                         "AS all_genres, count(DISTINCT genres) AS genre_count "
                         "FROM dim_movies GROUP BY movie_id"),
        "agg_conditional": _q(
            "SELECT genres, "
            "count(*) FILTER (WHERE year >= 2020 AND year < 2030) AS movies_2020s, "
            "count(*) FILTER (WHERE year >= 2010 AND year < 2020) AS movies_2010s, "
            "count(*) FILTER (WHERE year >= 2000 AND year < 2010) AS movies_2000s, "
            "count(*) FILTER (WHERE year >= 1990 AND year < 2000) AS movies_1990s, "
            "count(*) FILTER (WHERE year < 1990) AS movies_before_1990 "
            "FROM dim_movies GROUP BY genres"),
        "win_count": _q("SELECT movie_id, genres, genre_count FROM dim_movies"),
        "win_top1": _q(
            "SELECT user_id, genres AS preferred_genre, cnt AS preferred_genre_count, "
            "avg_r AS preferred_genre_avg_rating FROM ("
            " SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY cnt DESC, avg_r DESC, "
            " genres ASC) AS rn FROM (SELECT f.user_id, d.genres, count(*) AS cnt, "
            " avg(f.rating) AS avg_r FROM fact_ratings f JOIN dim_movies d "
            " ON f.movie_id = d.movie_id GROUP BY f.user_id, d.genres) g) x WHERE rn = 1"),
        "sort_users": _q("SELECT user_id FROM dim_users ORDER BY user_id"),
        "set_union_distinct": _q("SELECT user_id FROM stg_ratings UNION SELECT user_id FROM stg_tags"),
        # reports
        "report_top_movies": _q(f"SELECT movie_id, title, total_ratings, avg_rating, quality_tier "
                                f"FROM ({mm}) m ORDER BY total_ratings DESC, movie_id LIMIT 20"),
        "report_quality_tiers": _q(f"SELECT quality_tier, count(*) AS movies, "
                                   f"CAST(sum(total_ratings) AS BIGINT) AS ratings "
                                   f"FROM ({mm}) m GROUP BY quality_tier"),
        "report_user_segments": _q(f"SELECT user_segment, rating_style, count(*) AS users, "
                                   f"CAST(sum(total_ratings) AS BIGINT) AS ratings "
                                   f"FROM ({um}) u GROUP BY user_segment, rating_style"),
        "report_genres": _q(f"SELECT genres, total_ratings, avg_rating, unique_raters, "
                            f"popularity_tier, quality_tier FROM ({gm}) g"),
        "report_preferred_genres": _q(f"SELECT preferred_genre, count(*) AS users "
                                      f"FROM ({um}) u GROUP BY preferred_genre"),
        # C1–C10
        "check_dim_movies_genre_count": _check(
            "dim_movies_genre_count_consistent",
            "SELECT count(*) AS inconsistent_movie_count FROM (SELECT movie_id, "
            "count(DISTINCT genres) AS a, min(genre_count) AS lo, max(genre_count) AS hi "
            "FROM dim_movies GROUP BY movie_id) g WHERE a <> lo OR lo <> hi",
            "inconsistent_movie_count = 0", ["inconsistent_movie_count"]),
        "check_fact_ratings_unique_key": _check(
            "fact_ratings_has_unique_business_key",
            "SELECT count(*) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT user_id, movie_id, "
            "created_at FROM fact_ratings) d) AS distinct_business_keys FROM fact_ratings",
            "total_rows = distinct_business_keys",
            ["total_rows", "distinct_business_keys",
             "total_rows - distinct_business_keys AS duplicate_rows"]),
        "check_fact_ratings_movie_fk": _check(
            "fact_ratings_has_valid_movie_keys",
            "SELECT count(*) AS orphan_movie_references FROM fact_ratings f WHERE NOT EXISTS "
            "(SELECT 1 FROM dim_movies d WHERE d.movie_id = f.movie_id)",
            "orphan_movie_references = 0", ["orphan_movie_references"]),
        "check_fact_tags_fk": _check(
            "fact_tags_has_valid_user_and_movie_keys",
            "SELECT (SELECT count(*) FROM fact_tags t WHERE NOT EXISTS (SELECT 1 FROM dim_movies d "
            "WHERE d.movie_id = t.movie_id)) AS orphan_movie_references, "
            "(SELECT count(*) FROM fact_tags t WHERE NOT EXISTS (SELECT 1 FROM dim_users u "
            "WHERE u.user_id = t.user_id)) AS orphan_user_references",
            "orphan_movie_references = 0 AND orphan_user_references = 0",
            ["orphan_movie_references", "orphan_user_references"]),
        "check_fmgr_preserves_totals": _check(
            "fact_movie_genre_ratings_preserves_exploded_rating_totals",
            "SELECT (SELECT count(*) FROM fact_ratings f JOIN dim_movies d ON f.movie_id = d.movie_id) "
            "AS expected_exploded_rating_total, (SELECT CAST(coalesce(sum(rating_count), 0) AS BIGINT) "
            "FROM fmgr) AS actual_rating_count_total",
            "expected_exploded_rating_total = actual_rating_count_total",
            ["expected_exploded_rating_total", "actual_rating_count_total"]),
        "check_movie_mart_row_count": _check(
            "mart_movie_analytics_matches_distinct_movies",
            f"SELECT (SELECT count(*) FROM (SELECT DISTINCT movie_id FROM fact_ratings) d) AS expected_rows, "
            f"(SELECT count(*) FROM ({mm}) m) AS actual_rows",
            "expected_rows = actual_rows", ["expected_rows", "actual_rows"]),
        "check_movie_mart_totals": _check(
            "mart_movie_analytics_preserves_rating_totals",
            f"SELECT (SELECT count(*) FROM fact_ratings) AS expected_total_ratings, "
            f"(SELECT CAST(coalesce(sum(total_ratings), 0) AS BIGINT) FROM ({mm}) m) AS actual_total_ratings",
            "expected_total_ratings = actual_total_ratings",
            ["expected_total_ratings", "actual_total_ratings"]),
        "check_user_mart_row_count": _check(
            "mart_user_behavior_matches_distinct_users",
            f"SELECT (SELECT count(*) FROM (SELECT DISTINCT user_id FROM fact_ratings) d) AS expected_rows, "
            f"(SELECT count(*) FROM ({um}) m) AS actual_rows",
            "expected_rows = actual_rows", ["expected_rows", "actual_rows"]),
        "check_genre_mart_row_count": _check(
            "mart_genre_performance_matches_distinct_genres",
            f"SELECT (SELECT count(*) FROM (SELECT DISTINCT genres FROM fmgr) d) AS expected_rows, "
            f"(SELECT count(*) FROM ({gm}) m) AS actual_rows",
            "expected_rows = actual_rows", ["expected_rows", "actual_rows"]),
        "check_genre_mart_set": _check(
            "mart_genre_performance_has_expected_genre_set",
            f"SELECT (SELECT count(*) FROM (SELECT genres FROM fmgr EXCEPT SELECT genres FROM ({gm}) a) x) "
            f"AS missing_genre_count, (SELECT count(*) FROM (SELECT genres FROM ({gm}) a EXCEPT "
            f"SELECT genres FROM fmgr) x) AS unexpected_genre_count, (SELECT count(*) FROM "
            f"(SELECT DISTINCT genres FROM fmgr) e) AS expected_genre_count, (SELECT count(*) FROM "
            f"(SELECT DISTINCT genres FROM ({gm}) a) b) AS actual_genre_count",
            "missing_genre_count = 0 AND unexpected_genre_count = 0",
            ["missing_genre_count", "unexpected_genre_count", "expected_genre_count",
             "actual_genre_count"]),
        "genre_set_diff": _q(
            f"SELECT coalesce(e.genres, a.genres) AS genres, CASE WHEN a.genres IS NULL THEN 'missing' "
            f"WHEN e.genres IS NULL THEN 'unexpected' END AS side, e.genres IS NOT NULL AS in_expected, "
            f"a.genres IS NOT NULL AS in_actual FROM (SELECT DISTINCT genres FROM fmgr) e "
            f"FULL OUTER JOIN (SELECT DISTINCT genres FROM ({gm}) g) a ON e.genres = a.genres"),
        # B3 / B9
        "merge_upsert": _q("SELECT user_id, movie_id, CASE WHEN year = 1999 THEN least(rating + 0.5, 5.0) "
                           "ELSE rating END AS rating, created_at, year FROM fact_ratings"),
        "backfill": _q("SELECT * FROM fact_ratings WHERE year IN (1995, 1996, 1998, 2000)"),
        # A14–A16
        "snap_mart_movie_analytics": _q(_rounded(scd2_sql(
            movie_mart("fact_ratings_t1", T1_SQL), movie_mart("fact_ratings", T2_SQL),
            "movie_id", ["total_ratings", "avg_rating", "quality_tier"])), FR_T1),
        "snap_mart_user_behavior": _q(_rounded(scd2_sql(
            user_mart("fact_ratings_t1", T1_SQL), user_mart("fact_ratings", T2_SQL),
            "user_id", ["total_ratings", "user_segment"])), FR_T1),
        "snap_mart_genre_performance": _q(_rounded(scd2_sql(
            genre_mart("fact_ratings_t1", T1_SQL), genre_mart("fact_ratings", T2_SQL),
            "genres", ["total_ratings", "avg_rating", "popularity_tier"])), FR_T1),
    }
    known = "user_id IN (SELECT user_id FROM stg_tags)"
    q |= {
        "fact_ratings_known_users": _q(f"SELECT * FROM fact_ratings WHERE {known}"),
        "fact_tags_known_users": _q("SELECT * FROM fact_tags WHERE user_id IN (SELECT user_id FROM stg_ratings)"),
        "mart_user_behavior_known_users": _q(_rounded(f"SELECT * FROM ({um}) u WHERE {known}")),
        "store_merge_upsert": _q(
            "SELECT user_id, movie_id, CASE WHEN year = 1999 THEN least(rating + 0.5, 5.0) ELSE rating END AS rating, "
            "created_at, year, CASE WHEN year >= 1999 THEN year = 1999 END AS corrected FROM fact_ratings "
            "UNION ALL SELECT user_id, movie_id, rating, NULL, NULL, NULL FROM ("
            "SELECT DISTINCT user_id, movie_id, rating FROM fact_ratings WHERE user_id = 1 AND year BETWEEN 1995 AND 1999) d "
            "CROSS JOIN (SELECT unnest([1, 2]) AS i) t"),
        "store_backfill": q["backfill"],
        "store_snapshot_movie": q["snap_mart_movie_analytics"],
        "store_snapshot_user": q["snap_mart_user_behavior"],
        "store_snapshot_genre": q["snap_mart_genre_performance"],
        "store_refresh_and_append": _q("SELECT * FROM fact_ratings WHERE year IN (1995, 1996) UNION ALL "
                                       "SELECT * FROM fact_ratings WHERE year IN (1996, 1997)"),
        "register_tables": q["mart_genre_performance"],
    }
    t0 = "TIMESTAMP '2024-09-01 00:00:00'"
    snap_t0 = scd2_steps([(movie_mart("fact_ratings_t1", T1_SQL), T1_SQL), (movie_mart("fact_ratings_t0", t0), t0),
                          (movie_mart("fact_ratings", T2_SQL), T2_SQL)], "movie_id", ["total_ratings", "avg_rating", "quality_tier"])
    fr_t0 = "fact_ratings_t0 AS (SELECT * FROM fact_ratings WHERE year BETWEEN 1995 AND 2000)"
    genre_t1 = genre_mart("fact_ratings_t1", T1_SQL)
    genre_hist = scd2_sql(genre_t1, genre_mart("fact_ratings", T2_SQL), "genres", ["total_ratings", "avg_rating", "popularity_tier"])
    n, none = "(SELECT count(*) FROM {})", "CAST(NULL AS BIGINT)"
    movies, users, tags, ratings, first, later = (n.format(t) for t in (
        "stg_movies", "dim_users", "fact_tags", "fact_ratings", "fact_ratings_t1", "fact_ratings WHERE year >= 1999"))
    hist = [f"SELECT count(*) FROM ({genre_hist}) h", f"SELECT count(*) FROM ({genre_hist}) h WHERE is_current",
            f"SELECT count(*) FROM ({genre_hist}) h WHERE NOT is_current", f"SELECT count(*) FROM ({genre_t1}) g"]
    reports = [("stg_movies", movies, none, none, none), ("stg_movies", movies, none, none, none), ("dim_users", users, none, none, none),
               ("fact_ratings", first, first, none, none), ("fact_ratings", ratings, later, none, none),
               ("fact_tags", tags, none, none, none), ("fact_tags", f"2 * {tags}", tags, none, none),
               ("mart_genre_performance", f"(SELECT count(*) FROM ({gm}) g)", none, none, none),
               ("snap_mart_genre_performance", f"({hist[3]})", none, f"({hist[3]})", "CAST(0 AS BIGINT)"),
               ("snap_mart_genre_performance", f"({hist[0]})", none, f"({hist[1]})", f"({hist[2]})")]
    q |= {
        "store_snapshot_out_of_order": _q(_rounded(snap_t0), f"{FR_T1}, {fr_t0}"),
        "store_correction": _q("SELECT user_id, movie_id, CASE WHEN user_id = 1 THEN 0.5 ELSE rating END AS rating, created_at, year FROM fact_ratings"),
        "store_late_users": q["fact_ratings"],
        "load_reports": _q(" UNION ALL ".join(
            f"SELECT {i} AS step, '{t}' AS \"table\", {a} AS row_count, {b} AS rows_touched, {c} AS current_rows, {d} AS closed_rows"
            for i, (t, a, b, c, d) in enumerate(reports)), FR_T1),
        "register_evolved": _q("SELECT *, CASE WHEN year >= 1999 THEN year > 1999 END AS late FROM fact_ratings"),
    }
    for mart in ("mart_movie_analytics", "mart_user_behavior", "mart_genre_performance"):
        q[f"register_{mart}"] = q[f"maintained_{mart}"] = q[mart]
        q[f"register_snap_{mart}"] = q[f"snap_{mart}"]
    for name in ("movies", "links", "ratings", "tags"):
        q[f"land_raw_{name}"] = _q(f"SELECT * FROM raw_{name}")
        q[f"check_bronze_{name}"] = _q(
            f"SELECT 'bronze_{name}_has_data' AS \"check\", count(*) > 0 AS passed, "
            f"count(*) AS row_count, TRUE AS has_bytes, TRUE AS has_path FROM raw_{name}")
    return q
