"""Check SQL of the whole-catalogue reports, written from their lists of relations and checks."""

from __future__ import annotations

from catalogmart.plans import layers, public, quality, validate
from workload.relations_sql import ROLE_FLOOR


def _counts(parts: list[tuple[str, str]], label: str) -> str:
    return "\nUNION ALL\n".join(f"SELECT '{name}' AS {label}, count(*) AS violations {body}" for name, body in parts)


def _union(selects) -> str:
    return "FROM (" + " UNION ALL ".join(selects) + ")"


def _column_tests():
    for relation, columns in quality.COLUMN_TESTS.items():
        for column, tests in columns.items():
            if "N" in tests:
                yield f"not_null {relation}.{column}", f"FROM {relation} WHERE {column} IS NULL"
            if "U" in tests:
                known = f"FROM {relation} WHERE {column} IS NOT NULL"
                yield f"unique {relation}.{column}", _union([f"SELECT {column} {known} GROUP BY 1 HAVING count(*) > 1"])


def _relation_tests():
    for (relation, column), accepted in quality.ACCEPTED_VALUES.items():
        outside = f"SELECT {column} FROM {relation} WHERE {column} NOT IN {accepted} GROUP BY 1"
        yield f"accepted_values {relation}.{column}", _union([outside])
    for (relation, column), (parent, field) in quality.REFERENCES.items():
        known = f"{column} IS NOT NULL AND {column} NOT IN (SELECT {field} FROM {parent})"
        yield f"relationships {relation}.{column}", f"FROM {relation} WHERE {known}"
    for relation, keys in quality.COMPOSITE_KEYS.items():
        repeated = f"SELECT {', '.join(keys)} FROM {relation} GROUP BY ALL HAVING count(*) > 1"
        yield f"unique_key {relation}", _union([repeated])


def _invariants():
    fact = "FROM fct_movie_ratings"
    rating, votes = "unnest([imdb_avg_rating, tmdb_avg_rating])", "unnest([imdb_num_of_votes, tmdb_num_of_votes])"
    yield "rating_range", _union([f"SELECT {rating} AS r {fact}"]) + " WHERE r NOT BETWEEN 0 AND 10"
    yield "votes_nonnegative", _union([f"SELECT {votes} AS v {fact}"]) + " WHERE v < 0"
    labels = [f"SELECT genre_name FROM {relation}" for relation in quality.LABEL_SCOPE]
    yield "label_excluded", _union(labels) + " WHERE lower(trim(genre_name)) = 'news'"
    by_imdb = [
        f"SELECT imdb_id AS id FROM {relation} WHERE imdb_id IN (SELECT imdb_id FROM excluded_imdb)"
        for relation in quality.EXCLUSION_SCOPE
        if relation != "stg_now_playing"
    ]
    by_tmdb = [
        f"SELECT cast(tmdb_id AS varchar) FROM {relation} WHERE tmdb_id IN (SELECT tmdb_id FROM excluded_tmdb)"
        for relation in quality.EXCLUSION_SCOPE
        if not relation.startswith("stg_title")
    ]
    yield "ids_excluded", _union(by_imdb + by_tmdb)
    places = [
        "SELECT movie_rank AS stored, row_number() OVER (ORDER BY avg_rating DESC NULLS LAST, "
        "num_of_votes DESC NULLS LAST, movie_id) AS place FROM mart_top_movies",
        "SELECT job_rank, row_number() OVER (PARTITION BY job_role ORDER BY person_rating DESC NULLS LAST, person_id) "
        "FROM mart_top_people",
    ]
    yield "rank_order", _union(places) + " WHERE stored <> place"
    bins = "bucket_order NOT BETWEEN 0 AND 9 OR rating_bracket IS NULL"
    yield "histogram", f"FROM mart_rating_distribution WHERE {bins}"


def declared_tests_sql() -> str:
    """(test, violations) of every declared data test."""
    return _counts([*_column_tests(), *_relation_tests(), *_invariants()], "test")


def observed_counts_sql(relations) -> str:
    """(metric, n): rows of the relations and the violations that single rows show."""
    parts = [(f"rows {relation}", f"FROM {relation}") for relation in relations]
    parts += [(name, body) for name, body in _column_tests() if name.startswith("not_null") and name.split(" ")[1].split(".")[0] in relations]
    for (relation, column), accepted in quality.ACCEPTED_VALUES.items():
        parts.append((f"accepted_values {relation}.{column}", f"FROM {relation} WHERE {column} NOT IN {accepted}"))
    parts.append(("label_excluded bridge_movie_genres", "FROM bridge_movie_genres WHERE lower(trim(genre_name)) = 'news'"))
    parts += [(name, body) for name, body in _invariants() if name in ("rating_range", "votes_nonnegative")]
    return f"SELECT metric, violations AS n FROM ({_counts(parts, 'metric')})"


# The published order of every list, and what its ranks restart within.
LIST_ORDER = {
    "top_years": ("year", "", "avg_rating DESC NULLS LAST, year"),
    "top_movies": ("movie_id", "", "rating DESC NULLS LAST, votes DESC NULLS LAST, movie_id"),
    "people": ("person_id", "role", "avg_rating DESC NULLS LAST, person_id"),
    "recommendations": (
        "movie_id", "region",
        "rating DESC NULLS LAST, votes DESC NULLS LAST, popularity DESC NULLS LAST, movie_id, rank",
    ),
    "rating_bins": ("\"order\"", "", "\"order\""),
    "genre_ratings": ("genre", "", "avg_rating DESC NULLS LAST, genre"),
    "genre_runtimes": ("genre", "", "avg_runtime_minutes DESC NULLS LAST, genre"),
    "decade_counts": ("decade", "", "decade"),
    "decade_ratings": ("decade", "", "decade"),
    "region_counts": ("region", "", "region"),
}

# What the faulty copy of the public results changes: a SELECT per result set.
FAULTS = {
    "total_movies": "SELECT * FROM public_total_movies UNION ALL SELECT * FROM public_total_movies",
    "rated_movies": "SELECT rated_movies * 3 AS rated_movies FROM public_rated_movies",
    "avg_rating": "SELECT avg_rating + 10 AS avg_rating FROM public_avg_rating",
    "highest_rated_movie": "SELECT * REPLACE ('' AS movie_id) FROM public_highest_rated_movie",
    "rating_bins": """SELECT * REPLACE (movie_count + CASE WHEN "order" = 2 THEN 1 ELSE 0 END AS movie_count)
        FROM public_rating_bins""",
    "genre_ratings": """SELECT * REPLACE (CASE WHEN length(genre) % 2 = 0 THEN avg_rating - 20 ELSE avg_rating END
        AS avg_rating) FROM public_genre_ratings""",
    "decade_counts": """SELECT * REPLACE (CASE WHEN decade = '1990s' THEN '1700s' ELSE decade END AS decade)
        FROM public_decade_counts""",
    "top_years": "SELECT * REPLACE (rank + year % 2 AS rank) FROM public_top_years",
    "top_movies": "SELECT * REPLACE (votes + 0.5e0 AS votes) FROM public_top_movies",
    "people": "SELECT * REPLACE (movie_count - 2 AS movie_count) FROM public_people",
    "region_counts": """SELECT * REPLACE (CASE region WHEN 'IN' THEN 'FR' ELSE region END AS region)
        FROM public_region_counts""",
    "recommendations": """SELECT * REPLACE (CASE WHEN rank = 2 THEN '2024-02-30' ELSE strftime(release_date, '%Y-%m-%d')
        END AS release_date) FROM public_recommendations""",
    "latest_snapshot_date": """SELECT cast(latest_snapshot_date + INTERVAL 1 DAY AS date) AS latest_snapshot_date
        FROM public_latest_snapshot_date""",
    "captures": """SELECT * REPLACE (cast(CASE region WHEN 'US' THEN min_capture_date - INTERVAL 1 DAY
        ELSE min_capture_date END AS date) AS min_capture_date) FROM public_captures""",
}


def _results(faulty: bool) -> str:
    """The result sets as r_ relations; unranked lists with the position their true order gives."""
    ctes = []
    for name in public.RESULT_NAMES:
        text = FAULTS.get(name, f"SELECT * FROM public_{name}") if faulty else f"SELECT * FROM public_{name}"
        if name in validate.LISTED_BY:
            order = ", ".join(validate.LISTED_BY[name])
            key = {"top_years": "year", "top_movies": "movie_id", "people": "person_id, role", "recommendations": "region, rank"}[name]
            text = f"""SELECT f.*, p.position FROM ({text}) f JOIN (SELECT {key}, row_number() OVER (ORDER BY {order})
        AS position FROM public_{name}) p USING ({key})"""
        if name in validate.UNRANKED_LISTS:
            key, _, order = LIST_ORDER[name]
            was = {"region_counts": "CASE region WHEN 'IN' THEN 'FR' ELSE region END", "decade_counts":
                   "CASE WHEN decade = '1990s' THEN '1700s' ELSE decade END"}.get(name, key) if faulty else key
            text = f"""SELECT f.*, p.position FROM ({text}) f JOIN (SELECT {was} AS k, row_number() OVER (ORDER BY {order})
        AS position FROM public_{name}) p ON f.{key} = p.k"""
        ctes.append(f"r_{name} AS ({text})")
    return "WITH " + ",\n".join(ctes)


def _field_tests(name: str) -> str:
    """Every broken constraint of a result set's fields, as rows."""
    found = []
    for rule in public.FIELD_RULES[name]:
        c, number = f'"{rule.field}"', f'try_cast("{rule.field}" AS double)'
        tests = [] if rule.nullable else [f"{c} IS NULL"]
        tests += [f"{number} <> floor({number}) OR ({c} IS NOT NULL AND {number} IS NULL)"] if rule.integer else []
        tests += [f"isnan({number}) OR isinf({number})"] if rule.integer or rule.finite else []
        tests += [f"{c} < {rule.low}"] if rule.low is not None else []
        tests += [f"{c} > {rule.high}"] if rule.high is not None else []
        tests += [f"{c} NOT IN ({', '.join(repr(v) for v in rule.values)})"] if rule.values is not None else []
        tests += [f"NOT regexp_matches({c}, '{rule.pattern}')"] if rule.pattern is not None else []
        tests += [f"length({c}) < {rule.min_length}"] if rule.min_length is not None else []
        tests += [f"length({c}) > {rule.max_length}"] if rule.max_length is not None else []
        found += [f"SELECT 1 FROM r_{name} WHERE {test}" for test in tests]
    return "FROM (" + " UNION ALL ".join(found) + ")"


_BINS = """FROM (
  SELECT bracket FROM r_rating_bins WHERE bracket <> "order" || '-' || ("order" + 1)
  UNION ALL SELECT bracket FROM r_rating_bins WHERE "order" NOT BETWEEN 0 AND 9 OR population_count = 0
  UNION ALL SELECT bracket FROM r_rating_bins
    WHERE population_count > 0 AND abs(percentage - movie_count * 100.0e0 / population_count) > 0.0051
  UNION ALL SELECT min(bracket) FROM r_rating_bins GROUP BY "order" HAVING count(*) > 1
  UNION ALL SELECT bracket FROM r_rating_bins GROUP BY bracket HAVING count(*) > 1
  UNION ALL SELECT NULL FROM r_rating_bins HAVING min(population_count) <> max(population_count)
  UNION ALL SELECT NULL FROM r_rating_bins HAVING coalesce(sum(movie_count), 0) <> coalesce(max(population_count), 0)
  UNION ALL SELECT NULL FROM r_rating_bins HAVING abs(sum(percentage) - 100) > 0.051)"""
_ROLES = f"""FROM (SELECT job_role FROM (SELECT role AS job_role, movie_count FROM r_people)
  GROUP BY job_role HAVING count(*) > 20 OR count_if(movie_count < {ROLE_FLOOR}) > 0)"""
_REGIONS = """FROM (
  SELECT coalesce(s.region, c.region, l.region) AS region FROM (SELECT unnest(['IN', 'US']) AS region) s
  FULL JOIN r_region_counts c ON s.region = c.region
  FULL JOIN (SELECT region, count(*) AS n FROM r_recommendations GROUP BY region) l
    ON l.region = coalesce(s.region, c.region)
  WHERE s.region IS NULL OR c.movie_count IS NULL OR c.movie_count < 1 OR coalesce(l.n, 0) > c.movie_count)"""
_CAPTURES = """FROM (
  SELECT 1 FROM (SELECT unnest(['IN', 'US']) AS region) s
  FULL JOIN r_captures k ON s.region = k.region
  FULL JOIN r_region_counts c ON c.region = coalesce(s.region, k.region)
  WHERE NOT coalesce(s.region IS NOT NULL AND row_count > 0 AND row_count = unique_movie_count
                     AND row_count = capture_date_count AND row_count = movie_count, false)
     OR NOT coalesce(min_capture_date = max_capture_date, false))"""
_POPULATIONS = """FROM (SELECT coalesce((SELECT max(population_count) FROM r_rating_bins), 0) AS a,
  coalesce((SELECT max(rated_movies) FROM r_rated_movies), 0) AS b,
  coalesce((SELECT max(total_movies) FROM r_total_movies), 0) AS c) WHERE a > b OR b > c"""
_LATEST = """FROM (SELECT (SELECT max(latest_snapshot_date) FROM r_latest_snapshot_date) AS a,
  (SELECT max(max_capture_date) FROM r_captures) AS b) WHERE a IS DISTINCT FROM b"""


def contract_report_sql(faulty: bool = False) -> str:
    """(check, violations) of every contract check, of the public results or of their faulty copy."""
    parts = [
        (f"one_row {name}", f"FROM (SELECT count(*) AS n FROM r_{name}) WHERE n {test}")
        for names, test in ((validate.SCALARS, "<> 1"), (validate.HIGHLIGHTS, "> 1"))
        for name in names
    ]
    for name, (identity, within, order) in LIST_ORDER.items():
        keys = f"{within}, {identity}" if within else identity
        parts.append((f"identity {name}", f"FROM (SELECT 1 FROM r_{name} GROUP BY {keys} HAVING count(*) > 1)"))
        kind, column = ("order", "position") if name in validate.UNRANKED_LISTS else ("ranks", "rank")
        over = (f"PARTITION BY {within} " if within else "") + f"ORDER BY {order}"
        places = f"SELECT {column} AS stored, row_number() OVER ({over}) AS place FROM r_{name}"
        parts.append((f"{kind} {name}", f"FROM ({places}) WHERE stored IS DISTINCT FROM place"))
    for name, columns in validate.LISTED_BY.items():
        places = f"SELECT position AS stored, row_number() OVER (ORDER BY {', '.join(columns)}) AS place FROM r_{name}"
        parts.append((f"order {name}", f"FROM ({places}) WHERE stored IS DISTINCT FROM place"))
    out = "-" if faulty else "+"
    clock = f"cast(max(max_capture_date) AS timestamp) AS done, cast(max(max_capture_date) AS timestamp) {out} INTERVAL 30 MINUTE AS out"
    parts.append(("sequence", f"FROM (SELECT {clock} FROM r_captures) WHERE done > out"))
    for name, columns in validate.DATES.items():
        bad = [f"SELECT 1 FROM r_{name} WHERE {c} IS NOT NULL AND try_cast({c} AS date) IS NULL" for c in columns]
        parts.append((f"dates {name}", _union(bad)))
    parts += [("populations", _POPULATIONS), ("bins", _BINS), ("roles", _ROLES), ("regions", _REGIONS)]
    parts += [("captures", _CAPTURES), ("latest", _LATEST)]
    parts += [(f"fields {name}", _field_tests(name)) for name in public.FIELD_RULES]
    return _results(faulty) + "\n" + _counts(parts, '"check"')


def built_layers_sql() -> str:
    """(relation, row_count) of every curated and analytics relation."""
    names = layers.CURATED + layers.ANALYTICS
    return "\nUNION ALL\n".join(f"SELECT '{n}' AS relation, count(*) AS row_count FROM {n}" for n in names)
