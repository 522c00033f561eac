"""Every registered query: a Spark function and, next to it, its check SQL.

Queries read whole given tables, every row of them. Checks run on naturally dirty raw relations or
on results with stated faults, so that they have something to find.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogmart.functions.public_text import multiset_digest, normalize_scalars
from catalogmart.functions.rules import ROLE_MINIMUMS
from catalogmart.functions.text import LENIENT_JSON, NAMED_TAGS, comma_elements, has_token
from catalogmart.operators import checks, contract, exclusion
from catalogmart.operators.joins import dealt, without
from catalogmart.operators.sketches import hot_keys, id_filter, maybe_among, parts_of_hot_keys
from catalogmart.plans import kpis, layers, marts, present, public, quality, staging, validate
from catalogmart.plans.build import Catalogue
from catalogmart.sources import payloads
from catalogmart.sources.bounded import bounded_select
from catalogmart.sources.readers import scan_raw
from catalogmart.sources.tables import EmptyLoadError, Replacement, guarded_replace
from catalogmart.sources.versions import ConcurrentLoadError
from workload.raw import Given
from workload.relations_sql import ROLE_FLOOR, with_query
from workload.report_sql import built_layers_sql, contract_report_sql, declared_tests_sql, observed_counts_sql

SPARK: dict[str, Callable[[Catalogue], DataFrame]] = {}
SQL: dict[str, str] = {}
_CATALOGUES: dict[tuple, Catalogue] = {}


def _state(spark: SparkSession, folder: str) -> tuple:
    """Name, length and time of every file of the given tables."""
    files = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    found, seen = files.listFiles(spark._jvm.org.apache.hadoop.fs.Path(folder), True), []
    while found.hasNext():
        status = found.next()
        seen.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(seen))


def catalogue(spark: SparkSession, folder: str) -> Catalogue:
    """The folder's catalogue, built once per application and state of the files, and shared by all queries."""
    key = (spark.sparkContext.applicationId, folder, _state(spark, folder))
    if key not in _CATALOGUES:
        _CATALOGUES[key] = Catalogue(spark, Given(spark, folder))
    return _CATALOGUES[key]


def query(key: str, sql: str):
    def register(plan):
        SPARK[key] = plan
        SQL[key] = with_query(sql)
        return plan

    return register


def relation(key: str, name: str) -> None:
    """A query that is one catalogue relation."""
    query(key, f"SELECT * FROM {name}")(lambda c: getattr(c, name))


# Sources, sinks, loads ---------------------------------------------------------
def _scratch(c: Catalogue, name: str) -> str:
    return f"{c.kept.folder}/{name}-{uuid.uuid4().hex}"


@query("scan_tsv", "SELECT * FROM raw_title_basics")
def _(c):
    path = _scratch(c, "title_basics.tsv")
    c.raw["title_basics"].write.csv(
        path,
        sep="\t",
        header=True,
        nullValue="\\N",
        quote="",
        compression="gzip",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return scan_raw(c.raw.spark, "title_basics", path)


def _written_details(c) -> str:
    path = _scratch(c, "details.csv")
    c.raw["details"].write.csv(
        path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return path


@query("scan_csv", "SELECT * FROM raw_details")
def _(c):
    return scan_raw(c.raw.spark, "details", _written_details(c))


@query("scan_csv_ranges", "SELECT * FROM raw_details")
def _(c):
    """The same files, each read by as many tasks as it has ranges."""
    return scan_raw(c.raw.spark, "details", _written_details(c), in_ranges=True)


COMPACT_GENRES = """replace(replace(replace(genres, '": ', '":'), ', "', ',"'), '}, {', '},{')"""


def _detail_payloads(c):
    """Payload text per title; every seventh lacks its title, unknown fields are absent."""
    row = c.raw["details"].withColumns(
        {
            "title": F.when(F.col("id") % 7 != 0, F.col("title")),
            "release_date": F.col("release_date").cast("string"),
            "genres": F.from_json("genres", NAMED_TAGS, LENIENT_JSON),
            "origin_country": F.from_json("origin_country", "array<string>"),
        }
    ).drop("production_companies", "production_countries")
    return row.select("id", F.to_json(F.struct(*row.columns)).alias("payload"))


@query(
    "flatten_details",
    f"""
SELECT id, imdb_id, title, budget, revenue, release_date, runtime, status, original_language, origin_country,
       '[]' AS production_countries, '[]' AS production_companies, coalesce({COMPACT_GENRES}, '[]') AS genres,
       vote_average, vote_count, poster_path
FROM raw_details WHERE id % 7 <> 0""",
)
def _(c):
    return payloads.flatten_details(_detail_payloads(c).select("payload"))


@query("rejected_details", "SELECT id FROM raw_details WHERE id % 7 = 0")
def _(c):
    return payloads.rejected_details(_detail_payloads(c)).select("id")


@query(
    "flatten_genres",
    """SELECT unnest(from_json(genres, '[{"id":"BIGINT","name":"VARCHAR"}]'), recursive := true) FROM raw_details""",
)
def _(c):
    texts = c.raw["details"].select(F.concat(F.lit('{"genres": '), "genres", F.lit("}")).alias("payload"))
    return payloads.flatten_genres(texts)


@query(
    "flatten_now_playing",
    """
SELECT id, title, release_date, vote_average, vote_count, replace(genre_ids, ' ', '') AS genre_ids, overview,
       poster_path, popularity, region, date '2024-02-01' AS snapshot_date FROM raw_now_playing
UNION ALL
SELECT id + 1, title, NULL, vote_average, vote_count, replace(genre_ids, ' ', ''), overview, poster_path, popularity,
       region, date '2024-02-01' FROM raw_now_playing""",
)
def _(c):
    """Each listing row lands as a page of two results; the second has a blank release date."""
    items = ["id", "title", "release_date", "vote_average", "vote_count", "genre_ids", "popularity"]
    row = c.raw["now_playing"].withColumns(
        {
            "release_date": F.col("release_date").cast("string"),
            "genre_ids": F.from_json("genre_ids", "array<bigint>"),
        }
    )
    first = F.struct(*items)
    second = F.struct(
        (F.col("id") + 1).alias("id"), "title", F.lit("").alias("release_date"), *[F.col(i) for i in items[3:]]
    )
    page = F.to_json(F.struct(F.array(first, second).alias("results")))
    return payloads.flatten_listing(row.select("region", page.alias("payload")), F.lit("2024-02-01").cast("date"))


def _landed_pages(c):
    """Each listing row as a page of a region with one result; some pages are damaged, lost, or lack an id."""
    row = c.raw["now_playing"].select("id", "title", "region")
    bounds = row.groupBy("region").agg(F.min("id").alias("_low"), F.countDistinct("id").alias("_pages"))
    number = ((F.col("id") - F.col("_low")) / 4 + 1).cast("bigint")
    placed = row.dropDuplicates(["id", "region"]).join(bounds, "region").withColumn("page", number)
    item = F.struct(F.when(F.col("page") % 11 != 0, F.col("id")).alias("id"), "title")
    text = F.to_json(F.struct("page", F.col("_pages").alias("total_pages"), F.array(item).alias("results")))
    payload = F.when(F.col("page") % 7 == 0, F.substring(text, 1, 20)).otherwise(text)
    return placed.select("region", "page", payload.alias("payload")).filter("page % 5 <> 0").drop("page")


LANDED_PAGES = """
WITH listed AS (SELECT DISTINCT id, region FROM raw_now_playing),
pages AS (
  SELECT region, (id - min(id) OVER w) // 4 + 1 AS page, count(*) OVER w AS total FROM listed
  WINDOW w AS (PARTITION BY region)),
landed AS (SELECT * FROM pages WHERE page % 5 <> 0)"""


@query(
    "rejected_pages",
    f"""{LANDED_PAGES}
SELECT region, CASE WHEN page % 7 = 0 THEN 'unreadable' ELSE 'bad_item' END AS issue, count(*) AS pages
FROM landed WHERE page % 7 = 0 OR page % 11 = 0 GROUP BY ALL""",
)
def _(c):
    return payloads.rejected_pages(_landed_pages(c)).groupBy("region", "issue").agg(F.count(F.lit(1)).alias("pages"))


@query(
    "missing_pages",
    f"""{LANDED_PAGES}
SELECT region, page FROM (
  SELECT region, unnest(range(1, max(total) + 1)) AS page FROM landed WHERE page % 7 <> 0 GROUP BY region) e
WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.region = e.region AND l.page = e.page AND l.page % 7 <> 0)""",
)
def _(c):
    return payloads.missing_pages(_landed_pages(c))


@query(
    "listing_faults",
    f"""{LANDED_PAGES},
us AS (SELECT page, page % 13 = 0 AS unnumbered, page % 17 = 0 AS absurd, total FROM landed WHERE region = 'US'),
whole AS (SELECT * FROM us WHERE page % 7 <> 0),
numbers AS (SELECT DISTINCT page FROM whole WHERE NOT unnumbered UNION ALL SELECT max(total) + 1 FROM us),
stretches AS (SELECT coalesce(lag(page) OVER (ORDER BY page), 0) + 1 AS first_page, page - 1 AS last_page FROM numbers)
SELECT 'US' AS region, 'missing' AS issue, first_page, last_page, last_page - first_page + 1 AS pages
FROM stretches WHERE first_page <= last_page
UNION ALL SELECT * FROM (SELECT 'US', 'unnumbered', NULL, NULL, count_if(unnumbered) FROM whole) WHERE #5 > 0
UNION ALL SELECT * FROM (SELECT 'US', 'page_count', NULL, NULL, count_if(absurd) FROM whole) WHERE #5 > 0
UNION ALL SELECT 'US', 'unreadable', NULL, NULL, count(*) FROM us WHERE page % 7 = 0 HAVING count(*) > 0
UNION ALL SELECT 'US', 'bad_item', NULL, NULL, count(*) FROM whole WHERE page % 11 = 0 HAVING count(*) > 0
UNION ALL SELECT 'IN', 'unreadable', NULL, NULL, count(*) FROM landed WHERE region = 'IN'
UNION ALL SELECT unnest(['IN', 'CA']), 'no_readable_page', NULL, NULL, 0""",
)
def _(c):
    """The landed pages with one region wholly damaged, another never landed, pages without a number and absurd counts."""
    text = F.col("payload")
    number = F.get_json_object(text, "$.page").cast("bigint")
    text = F.when(number % 13 == 0, F.regexp_replace(text, '"page":', '"leaf":')).otherwise(text)
    absurd = F.regexp_replace(text, r'"total_pages":\d+', '"total_pages":1000000000000')
    damaged = F.when(F.col("region") == "IN", F.substring(text, 1, 12)).when(number % 17 == 0, absurd).otherwise(text)
    pages = _landed_pages(c).withColumn("payload", damaged)
    return payloads.listing_faults(pages, ("US", "IN", "CA"))


@query("enrichment_keys", "SELECT DISTINCT id FROM raw_now_playing")
def _(c):
    return payloads.enrichment_keys(c.raw["now_playing"])


@query("enrichment_gaps", "SELECT DISTINCT id FROM raw_now_playing WHERE id NOT IN (SELECT tmdb_id FROM stg_details)")
def _(c):
    """Listed titles that staging leaves without details."""
    return payloads.enrichment_gaps(c.raw["now_playing"], c.stg_details.withColumnRenamed("tmdb_id", "id"))


@query("guarded_replace", "SELECT * FROM raw_title_ratings")
def _(c):
    """A partial load, an empty one that must change nothing, then the full replacement."""
    loads = c.raw["title_ratings"]
    table, folder = f"title_ratings_{uuid.uuid4().hex}", _scratch(c, "title_ratings")
    guarded_replace(loads.filter("numvotes < 1000"), table, folder)
    try:
        guarded_replace(loads.filter("numvotes < 0"), table, folder)
    except EmptyLoadError:
        return guarded_replace(loads, table, folder)
    raise AssertionError("an empty load replaced the table")


@query(
    "concurrent_replace",
    """
SELECT 'live' AS seen, * FROM raw_title_ratings
UNION ALL SELECT 'first version', * FROM raw_title_ratings WHERE numvotes < 1000""",
)
def _(c):
    """Two loads that begin together: one is refused, and begins again after the other; a reader keeps what it read first."""
    loads, spark = c.raw["title_ratings"], c.raw.spark
    table, folder = f"title_ratings_{uuid.uuid4().hex}", _scratch(c, "title_ratings")
    reader = guarded_replace(loads.filter("numvotes < 1000"), table, folder)
    one, other = Replacement(spark, table, folder), Replacement(spark, table, folder)
    other.publish(loads.filter("numvotes < 2000"))
    try:
        one.publish(loads)
    except ConcurrentLoadError:
        live = Replacement(spark, table, folder).publish(loads)
        return live.select(F.lit("live").alias("seen"), "*").unionAll(reader.select(F.lit("first version"), "*"))
    raise AssertionError("two loads replaced the same version")


@query("bounded_select", "SELECT titletype AS kind, count(*) AS titles FROM raw_title_basics GROUP BY 1")
def _(c):
    kinds = c.raw["title_basics"].groupBy("titletype").agg(F.count(F.lit(1)).alias("n"))
    return bounded_select(kinds, "kinds", [("kind", "titletype"), ("titles", "n")], [F.col("titletype")], maximum=3)


# Staging -----------------------------------------------------------------------
relation("stg_names", "stg_name_basics")
relation("stg_akas", "stg_title_akas")
relation("stg_titles", "stg_title_basics")
relation("stg_crew", "stg_title_crew")
relation("stg_principals", "stg_title_principals")
relation("stg_ratings", "stg_title_ratings")
relation("stg_details", "stg_details")
relation("stg_genres", "stg_genres")
relation("latest_per_key", "stg_now_playing")


# Exclusion ---------------------------------------------------------------------
@query(
    "token_match",
    r"""
SELECT tconst, regexp_matches(coalesce(genres, ''), '(^|,)\s*news\s*(,|$)', 'i') AS is_news FROM raw_title_basics""",
)
def _(c):
    return c.raw["title_basics"].select("tconst", has_token(F.col("genres"), "news").alias("is_news"))


@query("json_object_tags", "SELECT tmdb_id FROM tagged_objects")
def _(c):
    return exclusion.tagged_by_name(c.raw["details"]).distinct()


@query("json_id_tags", "SELECT tmdb_id FROM tagged_listings")
def _(c):
    return exclusion.tagged_by_id(c.raw["now_playing"], c.raw["genres"]).distinct()


@query(
    "excluded_ids",
    """
SELECT imdb_id, cast(NULL AS bigint) AS tmdb_id FROM excluded_imdb
UNION ALL
SELECT cast(NULL AS varchar) AS imdb_id, tmdb_id FROM excluded_tmdb""",
)
def _(c):
    return exclusion.tagged_union(c.excluded)


@query(
    "anti_join_exclusion",
    """
SELECT id, d.imdb_id FROM raw_details d
WHERE NOT EXISTS (SELECT 1 FROM excluded_imdb e WHERE e.imdb_id = d.imdb_id)""",
)
def _(c):
    return without(c.raw["details"].select("id", "imdb_id"), c.excluded.imdb, "imdb_id")


# Curated -----------------------------------------------------------------------
relation("merge_catalog", "dim_movies")
relation("dim_person", "dim_person")
relation("genre_dimension", "dim_genre")
relation("genre_bridge", "bridge_movie_genres")
relation("people_bridge", "bridge_movie_people")
relation("ratings_fact", "fct_movie_ratings")
relation("now_playing_fact", "fct_now_playing")

# Marts and KPIs ----------------------------------------------------------------
relation("avg_rating_by_genre", "average_rating_by_genre")
relation("avg_runtime_by_genre", "average_runtime_by_genre")
relation("avg_rating_by_decade", "decade_avg_rating")
relation("titles_by_decade", "no_of_movies_every_decade")
relation("rating_distribution", "mart_rating_distribution")
relation("top_movies", "mart_top_movies")
relation("top_people", "mart_top_people")
relation("top_years", "mart_top_years")
relation("top_per_region", "mart_now_playing_recommendations")
relation("kpi_avg_runtime", "average_runtime")
relation("kpi_avg_rating", "avg_movie_rating")
relation("kpi_highest_rated", "highest_rated_movie")
relation("kpi_most_voted", "most_popular_movie")
relation("kpi_latest_snapshot", "latest_now_playing_snapshot")
relation("kpi_now_playing_counts", "number_of_movies_now_playing")
relation("kpi_rated_titles", "rated_movies")
relation("kpi_top_recommended", "top_recommended_now_playing_movie")
relation("kpi_top_genre", "top_rated_genre")
relation("kpi_total_genres", "total_genres")
relation("kpi_total_titles", "total_movies")


@query(
    "kpi_board",
    """
SELECT 'average_runtime' AS kpi, cast(NULL AS varchar) AS item, cast(average_runtime AS double) AS value FROM average_runtime
UNION ALL SELECT 'avg_movie_rating', NULL, avg_movie_rating FROM avg_movie_rating
UNION ALL SELECT 'highest_rated_movie', movie_name, avg_rating FROM highest_rated_movie
UNION ALL SELECT 'most_popular_movie', movie_name, num_of_votes FROM most_popular_movie
UNION ALL SELECT 'latest_now_playing_snapshot', cast(latest_now_playing_snapshot AS varchar), NULL FROM latest_now_playing_snapshot
UNION ALL SELECT 'number_of_movies_now_playing', tmdb_region, no_of_movies_now_playing FROM number_of_movies_now_playing
UNION ALL SELECT 'rated_movies', NULL, total_rated_movies FROM rated_movies
UNION ALL SELECT 'top_recommended_now_playing_movie', tmdb_region, avg_rating FROM top_recommended_now_playing_movie
UNION ALL SELECT 'top_rated_genre', genre_name, genre_avg_rating FROM top_rated_genre
UNION ALL SELECT 'total_genres', NULL, total_genres FROM total_genres
UNION ALL SELECT 'total_movies', NULL, total_movies FROM total_movies
""",
)
def _(c):
    return kpis.board(c)


# Data-quality checks -----------------------------------------------------------
@query("check_not_null", "SELECT tconst, titletype FROM raw_title_basics WHERE genres IS NULL")
def _(c):
    return checks.null_rows(c.raw["title_basics"], "genres").select("tconst", "titletype")


@query("check_unique", "SELECT id, count(*) AS record_count FROM raw_now_playing GROUP BY id HAVING count(*) > 1")
def _(c):
    return checks.repeated_values(c.raw["now_playing"], "id")


@query(
    "check_accepted_values",
    """
SELECT category, count(*) AS record_count FROM raw_title_principals
WHERE category NOT IN ('actor', 'actress', 'archive_footage', 'casting_director', 'cinematographer', 'composer',
                       'director', 'editor', 'producer', 'production_designer', 'writer') GROUP BY category""",
)
def _(c):
    return checks.unaccepted_values(c.raw["title_principals"], "category", list(ROLE_MINIMUMS))


@query(
    "check_relationship",
    """
SELECT tmdb_id, imdb_id FROM stg_details d WHERE imdb_id IS NOT NULL
AND NOT EXISTS (SELECT 1 FROM stg_title_basics t WHERE t.imdb_id = d.imdb_id)""",
)
def _(c):
    linked = c.stg_details.select("tmdb_id", "imdb_id")
    return checks.orphans(linked, "imdb_id", c.stg_title_basics, "imdb_id")


@query(
    "check_composite_key",
    """
SELECT tconst, ordering, count(*) AS record_count FROM raw_title_principals
GROUP BY tconst, ordering HAVING count(*) > 1""",
)
def _(c):
    return checks.repeated_keys(c.raw["title_principals"], ["tconst", "ordering"])


@query(
    "check_range",
    """
WITH scaled AS (SELECT movie_id, imdb_avg_rating * 1.2e0 AS imdb_avg_rating, tmdb_avg_rating * 1.2e0 AS tmdb_avg_rating
                FROM fct_movie_ratings)
SELECT movie_id, 'imdb_avg_rating' AS invalid_column, imdb_avg_rating AS invalid_value
FROM scaled WHERE imdb_avg_rating NOT BETWEEN 0 AND 10
UNION ALL
SELECT movie_id, 'tmdb_avg_rating', tmdb_avg_rating FROM scaled WHERE tmdb_avg_rating NOT BETWEEN 0 AND 10""",
)
def _(c):
    columns = ["imdb_avg_rating", "tmdb_avg_rating"]
    scaled = c.fct_movie_ratings.withColumns({name: F.col(name) * 1.2 for name in columns})
    return checks.outside_range(scaled, "movie_id", columns)


@query(
    "check_nonnegative",
    """
SELECT movie_id, 'imdb_num_of_votes' AS invalid_column, imdb_num_of_votes - 500 AS invalid_value
FROM fct_movie_ratings WHERE imdb_num_of_votes < 500
UNION ALL
SELECT movie_id, 'tmdb_num_of_votes', tmdb_num_of_votes - 500 FROM fct_movie_ratings WHERE tmdb_num_of_votes < 500""",
)
def _(c):
    columns = ["imdb_num_of_votes", "tmdb_num_of_votes"]
    lowered = c.fct_movie_ratings.withColumns({name: F.col(name) - 500 for name in columns})
    return checks.negative_values(lowered, "movie_id", columns)


@query(
    "check_label_absent",
    """
SELECT 'dim_genre' AS model_name, genre_name FROM dim_genre WHERE lower(trim(genre_name)) = 'news'
UNION ALL
SELECT 'raw_genres', name FROM raw_genres WHERE lower(trim(name)) = 'news'
UNION ALL
SELECT 'raw_title_basics', genre_name
FROM (SELECT trim(unnest(string_split(genres, ','))) AS genre_name FROM raw_title_basics)
WHERE lower(genre_name) = 'news'""",
)
def _(c):
    titles = c.raw["title_basics"].select(F.explode(comma_elements(F.col("genres"))).alias("genre_name"))
    dictionary = c.raw["genres"].select(F.col("name").alias("genre_name"))
    relations = {"dim_genre": c.dim_genre, "raw_genres": dictionary, "raw_title_basics": titles}
    return checks.label_occurrences(relations, "news")


@query(
    "check_ids_absent",
    """
WITH ids AS (
  SELECT 'raw_title_basics' AS model_name, tconst AS imdb_id, cast(NULL AS bigint) AS tmdb_id FROM raw_title_basics
  UNION ALL SELECT 'raw_title_principals', tconst, NULL FROM raw_title_principals
  UNION ALL SELECT 'raw_details', imdb_id, id FROM raw_details
  UNION ALL SELECT 'raw_now_playing', NULL, id FROM raw_now_playing
  UNION ALL SELECT 'dim_movies', imdb_id, tmdb_id FROM dim_movies
  UNION ALL SELECT 'fct_now_playing', imdb_id, tmdb_id FROM fct_now_playing)
SELECT * FROM ids WHERE imdb_id IN (SELECT imdb_id FROM excluded_imdb)
UNION ALL
SELECT * FROM ids WHERE tmdb_id IN (SELECT tmdb_id FROM excluded_tmdb)""",
)
def _(c):
    relations = {
        "raw_title_basics": c.raw["title_basics"].select(F.col("tconst").alias("imdb_id")),
        "raw_title_principals": c.raw["title_principals"].select(F.col("tconst").alias("imdb_id")),
        "raw_details": c.raw["details"].select("imdb_id", F.col("id").alias("tmdb_id")),
        "raw_now_playing": c.raw["now_playing"].select(F.col("id").alias("tmdb_id")),
        "dim_movies": c.dim_movies,
        "fct_now_playing": c.fct_now_playing,
    }
    return checks.excluded_occurrences(relations, c.excluded)


@query(
    "check_rank_order",
    """
SELECT 'movie' AS list_name, movie_rank + movie_rank % 3 AS actual_rank, movie_rank AS expected_rank
FROM mart_top_movies WHERE movie_rank % 3 <> 0
UNION ALL
SELECT * FROM (
  SELECT 'people' AS list_name, job_rank + birth_year % 2 AS actual_rank, cast(row_number() OVER (PARTITION BY job_role
         ORDER BY person_rating DESC NULLS LAST, person_id) AS int) AS expected_rank FROM mart_top_people)
WHERE actual_rank <> expected_rank
UNION ALL
SELECT 'recommendation', recommendation_rank + 1, recommendation_rank FROM mart_now_playing_recommendations""",
)
def _(c):
    movies = c.mart_top_movies.withColumn("movie_rank", F.col("movie_rank") + F.col("movie_rank") % 3)
    people = c.mart_top_people.withColumn("job_rank", F.col("job_rank") + F.col("birth_year") % 2)
    listed = c.mart_now_playing_recommendations.withColumn("recommendation_rank", F.col("recommendation_rank") + 1)
    return quality.rank_violations(movies, people, listed)


@query(
    "check_histogram",
    """
SELECT 'misnamed' AS finding, bucket_order FROM mart_rating_distribution WHERE bucket_order = 5
UNION ALL
SELECT 'repeated_bins', NULL FROM mart_rating_distribution WHERE bucket_order IN (5, 6) HAVING count(*) = 2
UNION ALL
SELECT 'counts_do_not_add_up', NULL FROM mart_rating_distribution WHERE bucket_order = 3 HAVING count(*) = 1
UNION ALL
SELECT 'count_out_of_bounds', bucket_order FROM mart_rating_distribution
WHERE bucket_order = 3 AND movie_count = total_no_of_movies""",
)
def _(c):
    """One bin under its neighbour's name, another with a title too many."""
    low = F.col("bucket_order")
    broken = c.mart_rating_distribution.withColumns(
        {
            "rating_bracket": F.when(low == 5, "6-7").otherwise(F.col("rating_bracket")),
            "movie_count": F.col("movie_count") + F.when(low == 3, 1).otherwise(0),
        }
    )
    return checks.histogram_issues(broken)


@query("filtered_exclusion", "SELECT * FROM stg_title_principals")
def _(c):
    """The largest staged relation by way of the id filter, which the planner only takes for large id sets."""
    rows = staging.projected("title_principals", c.raw["title_principals"])
    return without(rows, c.excluded.imdb, "imdb_id", c.kept.keep("forced_filter", id_filter(c.excluded.imdb, "imdb_id")))


@query(
    "id_filter",
    """
SELECT 'title_principals' AS relation, count(*) AS listed, count_if(tconst IN (SELECT imdb_id FROM excluded_imdb)) AS leaving,
       0 AS missed, true AS few_others FROM raw_title_principals
UNION ALL
SELECT 'title_akas', count(*), count_if(titleid IN (SELECT imdb_id FROM excluded_imdb)), 0, true FROM raw_title_akas""",
)
def _(c):
    """What a filter of the excluded ids says of every credit and alternate title: it misses none and passes few others."""
    held = c.kept.keep("forced_filter", id_filter(c.excluded.imdb, "imdb_id"))
    ids = c.excluded.imdb.withColumn("excluded", F.lit(True))
    found = []
    for relation, column in (("title_principals", "tconst"), ("title_akas", "titleid")):
        rows = maybe_among(c.raw[relation].select(F.col(column).alias("imdb_id")), held, "imdb_id").join(ids, "imdb_id", "left")
        leaving, maybe = F.coalesce("excluded", F.lit(False)), F.col("_maybe")
        counted = rows.agg(
            F.count(F.lit(1)).alias("listed"),
            F.count_if(leaving).alias("leaving"),
            F.count_if(leaving & ~maybe).alias("missed"),
            (F.count_if(~leaving & maybe) <= 0.02 * F.count(F.lit(1))).alias("few_others"),
        )
        found.append(counted.select(F.lit(relation).alias("relation"), "*"))
    return found[0].unionByName(found[1])


@query(
    "hot_keys",
    """
SELECT nconst, count(*) AS rows FROM raw_title_principals WHERE nconst IS NOT NULL GROUP BY nconst
HAVING count(*) >= 0.001e0 * (SELECT count(nconst) FROM raw_title_principals)""",
)
def _(c):
    return hot_keys(c.raw["title_principals"], "nconst", 0.001)


@query(
    "dealt_join",
    """
SELECT p.nconst, p.tconst, p.ordering, n.primaryname FROM raw_title_principals p JOIN raw_name_basics n ON p.nconst = n.nconst""",
)
def _(c):
    """Credits meet their people with every person of a thousandth of the credits dealt to parts."""
    credits = c.raw["title_principals"].select("nconst", "tconst", "ordering")
    people = c.raw["name_basics"].select("nconst", "primaryname")
    parts = parts_of_hot_keys(credits, "nconst", 200)
    if parts is None:
        return credits.join(people, "nconst")
    left, right = dealt(credits, people, "nconst", parts)
    return left.join(right, ["nconst", "_part"]).drop("_part")


def _token_cases():
    """Variants of a title's own list and whether they must match; NULL: as the title itself."""
    own = F.coalesce("genres", F.lit(""))
    return {
        "alone": (F.lit("News"), True),
        "last": (F.concat(own, F.lit(",News")), True),
        "first": (F.concat(F.lit("News,"), own), True),
        "padded": (F.concat(F.lit("Drama, news ,"), own), True),
        "suffix": (F.concat(own, F.lit(",Newsreel")), None),
        "prefix": (F.concat(F.lit("NotNews,"), own), None),
        "unknown": (F.lit(None).cast("string"), False),
    }


@query(
    "token_match_cases",
    """
WITH titles AS (
  SELECT tconst, coalesce(list_contains(string_split(lower(replace(genres, ' ', '')), ','), 'news'), false) AS own
  FROM raw_title_basics)
SELECT v.variant, count(*) AS titles, count_if(CASE v.variant WHEN 'unknown' THEN false WHEN 'suffix' THEN own
       WHEN 'prefix' THEN own ELSE true END) AS matches, cast(0 AS bigint) AS mismatches
FROM titles, (SELECT unnest(['alone', 'last', 'first', 'padded', 'suffix', 'prefix', 'unknown']) AS variant) v
GROUP BY v.variant""",
)
def _(c):
    """The token truth table, with every title's own list as the rest of the case."""
    own = F.array_contains(F.transform(comma_elements(F.coalesce("genres", F.lit(""))), F.lower), "news")
    cases = [
        F.struct(
            F.lit(name).alias("variant"),
            text.alias("genres"),
            (own if expected is None else F.lit(expected)).alias("expected"),
        )
        for name, (text, expected) in _token_cases().items()
    ]
    rows = c.raw["title_basics"].select(F.inline(F.array(*cases)))
    wrong = checks.mismatched_tokens(rows, "news").groupBy("variant").agg(F.count(F.lit(1)).alias("mismatches"))
    seen = rows.groupBy("variant").agg(
        F.count(F.lit(1)).alias("titles"), F.count(F.when(has_token(F.col("genres"), "news"), 1)).alias("matches")
    )
    return seen.join(wrong, "variant", "left").select(
        "variant", "titles", "matches", F.coalesce("mismatches", F.lit(0)).alias("mismatches")
    )


# Public results ----------------------------------------------------------------
PUBLIC = {f"public_{name}": partial(public.result, name) for name in public.RESULT_NAMES}
for _key, _plan in PUBLIC.items():
    query(_key, f"SELECT * FROM {_key}")(_plan)
query("ranked_years", "SELECT * FROM public_top_years")(PUBLIC["public_top_years"])
query("region_capture", "SELECT * FROM public_captures")(lambda c: contract.capture_evidence(c.fct_now_playing))


@query(
    "normalize_scalars",
    """
SELECT cast(l_orderkey AS varchar) AS l_orderkey, cast(cast(l_quantity AS bigint) AS varchar) AS l_quantity,
       CASE WHEN l_discount = floor(l_discount) THEN cast(cast(l_discount AS bigint) AS varchar)
            ELSE cast(l_discount AS varchar) END AS l_discount,
       rtrim(rtrim(cast(cast(l_extendedprice AS decimal(12, 2)) AS varchar), '0'), '.') AS price,
       strftime(l_shipdate, '%Y-%m-%d') AS shipped, strftime(l_shipdate, '%Y-%m-%d') || 'T18:00:00Z' AS received,
       cast(NULL AS varchar) AS note
FROM lineitem""",
)
def _(c):
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    rows = c.raw.table("lineitem").select(
        "l_orderkey",
        "l_quantity",
        "l_discount",
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        F.col("l_shipdate").cast("date").alias("shipped"),
        F.concat(day, F.lit(" 11:00:00-07:00")).cast("timestamp").alias("received"),
        F.lit(None).cast("double").alias("note"),
    )
    return normalize_scalars(rows)


@query(
    "check_finite",
    """
SELECT l_orderkey, 'rate' AS invalid_column FROM lineitem WHERE l_quantity > 45
UNION ALL SELECT l_orderkey, 'share' FROM lineitem WHERE l_discount = 0""",
)
def _(c):
    infinite, nan = F.lit(float("inf")), F.lit(float("nan"))
    rows = c.raw.table("lineitem").select(
        "l_orderkey",
        F.when(F.col("l_quantity") > 45, infinite).otherwise(F.col("l_quantity")).alias("rate"),
        F.when(F.col("l_discount") == 0, nan).otherwise(F.col("l_discount")).alias("share"),
    )
    return contract.non_finite_rows(rows, "l_orderkey", ["rate", "share"])


@query(
    "check_single_row",
    """
SELECT 'people' AS dataset, count(*) AS row_count FROM mart_top_people HAVING count(*) <> 1
UNION ALL SELECT 'total', count(*) FROM total_movies HAVING count(*) <> 1
UNION ALL SELECT 'highlight', count(*) FROM highest_rated_movie HAVING count(*) > 1""",
)
def _(c):
    return (
        contract.not_one_row(c.mart_top_people, "people")
        .unionByName(contract.not_one_row(c.total_movies, "total"))
        .unionByName(contract.not_one_row(c.highest_rated_movie, "highlight", optional=True))
    )


@query(
    "check_unique_within",
    """
SELECT tmdb_region AS region, movie_id, count(*) AS record_count FROM fct_now_playing
GROUP BY 1, 2 HAVING count(*) > 1""",
)
def _(c):
    listed = c.fct_now_playing.select(F.col("tmdb_region").alias("region"), "movie_id")
    return contract.repeated_identities(listed, "movie_id", ["region"])


@query(
    "check_contiguous_rank",
    """
SELECT * FROM (
  SELECT role, person_id, cast(rank + movie_count % 2 AS bigint) AS rank, cast(row_number() OVER (PARTITION BY role
         ORDER BY avg_rating DESC NULLS LAST, person_id) AS int) AS expected_rank FROM public_people)
WHERE rank <> expected_rank""",
)
def _(c):
    people = PUBLIC["public_people"](c).select(
        "role", "person_id", "avg_rating", (F.col("rank") + F.col("movie_count") % 2).alias("rank")
    )
    order = [F.col("avg_rating").desc_nulls_last(), F.col("person_id").asc()]
    return contract.broken_ranks(people, order, ["role"]).select("role", "person_id", "rank", "expected_rank")


@query(
    "check_population_chain",
    """
SELECT t.total_movies AS qualifying, r.total_rated_movies AS rated, q.n AS total
FROM total_movies t CROSS JOIN rated_movies r
CROSS JOIN (SELECT coalesce(max(total_no_of_movies), 0) AS n FROM mart_rating_distribution) q
WHERE t.total_movies > r.total_rated_movies OR r.total_rated_movies > q.n""",
)
def _(c):
    """The two ends are swapped, so the chain breaks wherever a title is unrated or below the floor."""
    population = c.mart_rating_distribution.agg(F.max("total_no_of_movies").alias("n"))
    return contract.population_chain(c.total_movies, c.rated_movies, population)


@query(
    "check_bins",
    """
WITH bins AS (
  SELECT CASE WHEN "order" = 4 THEN '3-4' ELSE bracket END AS bracket, "order",
         movie_count + CASE WHEN "order" = 2 THEN 5 ELSE 0 END AS movie_count,
         percentage + CASE WHEN "order" = 7 THEN 3 ELSE 0 END AS percentage,
         population_count + CASE WHEN "order" = 9 THEN 1 ELSE 0 END AS population_count FROM public_rating_bins)
SELECT 'label' AS issue, bracket FROM bins WHERE bracket <> "order" || '-' || ("order" + 1)
UNION ALL
SELECT 'share', bracket FROM bins WHERE abs(percentage - movie_count * 100.0e0 / population_count) > 0.0051
UNION ALL
SELECT 'repeated_bracket', bracket FROM bins GROUP BY bracket HAVING count(*) > 1
UNION ALL
SELECT 'population', NULL FROM bins HAVING min(population_count) <> max(population_count)
UNION ALL
SELECT 'count_sum', NULL FROM bins HAVING sum(movie_count) <> max(population_count)
UNION ALL
SELECT 'percentage_sum', NULL FROM bins HAVING abs(sum(percentage) - 100) > 0.051""",
)
def _(c):
    at = lambda order, value: F.when(F.col("order") == order, value).otherwise(0)
    broken = PUBLIC["public_rating_bins"](c).withColumns(
        {
            "bracket": F.when(F.col("order") == 4, "3-4").otherwise(F.col("bracket")),
            "movie_count": F.col("movie_count") + at(2, 5),
            "percentage": F.col("percentage") + at(7, 3),
            "population_count": F.col("population_count") + at(9, 1),
        }
    )
    return contract.bin_issues(broken)


@query(
    "check_role_limits",
    f"""
WITH people AS (
  SELECT person_id, job_role, count(DISTINCT b.movie_id) - 1 AS movie_count
  FROM bridge_movie_people b JOIN rated r ON b.movie_id = r.movie_id
  WHERE imdb_num_of_votes >= 100000 OR tmdb_num_of_votes >= 100000
  GROUP BY person_id, job_role HAVING count(DISTINCT b.movie_id) >= {ROLE_FLOOR})
SELECT job_role AS role, count(*) AS "rows", count_if(movie_count < {ROLE_FLOOR}) AS below_minimum
FROM people p JOIN dim_person USING (person_id) GROUP BY job_role
HAVING count(*) > 20 OR count_if(movie_count < {ROLE_FLOOR}) > 0""",
)
def _(c):
    """Full lists instead of the published ones, with one title too few."""
    full = marts.eligible_people(c.stg_title_principals, c.headline_titles).join(c.dim_person, "person_id", "left_semi")
    people = full.select(F.col("job_role").alias("role"), (F.col("movie_count") - 1).alias("movie_count"))
    return contract.role_limit_issues(people)


@query(
    "check_region_coverage",
    """
WITH counted AS (
  SELECT CASE region WHEN 'IN' THEN 'FR' ELSE region END AS region, movie_count % 4 AS movie_count
  FROM public_region_counts),
listed AS (SELECT region, count(*) AS n FROM public_recommendations GROUP BY region)
SELECT region, 'unsupported_region' AS issue FROM counted WHERE region NOT IN ('IN', 'US')
UNION ALL
SELECT region, 'missing_region' FROM (SELECT unnest(['IN', 'US']) AS region)
WHERE region NOT IN (SELECT region FROM counted)
UNION ALL
SELECT c.region, CASE WHEN movie_count < 1 THEN 'no_titles' ELSE 'too_many_recommendations' END
FROM counted c LEFT JOIN listed l ON c.region = l.region
WHERE c.region IN ('IN', 'US') AND (movie_count < 1 OR coalesce(n, 0) > movie_count)""",
)
def _(c):
    """One region's counts go by another name; the other counts fewer titles than it lists."""
    region = F.when(F.col("region") == "IN", "FR").otherwise(F.col("region"))
    counts = PUBLIC["public_region_counts"](c).withColumns({"region": region, "movie_count": F.col("movie_count") % 4})
    return contract.region_coverage_issues(counts, PUBLIC["public_recommendations"](c))


@query(
    "check_capture_dates",
    """
SELECT s.region, NOT coalesce(s.region <> 'FR' AND row_count = unique_movie_count AND row_count = capture_date_count
                             AND row_count = movie_count, false) AS counts_disagree,
       coalesce(min_capture_date <> max_capture_date, true) AS dates_disagree
FROM (SELECT unnest(['IN', 'US', 'FR']) AS region) s
LEFT JOIN (SELECT CASE region WHEN 'IN' THEN 'FR' ELSE region END AS region, * EXCLUDE (region)
           FROM public_captures) c ON s.region = c.region
LEFT JOIN public_region_counts n ON s.region = n.region
WHERE counts_disagree OR dates_disagree""",
)
def _(c):
    """One region's evidence goes by another name, so it lacks its own and has a strange one."""
    region = F.when(F.col("region") == "IN", "FR").otherwise(F.col("region"))
    evidence = contract.capture_evidence(c.fct_now_playing).withColumn("region", region)
    return contract.capture_issues(evidence, PUBLIC["public_region_counts"](c))


@query(
    "check_latest",
    """
SELECT cast(max(snapshot_date) + INTERVAL 1 DAY AS date) AS latest, max(snapshot_date) AS captured
FROM fct_now_playing""",
)
def _(c):
    late = c.latest_now_playing_snapshot.select(F.date_add("latest_now_playing_snapshot", 1).alias("latest"))
    return contract.latest_mismatch(late, contract.capture_evidence(c.fct_now_playing))


DATE_TEXT = """strftime(o_orderdate, '%Y-%m-') || lpad(cast(o_orderkey % 33 AS varchar), 2, '0')"""


@query(
    "check_dates",
    f"""
SELECT o_orderkey, {DATE_TEXT} AS due FROM orders WHERE try_cast({DATE_TEXT} AS date) IS NULL""",
)
def _(c):
    day = F.lpad((F.col("o_orderkey") % 33).cast("string"), 2, "0")
    due = F.concat(F.date_format("o_orderdate", "yyyy-MM-"), day)
    return contract.impossible_dates(c.raw.table("orders").select("o_orderkey", due.alias("due")), "due")


@query(
    "check_sequence",
    """
SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 3 THEN 'unreadable' ELSE 'out_of_order' END AS issue
FROM orders WHERE o_orderkey % 10 = 3 OR o_orderkey % 7 = 2""",
)
def _(c):
    """Exports half an hour after completion, but without a zone or an hour early for some orders."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    key = F.col("o_orderkey")
    zone = F.when(key % 10 == 3, "").otherwise("Z")
    clock = F.when(key % 7 == 2, "T04:30:00+05:00").otherwise("T00:30:00+00:00")
    rows = c.raw.table("orders").select(
        "o_orderkey",
        F.concat(day, F.lit("T00:00:00"), zone).alias("completed"),
        F.concat(day, clock).alias("exported"),
    )
    return contract.sequence_issues(rows, "completed", "exported").select("o_orderkey", "issue")


@query(
    "check_field_rules",
    """
WITH faulty AS (
  SELECT CASE WHEN r.tmdb_id % 3 = 0 THEN '' ELSE r.movie_id END AS movie_id, m.movie_name AS title,
         avg_rating * 1.2e0 AS rating, num_of_votes - 500 AS votes
  FROM rated r LEFT JOIN dim_movies m ON r.movie_id = m.movie_id)
SELECT 'movie_id' AS field, 'min_length' AS rule, movie_id AS value FROM faulty WHERE length(movie_id) < 1
UNION ALL SELECT 'rating', 'maximum', cast(rating AS varchar) FROM faulty WHERE rating > 10
UNION ALL SELECT 'votes', 'minimum', cast(votes AS varchar) FROM faulty WHERE votes < 0""",
)
def _(c):
    """The public title rules on every catalogue row, with inflated ratings and lowered votes."""
    rated = c.fct_movie_ratings.select(
        "movie_id",
        "tmdb_id",
        marts.rules.preferred_rating().alias("rating"),
        marts.rules.preferred_votes().alias("votes"),
    )
    rows = rated.join(c.dim_movies.select("movie_id", "movie_name"), "movie_id", "left").select(
        F.when(F.col("tmdb_id") % 3 == 0, "").otherwise(F.col("movie_id")).alias("movie_id"),
        F.col("movie_name").alias("title"),
        (F.col("rating") * 1.2).alias("rating"),
        (F.col("votes") - 500).alias("votes"),
    )
    return contract.field_rule_issues(rows, public.TITLE_RULES)


def _fingerprint_sql(name: str) -> str:
    fields = ", ".join(f"'{c}', \"{c}\"" for c in sorted(public.columns(name)))
    return f"""
SELECT '{name}' AS dataset, sha256(coalesce(string_agg(line, chr(10) ORDER BY line), '')) AS sha256, count(*) AS row_count
FROM (SELECT cast(json_object({fields}) AS varchar) AS line FROM public_{name})"""


@query("mart_fingerprint", "\nUNION ALL".join(_fingerprint_sql(name) for name in public.RESULT_NAMES))
def _(c):
    found = [
        contract.fingerprint(PUBLIC[f"public_{name}"](c), public.LARGEST.get(name, 1)).withColumn("dataset", F.lit(name))
        for name in public.RESULT_NAMES
    ]
    return reduce(DataFrame.unionByName, found).select("dataset", "sha256", "row_count")


# Presentation ------------------------------------------------------------------
@query(
    "dense_histogram",
    """
SELECT coalesce(bracket, o || '-' || (o + 1)) AS bracket, cast(o AS int) AS "order",
       coalesce(movie_count, 0) AS movie_count, coalesce(percentage, 0e0) AS percentage
FROM (SELECT unnest(range(10)) AS o) LEFT JOIN (
  SELECT rating_bracket AS bracket, bucket_order, movie_count, percentage_of_movies AS percentage FROM thin_distribution)
  ON o = bucket_order
WHERE EXISTS (SELECT 1 FROM thin_distribution)""",
)
def _(c):
    """The histogram of titles with very many votes, which leaves brackets empty."""
    thin = marts.mart_rating_distribution(c.fct_movie_ratings, floor=(90_000, 2_480))
    return present.dense_histogram(public.published("rating_bins", thin))


@query(
    "dense_decades",
    """
SELECT s.decade, avg_rating
FROM (SELECT cast(1890 + 10 * unnest(range(14)) AS varchar) || 's' AS decade) s
LEFT JOIN thin_decades r ON s.decade = r.decade
WHERE EXISTS (SELECT 1 FROM thin_decades)""",
)
def _(c):
    """Mean ratings of titles with very many votes, which leaves decades unknown."""
    thin = marts.decade_avg_rating(marts.era_ratings(c.dim_movies, c.fct_movie_ratings, least_votes=90_000))
    return present.dense_decades(public.published("decade_ratings", thin), "avg_rating")


@query(
    "leaders",
    """
SELECT * FROM public_recommendations WHERE rating = (SELECT max(rating) FROM public_recommendations)""",
)
def _(c):
    return present.leaders(PUBLIC["public_recommendations"](c), "rating")


@query(
    "coverage_ratio",
    """
SELECT total_rated_movies AS rated_movies, total_movies,
       CASE WHEN total_movies > 0 THEN cast(round(cast(cast(total_rated_movies * 100 AS double) / total_movies
            AS decimal(18, 9)), 1) AS double) END AS coverage_percent
FROM rated_movies CROSS JOIN total_movies""",
)
def _(c):
    return present.coverage_ratio(c.rated_movies, c.total_movies)


@query(
    "freshness",
    """
SELECT region, max_capture_date AS capture_date,
       epoch(timestamp '2024-02-07 12:00:00') - epoch(timestamp '2024-01-30 11:00:00') > 8 * 86400 AS build_stale,
       date_diff('day', max_capture_date, date '2024-02-07') > 8 AS capture_stale FROM public_captures""",
)
def _(c):
    """A build of eight days and one hour before the chosen moment."""
    completed, now = (F.lit(t).cast("timestamp") for t in ("2024-01-30T11:00:00Z", "2024-02-07T12:00:00Z"))
    return present.freshness(PUBLIC["public_captures"](c), completed, now)


@query("people_for_role", "SELECT * FROM public_people WHERE role = 'director' AND rank <= 10")
def _(c):
    return present.people_for_role(PUBLIC["public_people"](c), "director", charted_only=True)


@query(
    "region_view",
    """
SELECT n.region, n.movie_count, k.max_capture_date AS capture_date, r.* EXCLUDE (region)
FROM public_region_counts n LEFT JOIN public_captures k ON n.region = k.region
LEFT JOIN public_recommendations r ON n.region = r.region WHERE n.region = 'US'""",
)
def _(c):
    parts = (PUBLIC[f"public_{name}"](c) for name in ("recommendations", "region_counts", "captures"))
    return present.region_view(*parts, "US")


@query(
    "genre_order",
    """
SELECT genre, avg_rating, cast(row_number() OVER (ORDER BY avg_rating DESC NULLS LAST, genre) AS int) AS position
FROM public_genre_ratings""",
)
def _(c):
    return present.genre_order(PUBLIC["public_genre_ratings"](c), "avg_rating")


@query(
    "shared_leader",
    """
SELECT h.movie_id AS highest_rated_id, v.movie_id AS most_voted_id,
       coalesce(h.movie_id = v.movie_id, false) AS shared_leader
FROM (SELECT max(movie_id) AS movie_id FROM highest_rated_movie) h,
     (SELECT max(movie_id) AS movie_id FROM most_popular_movie) v""",
)
def _(c):
    return present.shared_leader(c.highest_rated_movie, c.most_popular_movie)


# Whole-catalogue reports -------------------------------------------------------
OBSERVED = ("dim_movies", "bridge_movie_genres", "fct_movie_ratings", "fct_now_playing")


@query("observed_counts", observed_counts_sql(OBSERVED))
def _(c):
    """Rows and row-wise violations of four relations, taken along while they were written."""
    c.build(OBSERVED)
    return checks.stated(c.raw.spark, quality.observed_counts(c, OBSERVED), "metric", "n")


@query("declared_tests", declared_tests_sql())
def _(c):
    return quality.summary(c)


@query("contract_report", contract_report_sql())
def _(c):
    return validate.summary(c.public_results, public.publication(c))


def _faulty(results):
    """The public results with the faults that the check SQL states."""
    day = lambda c, n: F.date_add(c, n)
    own = F.col
    changes = {
        "rated_movies": {"rated_movies": own("rated_movies") * 3},
        "avg_rating": {"avg_rating": own("avg_rating") + 10},
        "highest_rated_movie": {"movie_id": F.lit("")},
        "rating_bins": {"movie_count": own("movie_count") + F.when(own("order") == 2, 1).otherwise(0)},
        "genre_ratings": {
            "avg_rating": F.when(F.length("genre") % 2 == 0, own("avg_rating") - 20).otherwise(own("avg_rating"))
        },
        "decade_counts": {"decade": F.when(own("decade") == "1990s", "1700s").otherwise(own("decade"))},
        "top_years": {"rank": own("rank") + own("year") % 2},
        "top_movies": {"votes": own("votes") + 0.5},
        "people": {"movie_count": own("movie_count") - 2},
        "region_counts": {"region": F.when(own("region") == "IN", "FR").otherwise(own("region"))},
        "recommendations": {
            "release_date": F.when(own("rank") == 2, "2024-02-30").otherwise(own("release_date").cast("string"))
        },
        "latest_snapshot_date": {"latest_snapshot_date": day("latest_snapshot_date", 1)},
        "captures": {
            "min_capture_date": F.when(own("region") == "US", day("min_capture_date", -1)).otherwise(own("min_capture_date"))
        },
    }
    changed = {name: df.withColumns(changes[name]) if name in changes else df for name, df in results.items()}
    return changed | {"total_movies": results["total_movies"].unionAll(results["total_movies"])}


@query("contract_faults", contract_report_sql(faulty=True))
def _(c):
    early = public.publication(c).withColumn("exported", F.replace("exported", F.lit("T01:30"), F.lit("T00:30")))
    return validate.summary(_faulty(c.public_results), early)


def _cells_sql(name: str, field: str) -> str:
    """Every cell of a field as text; whole numbers have no fraction."""
    text = f'cast("{field}" AS varchar)'
    if field in ("avg_rating", "avg_runtime_minutes", "rating", "percentage", "popularity"):
        text = f'CASE WHEN "{field}" = floor("{field}") THEN cast(cast("{field}" AS bigint) AS varchar) ELSE {text} END'
    return f"SELECT '{name}' AS result, '{field}' AS field, {text} AS value FROM public_{name}"


def _digest_sql(relation: str) -> str:
    """The digest of a staged relation; whole doubles have no fraction, small ones no exponent."""
    fields = []
    for c in sorted(staging.COLUMNS[relation]):
        number = f"try_cast(cast({c} AS varchar) AS double)"
        whole = f"typeof({c}) = 'DOUBLE' AND {number} = floor({number})"
        small = f"typeof({c}) = 'DOUBLE' AND abs({number}) < 1e-3"
        plain = f"rtrim(cast(try_cast(cast({c} AS varchar) AS decimal(38, 28)) AS varchar), '0')"
        text = f"CASE WHEN {whole} THEN cast(cast({number} AS bigint) AS varchar) WHEN {small} THEN {plain} ELSE cast({c} AS varchar) END"
        fields.append(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END")
    name = f"stg_{relation}"
    half = lambda at: f"cast(coalesce(sum(cast('0x' || substr(h, {at}, 16) AS ubigint)), 0) % 18446744073709551616 AS varchar)"
    hashed = f"SELECT md5('{name}' || {' || '.join(fields)}) AS h FROM {name}"
    return f"SELECT '{name}' AS relation, count(*) AS row_count, {half(1)} AS high, {half(17)} AS low FROM ({hashed})"


@query("relation_digests", "\nUNION ALL\n".join(map(_digest_sql, staging.COLUMNS)))
def _(c):
    """An order-free digest of every staged relation."""
    names = [f"stg_{relation}" for relation in staging.COLUMNS]
    found = [multiset_digest(getattr(c, name), name).select(F.lit(name).alias("relation"), "*") for name in names]
    return reduce(DataFrame.unionAll, found)


@query("public_cells", "\nUNION ALL\n".join(_cells_sql(name, field) for name in public.RESULT_NAMES for field in public.columns(name)))
def _(c):
    """Every cell of every public result set in its public text form."""
    return reduce(DataFrame.unionAll, [contract.public_cells(df.drop(public.POSITION), name) for name, df in c.public_results.items()])


@query("built_layers", built_layers_sql())
def _(c):
    """Both layers built as tables in databases of their own, counted from those tables."""
    run = uuid.uuid4().hex
    built = layers.build_layers(c.raw.spark, c.raw, _scratch(c, "layers"), f"curated_{run}", f"analytics_{run}")
    names = layers.CURATED + layers.ANALYTICS
    counted = [
        getattr(built, name).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("relation"), "row_count")
        for name in names
    ]
    return reduce(DataFrame.unionByName, counted)
