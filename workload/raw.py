"""The nine raw relations derived from the given tables.

One SQL text per relation serves Spark and the check engine alike; ``{name}``
stands for a given table. Every text reads whole tables, and each is a plain
projection, filter, equi join or mergeable aggregate, so no key gathers its
rows in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_SQL = {
    "name_basics": """
SELECT concat('nm', cast(s_suppkey AS string)) AS nconst,
       CASE WHEN s_suppkey % 17 = 0 THEN '  ' WHEN s_suppkey % 19 = 0 THEN NULL
            ELSE concat(' ', s_name) END AS primaryname,
       cast(1900 + s_suppkey % 100 AS int) AS birthyear,
       CASE WHEN s_suppkey % 3 = 0 THEN cast(1980 + s_suppkey % 40 AS int) END AS deathyear,
       'actor,producer' AS primaryprofession,
       concat('tt', cast(s_suppkey AS string)) AS knownfortitles
FROM {supplier}""",
    "title_basics": """
SELECT concat('tt', cast(p_partkey AS string)) AS tconst,
       CASE p_partkey % 10 WHEN 0 THEN 'tvMovie' WHEN 1 THEN 'tvSeries' ELSE 'movie' END AS titletype,
       p_name AS primarytitle,
       upper(p_name) AS originaltitle,
       cast(p_partkey % 2 AS int) AS isadult,
       CASE WHEN p_partkey % 29 <> 0 THEN cast(1885 + (p_partkey * 7) % 150 AS int) END AS startyear,
       CASE WHEN p_partkey % 41 = 0 THEN 2000 END AS endyear,
       CASE WHEN p_partkey % 23 <> 0 THEN p_size * 7 END AS runtimeminutes,
       CASE WHEN p_partkey % 31 = 0 THEN NULL
            WHEN p_partkey % 53 = 0 THEN concat(replace(p_name, ' ', ','), ', news ')
            ELSE replace(p_name, ' ', ', ') END AS genres
FROM {part}""",
    "title_ratings": """
SELECT concat('tt', cast(l_partkey AS string)) AS tconst,
       CASE WHEN l_partkey % 6 <> 5 THEN cast((l_partkey * 37) % 101 AS double) / 10 END AS averagerating,
       cast(count(*) * (1 + ((l_partkey % 3600) * (l_partkey % 3600) * 13) % 3600) AS bigint) AS numvotes
FROM {lineitem} GROUP BY l_partkey""",
    "title_crew": """
SELECT concat('tt', cast(p_partkey AS string)) AS tconst,
       concat('nm', cast(p_partkey % 100 AS string)) AS directors,
       concat('nm', cast(p_partkey % 97 AS string)) AS writers
FROM {part}""",
    "title_principals": """
SELECT concat('tt', cast(l_partkey AS string)) AS tconst,
       cast(l_linenumber AS int) AS ordering,
       concat('nm', cast(l_suppkey AS string)) AS nconst,
       CASE l_linenumber % 7 WHEN 1 THEN 'actor' WHEN 2 THEN 'actress' WHEN 3 THEN 'director'
            WHEN 4 THEN 'writer' WHEN 5 THEN 'producer' WHEN 6 THEN 'editor' ELSE 'self' END AS category,
       l_returnflag AS job,
       l_linestatus AS characters
FROM {lineitem}""",
    "title_akas": """
SELECT concat('tt', cast(p_partkey AS string)) AS titleid,
       cast(n_nationkey + 1 AS int) AS ordering,
       concat(p_name, ' ', n_name) AS title,
       n_name AS region,
       CASE WHEN n_nationkey % 3 = 1 THEN 'en' END AS language,
       'alternative' AS types,
       cast(NULL AS string) AS attributes,
       cast(CASE WHEN n_nationkey % 5 = 0 THEN 1 ELSE 0 END AS int) AS isoriginaltitle
FROM {part} JOIN {nation} ON n_regionkey = p_partkey % 5""",
    "details": """
SELECT 100000 + p_partkey AS id,
       CASE WHEN p_partkey % 8 = 0 THEN concat('tt', cast(p_partkey AS string))
            WHEN p_partkey % 12 = 0 THEN concat('ttx', cast(p_partkey AS string)) END AS imdb_id,
       concat(p_name, ' (t)') AS title,
       cast(p_size * 1000 AS bigint) AS budget,
       cast(p_size * 2500 AS bigint) AS revenue,
       make_date(cast(1900 + p_partkey % 125 AS int), cast(1 + p_partkey % 12 AS int), 1) AS release_date,
       p_size * 6 AS runtime,
       'Released' AS status,
       'en' AS original_language,
       '["US"]' AS origin_country,
       '[]' AS production_countries,
       '[]' AS production_companies,
       CASE WHEN p_partkey % 44 = 0 THEN NULL
            WHEN p_partkey % 52 = 0 THEN '[{{"id": 7, "name": "News "}}]'
            ELSE concat('[{{"id": 1, "name": "', replace(p_name, ' ', '"}}, {{"id": 2, "name": "'), '"}}]')
       END AS genres,
       cast((p_partkey * 13) % 101 AS double) / 10 AS vote_average,
       cast((p_partkey * 7) % 2500 AS bigint) AS vote_count,
       cast(NULL AS string) AS poster_path
FROM {part}""",
    "genres": """
SELECT cast(n_nationkey AS bigint) AS id,
       CASE WHEN n_nationkey = 7 THEN ' News ' WHEN n_nationkey = 11 THEN NULL ELSE n_name END AS name
FROM {nation}""",
    "now_playing": """
SELECT 100000 + user_id * 4 AS id,
       concat('now ', cast(user_id AS string)) AS title,
       cast(ts AS date) AS release_date,
       value / 50 AS vote_average,
       cast(substring(props, 7, length(props) - 7) AS bigint) * 10 AS vote_count,
       concat('[', CASE WHEN event_id % 400 = 0 THEN '7' ELSE '12' END, ', 28]') AS genre_ids,
       cast(NULL AS string) AS overview,
       cast(NULL AS string) AS poster_path,
       value AS popularity,
       CASE WHEN event_type IN ('view', 'signup', 'error') THEN 'US' ELSE 'IN' END AS region,
       cast(ts AS date) AS snapshot_date
FROM {events}""",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


class Given:
    """The given tables of one folder, and the raw relations over them, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}
        self._raw: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def sql(self, text: str) -> DataFrame:
        used = {name: self.table(name) for name in TABLES if "{" + name + "}" in text}
        return self.spark.sql(text, **used)

    def __getitem__(self, relation: str) -> DataFrame:
        if relation not in self._raw:
            self._raw[relation] = self.sql(RAW_SQL[relation])
        return self._raw[relation]
