"""Schemas of the nine raw relations; readers never infer types."""

from __future__ import annotations

# Column names and types of the raw relations.
RAW_SCHEMAS = {
    "name_basics": (
        "nconst string, primaryname string, birthyear int, deathyear int, "
        "primaryprofession string, knownfortitles string"
    ),
    "title_akas": (
        "titleid string, ordering int, title string, region string, language string, "
        "types string, attributes string, isoriginaltitle int"
    ),
    "title_basics": (
        "tconst string, titletype string, primarytitle string, originaltitle string, isadult int, "
        "startyear int, endyear int, runtimeminutes int, genres string"
    ),
    "title_crew": "tconst string, directors string, writers string",
    "title_principals": (
        "tconst string, ordering int, nconst string, category string, job string, characters string"
    ),
    "title_ratings": "tconst string, averagerating double, numvotes bigint",
    "details": (
        "id bigint, imdb_id string, title string, budget bigint, revenue bigint, release_date date, "
        "runtime int, status string, original_language string, origin_country string, "
        "production_countries string, production_companies string, genres string, "
        "vote_average double, vote_count bigint, poster_path string"
    ),
    "genres": "id bigint, name string",
    "now_playing": (
        "id bigint, title string, release_date date, vote_average double, vote_count bigint, "
        "genre_ids string, overview string, poster_path string, popularity double, region string, "
        "snapshot_date date"
    ),
}

# Bulk files are tab separated; API extracts are quoted CSV.
TSV_RELATIONS = (
    "name_basics",
    "title_akas",
    "title_basics",
    "title_crew",
    "title_principals",
    "title_ratings",
)
CSV_RELATIONS = ("details", "genres", "now_playing")
