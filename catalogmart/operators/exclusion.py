"""Cross-source exclusion of titles that carry a genre label.

A title is excluded in both sources as soon as either source tags it. The id
sets come from raw classifications, once per build, and every staging relation
anti-joins the written sets.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogmart.functions.text import has_token, id_tags, is_label, tag_names
from catalogmart.operators.joins import sized_join
from catalogmart.operators.sketches import fits_broadcast, id_filter
from catalogmart.sources.tables import KeptTables

EXCLUDED_LABEL = "news"


class ExcludedIds(NamedTuple):
    """Distinct, non-null ids per source, and a filter of each set that is too large to broadcast."""

    imdb: DataFrame  # imdb_id
    tmdb: DataFrame  # tmdb_id
    imdb_filter: DataFrame | None = None
    tmdb_filter: DataFrame | None = None


def tagged_in_list(title_basics: DataFrame, label: str = EXCLUDED_LABEL) -> DataFrame:
    """First-source ids whose comma list holds the label, once per row."""
    return title_basics.filter(has_token(F.col("genres"), label)).select(F.col("tconst").alias("imdb_id"))


def tagged_by_name(details: DataFrame, label: str = EXCLUDED_LABEL) -> DataFrame:
    """Second-source ids with a tag object of that name; unreadable JSON tags nothing.

    Only cells whose text holds the label, or an escape that could spell it, are
    worth parsing.
    """
    cell = F.col("genres")
    candidates = details.filter(F.contains(F.lower(cell), F.lit(label.lower())) | F.contains(cell, F.lit("\\")))
    hits = candidates.filter(F.exists(tag_names(cell), lambda name: is_label(name, label)))
    return hits.select(F.col("id").alias("tmdb_id"))


def label_ids(genres: DataFrame, label: str = EXCLUDED_LABEL) -> DataFrame:
    """Dictionary ids that stand for the label."""
    return genres.filter(is_label(F.col("name"), label)).select(F.col("id").alias("genre_id"))


def tagged_by_id(now_playing: DataFrame, genres: DataFrame, label: str = EXCLUDED_LABEL) -> DataFrame:
    """Second-source ids listed with a tag id that stands for the label, once per listing and tag."""
    listed = now_playing.select(
        F.col("id").alias("tmdb_id"), F.explode(id_tags(F.col("genre_ids"))).alias("genre_id")
    )
    return listed.join(label_ids(genres, label), "genre_id", "left_semi").select("tmdb_id")


def excluded_ids(
    title_basics: DataFrame,
    details: DataFrame,
    now_playing: DataFrame,
    genres: DataFrame,
    kept: KeptTables,
    label: str = EXCLUDED_LABEL,
) -> ExcludedIds:
    """Close the tagged ids over the identity link between the sources.

    A second-source id links to at most one first-source id, so one step each
    way reaches the closure.
    """
    direct = kept.keep(
        "tagged_tmdb",
        tagged_by_name(details, label).union(tagged_by_id(now_playing, genres, label)).distinct(),
    )
    links = details.filter(F.col("imdb_id").isNotNull()).select(F.col("id").alias("tmdb_id"), "imdb_id")
    imdb = kept.keep(
        "excluded_imdb",
        tagged_in_list(title_basics, label)
        .union(sized_join(links, direct, "tmdb_id", "left_semi").select("imdb_id"))
        .filter(F.col("imdb_id").isNotNull())
        .distinct(),
    )
    tmdb = kept.keep(
        "excluded_tmdb",
        direct.union(sized_join(links, imdb, "imdb_id", "left_semi").select("tmdb_id")).distinct(),
    )
    return filtered(ExcludedIds(imdb, tmdb), kept)


def filtered(excluded: ExcludedIds, kept: KeptTables) -> ExcludedIds:
    """The id sets with a kept filter of each one that is too large to broadcast."""
    held = {}
    for source, ids in (("imdb", excluded.imdb), ("tmdb", excluded.tmdb)):
        if not fits_broadcast(ids):
            held[f"{source}_filter"] = kept.keep(f"{source}_filter", id_filter(ids, f"{source}_id"))
    return excluded._replace(**held)


def tagged_union(excluded: ExcludedIds) -> DataFrame:
    """Both id sets as one relation; the other source's column is NULL."""
    imdb = excluded.imdb.select("imdb_id", F.lit(None).cast("bigint").alias("tmdb_id"))
    tmdb = excluded.tmdb.select(F.lit(None).cast("string").alias("imdb_id"), "tmdb_id")
    return imdb.unionByName(tmdb)
