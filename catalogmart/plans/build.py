"""The whole catalogue from nine raw relations.

Each relation is an attribute built on first use. Staging stays a view. Results
that several relations read are kept as written tables, so one build computes
the exclusion set, the merged catalogue and its facts once. Given ``LayerTables``
the curated and analytics relations become the tables of a build instead.
Several threads may build relations of one catalogue side by side.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor, wait
from functools import wraps
from threading import Lock, RLock

from pyspark.sql import DataFrame, SparkSession

from catalogmart.operators.exclusion import ExcludedIds, excluded_ids
from catalogmart.plans import curated, declared, kpis, marts, public, staging
from catalogmart.sources.tables import KeptTables


#: Relations built at the same time; each is a few Spark jobs.
SIDE_BY_SIDE = 8


class built_once:
    """An attribute built on first use. Whoever else asks meanwhile waits for it; attributes need each other without cycles."""

    def __init__(self, build):
        self.build, self.name = build, build.__name__

    def __get__(self, owner, _=None):
        if owner is None:
            return self
        with owner.lock(self.name):
            if self.name not in owner.__dict__:
                owner.__dict__[self.name] = self.build(owner)
            return owner.__dict__[self.name]


def _stored(how: str):
    def mark(build):
        @wraps(build)
        def get(self):
            return getattr(self.kept, how)(build.__name__, build(self))

        return built_once(get)

    return mark


kept = _stored("keep")  # several relations read it
layered = _stored("layer")  # a relation of the curated or analytics layer, read where needed


class Catalogue:
    """Staging, curated, mart and KPI relations over ``raw``, by relation name."""

    def __init__(self, spark: SparkSession, raw: Mapping[str, DataFrame], kept: KeptTables | None = None):
        self.raw = raw
        self.kept = kept or KeptTables(spark, declared.watched())
        self._locks, self._guard = defaultdict(RLock), Lock()

    def lock(self, name: str) -> RLock:
        with self._guard:
            return self._locks[name]

    def build(self, names: Iterable[str]) -> None:
        """Build the relations, those that do not need each other side by side.

        A relation that fails takes along those that need it; the others are
        finished before the first failure is raised.
        """
        with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
            running = [pool.submit(getattr, self, name) for name in names]
            wait(running)
        for relation in running:
            relation.result()

    @built_once
    def excluded(self) -> ExcludedIds:
        raw = self.raw
        return excluded_ids(raw["title_basics"], raw["details"], raw["now_playing"], raw["genres"], self.kept)

    # staging -----------------------------------------------------------------
    @built_once
    def stg_name_basics(self) -> DataFrame:
        return staging.stg_name_basics(self.raw["name_basics"])

    @built_once
    def stg_title_basics(self) -> DataFrame:
        return staging.staged_titles("title_basics", self.raw["title_basics"], self.excluded)

    @built_once
    def stg_title_akas(self) -> DataFrame:
        return staging.staged_titles("title_akas", self.raw["title_akas"], self.excluded)

    @built_once
    def stg_title_crew(self) -> DataFrame:
        return staging.staged_titles("title_crew", self.raw["title_crew"], self.excluded)

    @built_once
    def stg_title_principals(self) -> DataFrame:
        return staging.staged_titles("title_principals", self.raw["title_principals"], self.excluded)

    @built_once
    def stg_title_ratings(self) -> DataFrame:
        return staging.staged_titles("title_ratings", self.raw["title_ratings"], self.excluded)

    @built_once
    def stg_details(self) -> DataFrame:
        return staging.stg_details(self.raw["details"], self.excluded)

    @built_once
    def stg_genres(self) -> DataFrame:
        return staging.stg_genres(self.raw["genres"])

    @built_once
    def stg_now_playing(self) -> DataFrame:
        return staging.stg_now_playing(self.raw["now_playing"], self.excluded)

    # Projections without exclusion, for joins from the merged catalogue. Its ids
    # hold no excluded title: the excluded sets are closed over the identity link.
    @built_once
    def _principals(self) -> DataFrame:
        return staging.projected("title_principals", self.raw["title_principals"])

    @built_once
    def _ratings(self) -> DataFrame:
        return staging.projected("title_ratings", self.raw["title_ratings"])

    @built_once
    def _details(self) -> DataFrame:
        return staging.projected("details", self.raw["details"])

    # curated -----------------------------------------------------------------
    @kept
    def dim_movies(self) -> DataFrame:
        return curated.dim_movies(self.stg_details, self.stg_title_basics, self.kept)

    @layered
    def dim_person(self) -> DataFrame:
        return curated.dim_person(self.stg_name_basics)

    @layered
    def dim_genre(self) -> DataFrame:
        return curated.dim_genre(self.stg_title_basics, self.kept)

    @kept
    def bridge_movie_genres(self) -> DataFrame:
        return curated.bridge_movie_genres(self.stg_title_basics, self.stg_details)

    @layered
    def bridge_movie_people(self) -> DataFrame:
        return curated.bridge_movie_people(self.dim_movies, self._principals)

    @kept
    def fct_movie_ratings(self) -> DataFrame:
        return curated.fct_movie_ratings(self.dim_movies, self._ratings, self._details)

    @kept
    def fct_now_playing(self) -> DataFrame:
        return curated.fct_now_playing(self.stg_now_playing, self.dim_movies)

    # marts -------------------------------------------------------------------
    @layered
    def average_rating_by_genre(self) -> DataFrame:
        return marts.average_rating_by_genre(self.bridge_movie_genres, self.fct_movie_ratings)

    @layered
    def average_runtime_by_genre(self) -> DataFrame:
        return marts.average_runtime_by_genre(self.bridge_movie_genres, self.dim_movies)

    @layered
    def decade_avg_rating(self) -> DataFrame:
        return marts.decade_avg_rating(self.era_ratings)

    @layered
    def no_of_movies_every_decade(self) -> DataFrame:
        return marts.no_of_movies_every_decade(self.dim_movies)

    @layered
    def mart_rating_distribution(self) -> DataFrame:
        return marts.mart_rating_distribution(self.fct_movie_ratings)

    @layered
    def mart_top_movies(self) -> DataFrame:
        return marts.mart_top_movies(self.fct_movie_ratings, self.dim_movies, self.kept)

    # The headline floor admits few titles. Kept step by step, the planner knows how
    # few: it finds their catalogue rows and then their credits without shuffling
    # the catalogue or the credits.
    @kept
    def headline_ratings(self) -> DataFrame:
        return marts.headline_ratings(self.fct_movie_ratings)

    @kept
    def headline_titles(self) -> DataFrame:
        return marts.headline_titles(self.dim_movies, self.headline_ratings)

    @layered
    def mart_top_people(self) -> DataFrame:
        return marts.mart_top_people(self._principals, self.headline_titles, self.dim_person)

    @kept
    def era_ratings(self) -> DataFrame:
        return marts.era_ratings(self.dim_movies, self.fct_movie_ratings)

    @layered
    def mart_top_years(self) -> DataFrame:
        return marts.mart_top_years(self.era_ratings)

    @layered
    def mart_now_playing_recommendations(self) -> DataFrame:
        return marts.mart_now_playing_recommendations(self.fct_now_playing, self.fct_movie_ratings)

    # KPIs --------------------------------------------------------------------
    @layered
    def average_runtime(self) -> DataFrame:
        return kpis.average_runtime(self.dim_movies)

    @layered
    def avg_movie_rating(self) -> DataFrame:
        return kpis.avg_movie_rating(self.fct_movie_ratings)

    @layered
    def highest_rated_movie(self) -> DataFrame:
        return kpis.highest_rated_movie(self.fct_movie_ratings, self.dim_movies, self.kept)

    @layered
    def most_popular_movie(self) -> DataFrame:
        return kpis.most_popular_movie(self.fct_movie_ratings, self.dim_movies, self.kept)

    @layered
    def latest_now_playing_snapshot(self) -> DataFrame:
        return kpis.latest_now_playing_snapshot(self.fct_now_playing)

    @layered
    def number_of_movies_now_playing(self) -> DataFrame:
        return kpis.number_of_movies_now_playing(self.fct_now_playing)

    @layered
    def rated_movies(self) -> DataFrame:
        return kpis.rated_movies(self.fct_movie_ratings)

    @layered
    def top_recommended_now_playing_movie(self) -> DataFrame:
        return marts.top_recommended_now_playing_movie(self.fct_now_playing, self.fct_movie_ratings)

    @layered
    def top_rated_genre(self) -> DataFrame:
        return kpis.top_rated_genre(self.bridge_movie_genres, self.fct_movie_ratings)

    @layered
    def total_genres(self) -> DataFrame:
        return kpis.total_genres(self.dim_genre)

    @layered
    def total_movies(self) -> DataFrame:
        return kpis.total_movies(self.dim_movies)

    # public results ----------------------------------------------------------
    @built_once
    def public_results(self) -> dict[str, DataFrame]:
        """Every public result set, kept so that all contract checks see the same rows; lists have their written positions."""
        with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
            return dict(zip(public.RESULT_NAMES, pool.map(self._published, public.RESULT_NAMES)))

    def _published(self, name: str) -> DataFrame:
        rows = public.result(name, self)
        return self.kept.keep_listed(f"public_{name}", rows, public.POSITION) if name in public.ORDER else self.kept.keep(f"public_{name}", rows)
