"""The declared data tests of all layers, as violation queries and as one summary."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogmart.operators import checks
from catalogmart.operators.exclusion import EXCLUDED_LABEL
from catalogmart.plans import marts
from catalogmart.plans.build import SIDE_BY_SIDE
from catalogmart.plans.declared import (
    ACCEPTED_VALUES,
    COLUMN_TESTS,
    COMPOSITE_KEYS,
    EXCLUSION_SCOPE,
    LABEL_SCOPE,
    RATING_COLUMNS,
    REFERENCES,
    VOTE_COLUMNS,
    kept_name,
)

def recommendation_order():
    return [
        F.col("avg_rating").desc_nulls_last(),
        F.col("num_of_votes").desc_nulls_last(),
        F.col("now_playing_popularity").desc_nulls_last(),
        F.col("movie_id").asc(),
        *marts.listing_ties(),
    ]


def rank_violations(movies: DataFrame, people: DataFrame, recommendations: DataFrame) -> DataFrame:
    """Stored ranks of the three published lists that their order does not give."""
    by_rating = [F.col("person_rating").desc_nulls_last(), F.col("person_id").asc()]
    lists = [
        checks.misranked_rows(movies, "movie", "movie_rank", marts.headline_order()),
        checks.misranked_rows(people, "people", "job_rank", by_rating, ["job_role"]),
        checks.misranked_rows(
            recommendations, "recommendation", "recommendation_rank", recommendation_order(), ["tmdb_region"]
        ),
    ]
    return reduce(DataFrame.unionByName, lists)


def violations(c) -> dict[str, DataFrame]:
    """Violating rows of every declared test of catalogue ``c``, by test name."""
    found = {}
    for relation, columns in COLUMN_TESTS.items():
        df = getattr(c, relation)
        for column, tests in columns.items():
            if "N" in tests:
                found[f"not_null {relation}.{column}"] = checks.null_rows(df, column)
            if "U" in tests:
                found[f"unique {relation}.{column}"] = checks.repeated_values(df, column)
    return {**found, **_wide_violations(c)}


def _wide_violations(c) -> dict[str, DataFrame]:
    """The tests that need more than one column or relation."""
    found = {}
    for (relation, column), accepted in ACCEPTED_VALUES.items():
        found[f"accepted_values {relation}.{column}"] = checks.unaccepted_values(getattr(c, relation), column, accepted)
    for (relation, column), (parent, field) in REFERENCES.items():
        found[f"relationships {relation}.{column}"] = checks.orphans(
            getattr(c, relation), column, getattr(c, parent), field
        )
    for relation, keys in COMPOSITE_KEYS.items():
        found[f"unique_key {relation}"] = checks.repeated_keys(getattr(c, relation), keys)
    ratings = c.fct_movie_ratings
    found["rating_range"] = checks.outside_range(ratings, "movie_id", RATING_COLUMNS)
    found["votes_nonnegative"] = checks.negative_values(ratings, "movie_id", VOTE_COLUMNS)
    found["label_excluded"] = checks.label_occurrences({r: getattr(c, r) for r in LABEL_SCOPE}, EXCLUDED_LABEL)
    found["ids_excluded"] = checks.excluded_occurrences({r: getattr(c, r) for r in EXCLUSION_SCOPE}, c.excluded)
    found["rank_order"] = rank_violations(c.mart_top_movies, c.mart_top_people, c.mart_now_playing_recommendations)
    found["histogram"] = checks.histogram_issues(c.mart_rating_distribution)
    return found


class _Tested:
    """A catalogue whose staged relations are kept with their tested columns alone.

    Staging is a view that excludes anew on every read; several tests read each
    relation, and all of them together need a few narrow columns.
    """

    def __init__(self, c):
        self._c = c

    def __getattr__(self, relation: str):
        df = getattr(self._c, relation)
        if relation in COLUMN_TESTS and relation.startswith("stg_"):
            wanted = {*COLUMN_TESTS[relation], *COMPOSITE_KEYS.get(relation, ()), "imdb_id", "tmdb_id", "genre_name"}
            df = self._c.kept.keep(kept_name(relation), df.select([name for name in df.columns if name in wanted]))
        setattr(self, relation, df)
        return df

    def keep_all(self, relations) -> None:
        """Build and keep the relations side by side."""
        self._c.build(relations)
        with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
            list(pool.map(partial(getattr, self), relations))


def observed_counts(c, relations=tuple(COLUMN_TESTS)) -> dict[str, int]:
    """Row counts by name that writing the relations of ``c`` has taken along; those not written have none."""
    taken = [c.kept.observed.get(kept_name(relation), {}) for relation in relations]
    return {name: n for counts in taken for name, n in counts.items()}


def _already_counted(counts: dict[str, int]) -> dict[str, int]:
    """Violations by test that follow from counts taken along; accepted values only where none is outside."""
    exact = ("not_null ", "rating_range", "votes_nonnegative")
    known = {name: n for name, n in counts.items() if name.startswith(exact) or (name.startswith("accepted_values ") and n == 0)}
    labels = [counts.get(f"label_excluded {relation}") for relation in LABEL_SCOPE]
    return known if None in labels else {**known, "label_excluded": sum(labels)}


def summary(c) -> DataFrame:
    """(test, violations) of every declared test.

    Staged relations are excluded once. Tests of single rows were counted while
    their relation was written, and cost no scan; the other column tests of a
    relation take one pass over it.
    """
    kept, c, tallied, names = c, _Tested(c), [], []
    c.keep_all(COLUMN_TESTS)
    given = _already_counted(observed_counts(kept))
    for relation, columns in COLUMN_TESTS.items():
        known = {f"not_null {relation}.{column}": column for column, tests in columns.items() if "N" in tests}
        known = {name: column for name, column in known.items() if name not in given}
        unique = {f"unique {relation}.{column}": column for column, tests in columns.items() if "U" in tests}
        keys = {f"unique_key {relation}": COMPOSITE_KEYS[relation]} if relation in COMPOSITE_KEYS else {}
        if known or unique or keys:
            tallied.append(checks.column_counts(getattr(c, relation), known, unique, keys, "test"))
            names += [*known, *unique, *keys]
    rest = {name: df for name, df in _wide_violations(c).items() if name not in names and name not in given}
    return checks.counted(rest, "test", tallied, names, given)
