"""The public contract: every semantic and field check over one set of public results."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogmart.operators import contract
from catalogmart.operators.checks import counted
from catalogmart.plans import public


def _desc(column: str):
    return F.col(column).desc_nulls_last()


# list -> (identity, order, columns the list restarts within)
RANKED_LISTS = {
    "top_years": ("year", lambda: [_desc("avg_rating"), F.col("year").asc()], []),
    "top_movies": ("movie_id", lambda: [_desc("rating"), _desc("votes"), F.col("movie_id").asc()], []),
    "people": ("person_id", lambda: [_desc("avg_rating"), F.col("person_id").asc()], ["role"]),
    "recommendations": (
        "movie_id",
        lambda: [_desc("rating"), _desc("votes"), _desc("popularity"), F.col("movie_id").asc(), F.col("rank").asc()],
        ["region"],
    ),
}
# list -> (identity, published order)
UNRANKED_LISTS = {
    "rating_bins": ("order", lambda: [F.col("order").asc()]),
    "genre_ratings": ("genre", lambda: [_desc("avg_rating"), F.col("genre").asc()]),
    "genre_runtimes": ("genre", lambda: [_desc("avg_runtime_minutes"), F.col("genre").asc()]),
    "decade_counts": ("decade", lambda: [F.col("decade").asc()]),
    "decade_ratings": ("decade", lambda: [F.col("decade").asc()]),
    "region_counts": ("region", lambda: [F.col("region").asc()]),
}
#: list -> columns that must hold calendar dates.
DATES = {
    "recommendations": ["release_date"],
    "captures": ["min_capture_date", "max_capture_date"],
    "latest_snapshot_date": ["latest_snapshot_date"],
}
# list -> the order of its rows as a whole; ranks restart within it
LISTED_BY = {"top_years": ["rank"], "top_movies": ["rank"], "people": ["role", "rank"], "recommendations": ["region", "rank"]}
POSITION = public.POSITION
SCALARS = ("total_movies", "rated_movies", "avg_rating", "avg_runtime_minutes", "latest_snapshot_date")
HIGHLIGHTS = ("highest_rated_movie", "most_voted_movie")


def contract_issues(results: Mapping[str, DataFrame], instants: DataFrame | None = None) -> dict[str, DataFrame]:
    """Violating rows of every contract check, by check name; all empty means publishable.

    ``results`` holds the public result sets by name. The sets are bounded, so
    keep or cache them before running many checks. A list is checked for the
    order of its rows when it carries the ``position`` at which each was written;
    ``instants`` has the texts ``completed`` and ``exported`` of a publication.
    """
    r = results
    unplaced = lambda df: df if POSITION in df.columns else df.limit(0).withColumn(POSITION, F.lit(0))
    found = {f"one_row {name}": contract.not_one_row(r[name], name) for name in SCALARS}
    found |= {f"one_row {name}": contract.not_one_row(r[name], name, optional=True) for name in HIGHLIGHTS}
    for name, (identity, order, within) in RANKED_LISTS.items():
        found[f"identity {name}"] = contract.repeated_identities(r[name], identity, within)
        found[f"ranks {name}"] = contract.broken_ranks(r[name], order(), within)
        listed = [F.col(c).asc() for c in LISTED_BY[name]]
        found[f"order {name}"] = contract.broken_ranks(unplaced(r[name]), listed, rank=POSITION)
    for name, (identity, order) in UNRANKED_LISTS.items():
        found[f"identity {name}"] = contract.repeated_identities(r[name], identity)
        found[f"order {name}"] = contract.broken_ranks(unplaced(r[name]), order(), rank=POSITION)
    for name, columns in DATES.items():
        texts = r[name].select(*[F.col(c).cast("string").alias(c) for c in columns])
        found[f"dates {name}"] = reduce(DataFrame.unionAll, [contract.impossible_dates(texts, c) for c in columns])
    if instants is not None:
        found["sequence"] = contract.sequence_issues(instants, "completed", "exported")
    population = r["rating_bins"].agg(F.max("population_count").alias("n"))
    found["populations"] = contract.population_chain(population, r["rated_movies"], r["total_movies"])
    found["bins"] = contract.bin_issues(r["rating_bins"].drop(POSITION))
    found["roles"] = contract.role_limit_issues(r["people"])
    found["regions"] = contract.region_coverage_issues(r["region_counts"], r["recommendations"])
    found["captures"] = contract.capture_issues(r["captures"], r["region_counts"])
    found["latest"] = contract.latest_mismatch(r["latest_snapshot_date"], r["captures"])
    for name, rules in public.FIELD_RULES.items():
        found[f"fields {name}"] = contract.field_rule_issues(r[name].drop(POSITION), rules)
    return found


def summary(results: Mapping[str, DataFrame], instants: DataFrame | None = None) -> DataFrame:
    """(check, violations) of every contract check."""
    return counted(contract_issues(results, instants), "check")
