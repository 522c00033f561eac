"""Business rules as Column expressions.

Every threshold is a parameter; the defaults are the catalogue's published
rules. Vote floors come in two kinds: "either source" floors admit a title when
one provider alone reaches its floor, the era floor looks at the preferred vote
count only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Published thresholds and vocabularies.
CATALOGUE_TYPES = ("movie", "tvMovie")
FALLBACK_TYPE = "tmdb_movie"
FALLBACK_ID_PREFIX = "tmdb_"
UNKNOWN_NAME = "Unknown"
RUNTIME_MINUTES = (40, 300)
FIRST_DECADE = 1890
DECADE_COUNT = 14
TOP_BRACKET = 9
RATING_LIMITS = (0, 10)
# (votes on the first source, votes on the second source)
GENRE_FLOOR = (1_000, 1_000)
DISTRIBUTION_FLOOR = (1_000, 500)
RECOMMENDATION_FLOOR = (10_000, 1_000)
HEADLINE_FLOOR = (100_000, 100_000)
# release year before -> votes needed; later years need ERA_FLOOR_LATEST
ERA_FLOORS = ((1900, 20), (1930, 50), (1950, 100), (1970, 500), (1990, 1_000))
ERA_FLOOR_LATEST = 10_000
# distinct titles a person needs in a role; other roles are not ranked
ROLE_MINIMUMS = {
    "actor": 5,
    "actress": 5,
    "archive_footage": 5,
    "casting_director": 5,
    "cinematographer": 4,
    "composer": 4,
    "director": 3,
    "editor": 5,
    "producer": 4,
    "production_designer": 4,
    "writer": 4,
}


def preferred_rating() -> Column:
    """First source's rating, else the second's."""
    return F.coalesce("imdb_avg_rating", "tmdb_avg_rating")


def preferred_votes() -> Column:
    """First source's votes, else the second's; independent of the rating."""
    return F.coalesce("imdb_num_of_votes", "tmdb_num_of_votes")


def has_rating() -> Column:
    return preferred_rating().isNotNull()


def has_votes() -> Column:
    return preferred_votes().isNotNull()


def either_votes_reach(floor: tuple[int, int]) -> Column:
    """True when one source alone reaches its floor; an unknown count never does."""
    first, second = floor
    return (F.col("imdb_num_of_votes") >= first) | (F.col("tmdb_num_of_votes") >= second)


def era_vote_floor(year: Column, floors=ERA_FLOORS, latest: int = ERA_FLOOR_LATEST) -> Column:
    """Votes a title of the given release year needs."""
    (first_year, first_votes), *later = floors
    votes = F.when(year < first_year, first_votes)
    for before, needed in later:
        votes = votes.when(year < before, needed)
    return votes.otherwise(latest)


def role_minimum(role: Column, minimums: dict[str, int] = ROLE_MINIMUMS) -> Column:
    """Titles needed in a role; NULL for a role that is not ranked."""
    needed = F.lit(None).cast("int")
    for value in sorted(set(minimums.values())):
        roles = [name for name, minimum in minimums.items() if minimum == value]
        needed = F.when(role.isin(roles), value).otherwise(needed)
    return needed


def runtime_eligible(minutes: Column, limits: tuple[int, int] = RUNTIME_MINUTES) -> Column:
    return minutes.between(*limits)


def decade_label(year: Column, first: int = FIRST_DECADE, count: int = DECADE_COUNT) -> Column:
    """'1890s'-style label inside the displayed range, else NULL."""
    start = year - year % 10
    return F.when(year.between(first, first + 10 * count - 1), F.concat(start.cast("string"), F.lit("s")))


def bracket_order(rating: Column) -> Column:
    """Bin number; the top bin is closed, so exactly 10 shares it with 9.x."""
    return F.least(F.lit(TOP_BRACKET), F.floor(rating).cast("int"))


def bracket_label(rating: Column, limits: tuple[int, int] = RATING_LIMITS) -> Column:
    """'7-8'-style bin label; NULL outside the rating scale."""
    low = bracket_order(rating)
    label = F.concat(low.cast("string"), F.lit("-"), (low + 1).cast("string"))
    return F.when(rating.between(*limits), label)
