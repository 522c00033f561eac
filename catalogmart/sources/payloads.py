"""Landed API payloads (one JSON text per row) to rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogmart.functions.text import LENIENT_JSON

# Fields of one title payload.
REQUIRED = (
    ("id", "bigint"),
    ("title", "string"),
    ("budget", "bigint"),
    ("revenue", "bigint"),
    ("release_date", "string"),
    ("runtime", "int"),
    ("status", "string"),
    ("original_language", "string"),
    ("vote_average", "double"),
    ("vote_count", "bigint"),
)
OPTIONAL = (("imdb_id", "string"), ("poster_path", "string"))
LISTS = ("origin_country", "production_countries", "production_companies", "genres")
DETAIL_COLUMNS = (
    "id",
    "imdb_id",
    "title",
    "budget",
    "revenue",
    "release_date",
    "runtime",
    "status",
    "original_language",
    "origin_country",
    "production_countries",
    "production_companies",
    "genres",
    "vote_average",
    "vote_count",
    "poster_path",
)
LISTING = (
    "page bigint, total_pages bigint, results array<struct<id:bigint,title:string,release_date:string,vote_average:double,"
    "vote_count:bigint,genre_ids:array<bigint>,overview:string,poster_path:string,popularity:double>>"
)


#: Page numbers are 32-bit whole numbers; a larger count is none and so damaged.
MOST_PAGES = 2**31 - 1
#: Page numbers that agree but for this many low bits are put in order together.
BLOCK_BITS = 16


def _has_required_keys(payload: Column) -> Column:
    """Every required key is present; a JSON null value is allowed."""
    keys = F.json_object_keys(payload)
    return reduce(lambda a, b: a & b, (F.array_contains(keys, name) for name, _ in REQUIRED))


def _date(text: Column) -> Column:
    """Blank means unknown; an impossible date becomes NULL."""
    return F.try_to_date(F.nullif(text, F.lit("")), "yyyy-MM-dd")


def flatten_details(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per title payload; list fields stay JSON text, a missing list is ``[]``.

    A payload without a required key is rejected; ``rejected_details`` returns it.
    """
    fields = [*REQUIRED, *OPTIONAL, *((name, "string") for name in LISTS)]
    schema = ", ".join(f"{name} {kind}" for name, kind in fields)
    accepted = payloads.filter(F.coalesce(_has_required_keys(F.col(payload)), F.lit(False)))
    parsed = accepted.select(F.from_json(payload, schema, LENIENT_JSON).alias("p")).select("p.*")
    lists = {name: F.coalesce(name, F.lit("[]")) for name in LISTS}
    return parsed.withColumns({**lists, "release_date": _date(F.col("release_date"))}).select(*DETAIL_COLUMNS)


def rejected_details(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Payloads that are no JSON object or miss a required key."""
    return payloads.filter(~F.coalesce(_has_required_keys(F.col(payload)), F.lit(False)))


def flatten_genres(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """``{"genres": [{id, name}]}`` payloads to (id, name) rows."""
    parsed = F.from_json(payload, "genres array<struct<id:bigint,name:string>>", LENIENT_JSON)
    return payloads.select(F.inline(parsed["genres"]))


def flatten_listing(pages: DataFrame, snapshot_date: Column, payload: str = "payload") -> DataFrame:
    """Result rows of all listing pages, tagged with their region and capture date.

    ``pages`` holds one page per row with its ``region``; all regions and pages
    flatten in one pass. ``listing_faults`` says what a listing lacks; it must be
    empty before the listing is loaded.
    """
    parsed = F.from_json(payload, LISTING, LENIENT_JSON)
    rows = pages.select("region", snapshot_date.alias("snapshot_date"), F.inline(parsed["results"]))
    return rows.select(
        "id",
        "title",
        _date(F.col("release_date")).alias("release_date"),
        "vote_average",
        "vote_count",
        F.to_json("genre_ids").alias("genre_ids"),
        "overview",
        "poster_path",
        "popularity",
        "region",
        "snapshot_date",
    )


def rejected_pages(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """Pages that ``flatten_listing`` cannot use whole, with the issue.

    ``unreadable``: no JSON object, no list of results or no page count;
    ``bad_item``: a result without a whole-number id.
    """
    parsed = F.from_json(payload, LISTING, LENIENT_JSON)
    whole = parsed["results"].isNotNull() & parsed["total_pages"].isNotNull()
    bad_item = F.exists(parsed["results"], lambda item: item["id"].isNull())
    issue = F.when(~F.coalesce(whole, F.lit(False)), "unreadable").when(bad_item, "bad_item")
    return pages.withColumn("issue", issue).filter("issue IS NOT NULL")


def _read_pages(pages: DataFrame, payload: str) -> DataFrame:
    """(region, page, total_pages, whole) of every page; a whole one has results and a page count."""
    parsed = F.from_json(payload, LISTING, LENIENT_JSON)
    whole = F.coalesce(parsed["results"].isNotNull() & parsed["total_pages"].isNotNull(), F.lit(False))
    return pages.select("region", parsed["page"].alias("page"), parsed["total_pages"].alias("total_pages"), whole.alias("whole"))


def page_gaps(pages: DataFrame, payload: str = "payload", most_pages: int = MOST_PAGES) -> DataFrame:
    """(region, first_page, last_page) of every stretch of page numbers that no page has, up to the region's count.

    The count is the largest stated one of at most ``most_pages``, by default every
    number that a page can have. Numbers are put in order within blocks, and of each
    block only the first meets those of the region's other blocks.
    """
    read = _read_pages(pages, payload)
    stated = F.when(F.col("total_pages").between(1, most_pages), F.col("total_pages"))
    counts = read.groupBy("region").agg(F.max(stated).alias("total")).filter("total IS NOT NULL")
    numbers = read.select("region", "page").filter(F.col("page").between(1, most_pages)).distinct()
    # The number behind the last page closes the last stretch.
    ends = counts.select("region", (F.col("total") + 1).alias("page"))
    inside = numbers.join(counts, "region").filter("page <= total").select("region", "page").unionByName(ends)
    # Region and block are one value here, or rows that lie by region would stay so.
    block = Window.partitionBy("_block")
    placed = inside.withColumn("_block", F.struct("region", F.shiftright("page", BLOCK_BITS))).withColumns(
        {"_before": F.lag("page").over(block.orderBy("page")), "_high": F.max("page").over(block)}
    )
    # The first number of a block has none before it there: the highest of the block before it is.
    edges = placed.filter("_before IS NULL OR _before < page - 1")
    first, together = F.col("_before").isNull(), F.when(F.col("_before").isNotNull(), F.col("_block"))
    high_before = F.lag("_high", 1, 0).over(Window.partitionBy("region", together).orderBy("page"))
    before = F.when(first, high_before).otherwise(F.col("_before"))
    stretches = edges.select("region", (before + 1).alias("first_page"), (F.col("page") - 1).alias("last_page"))
    return stretches.filter("first_page <= last_page")


def missing_pages(pages: DataFrame, payload: str = "payload", most_pages: int = MOST_PAGES) -> DataFrame:
    """(region, page) of every page up to the region's page count that did not land readable."""
    gaps = page_gaps(pages, payload, most_pages)
    # A stretch may be longer than an array can be, so it is listed in parts.
    length = 1 << BLOCK_BITS
    starts = F.explode(F.sequence("first_page", "last_page", F.lit(length).cast("bigint")))
    parts = gaps.select("region", starts.alias("first_page"), "last_page")
    end = F.least("last_page", F.col("first_page") + (length - 1))
    return parts.select("region", F.explode(F.sequence("first_page", end)).alias("page"))


def listing_faults(pages: DataFrame, regions: Sequence[str], payload: str = "payload", most_pages: int = MOST_PAGES) -> DataFrame:
    """(region, issue, first_page, last_page, pages) of all that a landed listing of the regions lacks; empty means whole.

    ``no_readable_page``: a wanted region has none; ``unwanted_region``: pages of
    another region; ``unnumbered``: readable pages without a number from 1 on;
    ``page_count``: pages that state no count from 1 to ``most_pages`` or not the
    region's; ``beyond_count``: pages with a number above it; ``missing``: a stretch
    of numbers that no page has; ``unreadable`` and ``bad_item`` as
    ``rejected_pages`` finds them.
    """
    wanted = pages.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, regions))).alias("region"))
    read = _read_pages(pages, payload).filter("whole")
    stated = F.when(F.col("total_pages").between(1, most_pages), F.col("total_pages"))
    counts = read.groupBy("region").agg(F.max(stated).alias("total"))
    known = read.withColumnRenamed("region", "_region").join(counts, F.col("_region").eqNullSafe(F.col("region")))
    own = F.coalesce(F.col("page") >= 1, F.lit(False))
    issues = {
        "unnumbered": ~own,
        "page_count": ~F.coalesce(F.col("total_pages") == F.col("total"), F.lit(False)),
        "beyond_count": own & (F.col("page") > F.col("total")),
        "unwanted_region": ~F.coalesce(F.col("region").isin(list(regions)), F.lit(False)),
    }
    named = F.explode(F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in issues.items()])))
    of_pages = known.select("region", named.alias("issue")).unionAll(rejected_pages(pages, payload).select("region", "issue"))
    nowhere = F.lit(None).cast("bigint")
    faults = of_pages.groupBy("region", "issue").agg(F.count(F.lit(1)).alias("pages"))
    lost = wanted.join(counts, "region", "left_anti").select("region", F.lit("no_readable_page").alias("issue"), F.lit(0).cast("bigint").alias("pages"))
    whole = faults.unionByName(lost).select("region", "issue", nowhere.alias("first_page"), nowhere.alias("last_page"), "pages")
    gaps = page_gaps(pages, payload, most_pages)
    length = F.col("last_page") - F.col("first_page") + 1
    return whole.unionAll(gaps.select("region", F.lit("missing"), "first_page", "last_page", length))


def rejected_genres(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Payloads without a readable list of genres."""
    parsed = F.from_json(payload, "genres array<struct<id:bigint,name:string>>", LENIENT_JSON)
    return payloads.filter(parsed["genres"].isNull())


def enrichment_keys(listing: DataFrame) -> DataFrame:
    """Distinct ids of the listing: the titles that need a detail row."""
    return listing.select("id").distinct()


def enrichment_gaps(listing: DataFrame, details: DataFrame) -> DataFrame:
    """Listed ids without a detail row; must be empty before details are replaced."""
    return enrichment_keys(listing).join(details.select("id"), "id", "left_anti")
