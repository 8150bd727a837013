"""Readers for landed payloads, pages and boundaries.

Each takes a path (batch) or, with `stream=True`, gives the streaming form of the same
rows. Raw text is kept as it came; parsing happens in `operators`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from placeledger import schemas
from placeledger.functions.urls import page_url, redact_url
from placeledger.operators.joins import lookup


def _reader(spark: SparkSession, stream: bool):
    return spark.readStream if stream else spark.read


def search_responses(spark: SparkSession, path: str, fmt: str = "json", stream: bool = False) -> DataFrame:
    """Landed search responses: request columns plus the response text in `body`."""
    return _reader(spark, stream).schema(schemas.SEARCH_RESPONSE).format(fmt).load(path)


def details_responses(spark: SparkSession, path: str, fmt: str = "json", stream: bool = False) -> DataFrame:
    """Landed details responses with their HTTP status and the response text in `body`."""
    return _reader(spark, stream).schema(schemas.DETAILS_RESPONSE).format(fmt).load(path)


def web_pages(spark: SparkSession, path: str, fmt: str = "parquet", stream: bool = False) -> DataFrame:
    """Fetched pages: url, html or the error that fetching it gave, and when it was fetched."""
    return _reader(spark, stream).schema(schemas.FETCHED_PAGE).format(fmt).load(path)


def planned_pages(frontier: DataFrame, fetched: DataFrame) -> DataFrame:
    """The pages that were planned for salons (salon_id, page_no, url) with their last fetch, as
    `plans.pricing` reads them; one that was never fetched has the error `not fetched`.

    URLs meet in redacted form. A page of many salons, as a chain has, is kept once until
    the join; of equally old fetches one with html wins, then the greatest html.
    """
    newest = F.struct("fetched_at", F.col("html").isNotNull(), "html")
    last = fetched.select(redact_url(page_url("url")).alias("url"), "html", "fetch_error", "fetched_at").groupBy("url").agg(
        F.max_by(F.struct("html", "fetch_error"), newest).alias("_page"))
    return lookup(frontier, last, "url", "left").select(
        "salon_id", "page_no", F.col("url").alias("source_url"), "_page.html",
        F.when(F.col("_page").isNull(), "not fetched").otherwise(F.col("_page.fetch_error")).alias("fetch_error"))


_POINT = "array<double>"
_BOUNDARY_FILE = f"""
    region_id bigint, region_name string, source string, fetched_at string,
    geometry struct<type:string,coordinates:variant>
"""


def boundaries(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """GeoJSON boundary documents as region_id plus rings; the first ring of a polygon
    is its outline, later ones are holes."""
    documents = spark.read.schema(_BOUNDARY_FILE).option("multiLine", multi_line).json(path)
    return rings_from_geojson(documents)


def rings_from_geojson(documents: DataFrame) -> DataFrame:
    """Polygon or MultiPolygon geometry to `rings` (see `schemas.BOUNDARY`)."""
    nested = "array<array<array<array<double>>>>"
    coordinates = F.col("geometry.coordinates")
    polygons = F.when(
        F.col("geometry.type") == "Polygon",
        F.array(F.try_variant_get(coordinates, "$", f"array<array<{_POINT}>>")),
    ).otherwise(F.try_variant_get(coordinates, "$", nested))
    # Rings are numbered over the whole geometry: the n-th polygon's ring m. Array positions
    # are 32 bits wide, so both fit one number.
    numbered = F.flatten(
        F.transform(
            polygons,
            lambda rings, n: F.transform(
                rings,
                lambda ring, m: F.struct(
                    F.shiftleft(n.cast("bigint"), 32).bitwiseOR(m.cast("bigint")).alias("ring_id"),
                    (m > 0).alias("is_hole"),
                    F.transform(
                        ring, lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat"))
                    ).alias("points"),
                ),
            ),
        )
    )
    return documents.select("region_id", numbered.alias("rings"))
