"""Search responses to organisation sightings and page facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from placeledger.fixed_values import PROVIDER
from placeledger.functions import jsons as J
from placeledger.functions.text import let
from placeledger.operators.stage import stage


def response_status(body: Column) -> Column:
    """Outcome of a response envelope: `empty` for payload code 404, `error` for any
    other code from 400 or a missing result or items that are no list, else `ok`."""
    code = J.get(body, "$.meta.code", "int")
    result, items = J.get(body, "$.result"), J.get(body, "$.result.items")
    return (
        F.when(body.isNull(), "error")
        .when(code == 404, "empty")
        .when(code >= 400, "error")
        .when(result.isNull(), "error")
        .when(items.isNotNull() & ~J.is_array(items), "error")
        .otherwise("ok")
    )


# One walk over an item reads all fields of a sighting, instead of one walk a field.
_ITEM = """struct<id:variant,name:variant,address:variant,address_name:variant,point:struct<lat:double,lon:double>,
    description:variant,schedule:variant,org:variant>"""
_CONTACT_GROUPS = "array<struct<contacts:array<struct<type:variant,value:variant,text:variant,comment:variant>>>>"


def address_of(address: Column, address_name: Column) -> Column:
    """Address text: of an object its name, of a text itself, else `address_name`."""
    primary = let(address, lambda a: F.when(J.is_object(a), J.get(a, "$.name")).otherwise(a))
    return J.scalar_text(F.coalesce(J.if_truthy(primary), address_name))


def rubric_names(item: Column) -> Column:
    """Names of the item's rubric objects, order kept."""
    rubrics = J.get(item, "$.rubrics", "array<struct<name:variant>>")
    names = F.transform(F.coalesce(rubrics["name"], F.array().cast("array<variant>")), J.if_truthy)
    return F.transform(F.filter(names, lambda n: n.isNotNull()), J.scalar_text)


def category_names(item: Column) -> Column:
    """Wider category rule: rubrics then categories, an object by name or else alias,
    a scalar as text."""
    entries = F.concat(J.elements(item, "$.rubrics"), J.elements(item, "$.categories"))

    def label(entry: Column) -> Column:
        named = J.first_truthy(J.get(entry, "$.name"), J.get(entry, "$.alias"))
        return F.when(J.is_object(entry), J.scalar_text(named)).when(
            J.truthy(entry), J.scalar_text(entry)
        )

    return F.filter(F.transform(entries, label), lambda c: c.isNotNull())


def contact_entries(item: Column) -> Column:
    """Contact objects of all groups, in order, as struct(type, value, comment)."""
    groups = F.filter(J.get(item, "$.contact_groups", _CONTACT_GROUPS)["contacts"], lambda g: g.isNotNull())
    entries = F.transform(
        F.flatten(groups),
        lambda c: F.struct(
            F.coalesce(J.scalar_text(c["type"]), F.lit("")).alias("type"),
            J.scalar_text(F.coalesce(J.if_truthy(c["value"]), c["text"])).alias("value"),
            J.scalar_text(c["comment"]).alias("comment"),
        ),
    )
    entries = F.coalesce(entries, F.array().cast("array<struct<type:string,value:string,comment:string>>"))
    return F.filter(entries, lambda c: c["value"].isNotNull())


def _first_value(entries: Column, *types: str) -> Column:
    return F.get(F.filter(entries, lambda c: c["type"].isin(*types)), F.lit(0))["value"]


def parse_search(responses: DataFrame, page_size: int = 10) -> tuple[DataFrame, DataFrame]:
    """Landed search responses to (sightings, pages).

    `pages` keeps one row per response with its status, item count and whether more
    pages follow; `sightings` has one row per organisation of a good response. Both
    are narrow steps over the scan, nothing is shuffled.
    """
    read = stage(responses, _body=J.lenient("body"))
    read = stage(read, _status=response_status(F.col("_body")))
    ok = F.col("_status") == "ok"
    items = F.when(
        ok, F.filter(J.elements(F.col("_body"), "$.result.items"), J.is_object)
    ).otherwise(F.array().cast("array<variant>"))
    read = stage(read, _items=items)
    n_items = F.size("_items")
    total = F.when(ok, F.coalesce(J.get(F.col("_body"), "$.result.total", "bigint"), n_items)).otherwise(0)
    pages = read.select(
        "region_id", "grid_cell_id", "query", "page",
        F.col("_status").alias("status"),
        n_items.cast("bigint").alias("n_items"),
        total.cast("bigint").alias("total"),
        has_next_page(F.col("page"), page_size, total, n_items).alias("has_next_page"),
    )
    exploded = read.select(
        "region_id", "grid_cell_id", "query", "page", "source_url", "fetched_at",
        F.posexplode("_items").alias("item_pos", "item"),
    )
    item = F.col("item")
    exploded = stage(exploded, _contacts=contact_entries(item), _read=J.get(item, "$", _ITEM))

    def read_text(name: str) -> Column:
        return J.scalar_text(F.col("_read")[name])

    sightings = exploded.select(
        "region_id", "page", "item_pos",
        F.lit(PROVIDER).alias("external_source"),
        read_text("id").alias("external_id"),
        F.coalesce(read_text("name"), F.lit("")).alias("name"),
        address_of(F.col("_read.address"), F.col("_read.address_name")).alias("address"),
        F.col("_read.point.lat").alias("latitude"),
        F.col("_read.point.lon").alias("longitude"),
        _first_value(F.col("_contacts"), "phone", "phone_number").alias("phone"),
        _first_value(F.col("_contacts"), "website", "site").alias("website"),
        F.transform(
            F.filter("_contacts", lambda c: c["type"].isin("social", "instagram", "vk")),
            lambda c: c["value"],
        ).alias("social_links"),
        rubric_names(item).alias("categories"),
        read_text("description").alias("description"),
        read_text("schedule").alias("working_hours"),
        read_text("org").alias("branch_info"),
        F.to_json(item).alias("raw_payload"),
        "source_url",
        F.col("query").alias("discovered_query"),
        F.col("grid_cell_id").alias("discovered_grid_cell_id"),
        "fetched_at",
    )
    return sightings, pages


def has_next_page(page: Column, page_size: int, total: Column, n_items: Column) -> Column:
    """More pages follow when the total is not covered yet and the page was not empty."""
    return (page * page_size < total) & (n_items > 0)


def scan_coverage(pages: DataFrame, max_pages: int = 1) -> DataFrame:
    """Per cell and query: pages read, items seen, and whether results were left out
    because reading stopped at `max_pages`."""
    last = F.max_by("has_next_page", "page")
    return pages.groupBy("grid_cell_id", "query").agg(
        F.max("page").alias("pages_read"),
        F.sum("n_items").alias("items_seen"),
        last.alias("has_more"),
        (last & (F.max("page") >= max_pages)).alias("cut_by_limit"),
    )
