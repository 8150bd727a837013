"""Price evidence: structured rows, JSON-LD, and lines of page text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from placeledger.fixed_values import SOURCE_JSON_LD, SOURCE_PROVIDER, SOURCE_TEXT
from placeledger.functions import jsons as J
from placeledger.functions.html import candidate_lines, json_ld_blocks, visible_text
from placeledger.functions.text import blank_to_null, let, strip
from placeledger.operators.stage import stage

PRICE_KEYS = ("services", "prices", "service_prices", "menu")
# Below these keys JSON-LD holds further nodes, in this order.
LD_CHILDREN = ("itemListElement", "hasOfferCatalog", "@graph")
# Where a piece of evidence stands in reading order, compared field by field.
PLACE = "struct<page:bigint,part:int,block:int,pos:int>"


def _place(page: Column, part, block, pos) -> Column:
    as_int = lambda c: (F.lit(c) if isinstance(c, int) else c).cast("int")
    return F.struct(
        page.cast("bigint").alias("page"), as_int(part).alias("part"),
        as_int(block).alias("block"), as_int(pos).alias("pos"),
    )


def _first_string(v: Column, *keys: str) -> Column:
    return F.coalesce(*[blank_to_null(strip(J.string_at(v, f"$.{k}"))) for k in keys])


def _evidence_columns(df: DataFrame, price: Column, source_type: Column, line: Column) -> DataFrame:
    """Common layout; a price is kept as text, and as a number if it was one. Where `line`
    is not NULL the evidence is that line of text, its own name and price.

    `price_kind` is string, number, boolean or container. A boolean counts as a number
    without an amount; a container cannot be read as a price at all.
    """
    value = F.col("_price")
    priced = stage(df, _price=price, _line=line).filter("_price IS NOT NULL OR _line IS NOT NULL")
    text = F.coalesce("_line", J.scalar_text(value))
    read = stage(priced, _kind=F.when(F.col("_line").isNull(), J.kind_of(value)).otherwise("string"), price_text=text)
    return read.select(
        "salon_id", "place",
        F.col("name").alias("service_name_raw"),
        "price_text",
        F.when(F.col("_kind") == "number", J.get(value, "$", "double")).alias("price_number"),
        F.when(F.col("_kind").isin("object", "array"), "container").otherwise(F.col("_kind")).alias("price_kind"),
        source_type.alias("source_type"),
        "source_url",
        F.coalesce("_line", F.concat_ws(" ", "name", "price_text")).alias("evidence_text"),
    )


def _present(v: Column) -> Column:
    """A value that is neither missing nor JSON null."""
    return let(v, lambda x: F.when(J.kind_of(x) != "null", x))


def structured_evidence(payloads: DataFrame) -> DataFrame:
    """Service and price rows inside provider payloads (salon_id, page, source_url,
    payload). The price is the first truthy of price, amount, cost; a zero or empty
    `cost` is kept when nothing else is there."""
    items = stage(payloads, _payload=J.lenient_object("payload")).select(
        "salon_id", "page", "source_url",
        F.posexplode(J.elements(F.col("_payload"), "$.result.items")).alias("item_pos", "item"),
    )

    def ranked(rank: int):
        return lambda row, pos: F.struct(F.lit(rank).alias("rank"), pos.alias("pos"), row.alias("row"))

    per_key = [
        F.transform(J.elements(F.col("item"), f"$.{key}"), ranked(rank)) for rank, key in enumerate(PRICE_KEYS)
    ]
    rows = items.select("salon_id", "page", "source_url", "item_pos", F.inline(F.concat(*per_key)))
    named = stage(
        rows.select(
            "salon_id", "source_url", "row",
            _place(F.col("page"), F.col("item_pos"), F.col("rank"), F.col("pos")).alias("place"),
        ),
        name=_first_string(F.col("row"), "name", "title", "service"),
    ).filter("name IS NOT NULL")
    price = F.coalesce(
        J.first_truthy(J.get(F.col("row"), "$.price"), J.get(F.col("row"), "$.amount")),
        _present(J.get(F.col("row"), "$.cost")),
    )
    return _evidence_columns(named, price, F.lit(SOURCE_PROVIDER), F.lit(None).cast("string"))


def page_lines(pages: DataFrame, *keep: str, html: str = "html") -> DataFrame:
    """Candidate lines of the visible text of pages: the kept columns, pos, line."""
    lines = pages.select(*keep, visible_text(html).alias("_text"))
    return lines.select(*keep, F.posexplode(candidate_lines("_text")).alias("pos", "line"))


def _ld_pieces(html: str) -> Column:
    """Nodes of a page's JSON-LD blocks, at any depth, as pieces of the page."""
    def of_block(body: Column, block: Column) -> Column:
        nodes = J.objects_within(J.lenient(body), LD_CHILDREN)
        return F.transform(nodes, lambda node, pos: _piece(0, block, pos, node=node))

    return F.flatten(F.transform(json_ld_blocks(html), of_block))


def _line_pieces(html: str) -> Column:
    """Lines of a page's text that hold a number, as pieces of the page."""
    lines = F.transform(
        candidate_lines(visible_text(html)), lambda line, pos: _piece(1, F.lit(0), pos, line=line))
    return F.filter(lines, lambda piece: F.rlike(piece["line"], F.lit(r"(?U)\d")))


def _piece(part: int, block: Column, pos: Column, node: Column | None = None, line: Column | None = None) -> Column:
    missing = F.lit(None)
    return F.struct(
        F.lit(part).alias("part"), block.alias("block"), pos.alias("pos"),
        (missing.cast("variant") if node is None else node).alias("node"),
        (missing.cast("string") if line is None else line).alias("line"))


def _of_pieces(pages: DataFrame, pieces: Column) -> DataFrame:
    """Evidence in the pieces of pages: a node counts with the price of its `offers` if that
    is an object, else with its own; a line counts as it is."""
    read = pages.select("salon_id", "page_no", "source_url", F.inline(pieces))
    node, line = F.col("node"), F.col("line")
    named = stage(
        read.select(
            "salon_id", "source_url", "node", "line",
            _place(F.col("page_no"), F.col("part"), F.col("block"), F.col("pos")).alias("place"),
        ),
        name=F.coalesce(line, _first_string(node, "name", "title")),
    ).filter("name IS NOT NULL")
    offers = J.get(node, "$.offers")
    of_offers = F.coalesce(J.first_truthy(J.get(offers, "$.price")), _present(J.get(offers, "$.lowPrice")))
    of_node = F.when(J.is_object(offers), of_offers).otherwise(_present(J.get(node, "$.price")))
    source = F.when(F.col("_line").isNull(), SOURCE_JSON_LD).otherwise(SOURCE_TEXT)
    return _evidence_columns(named, F.when(line.isNull(), of_node), source, line)


def page_evidence(pages: DataFrame) -> DataFrame:
    """All evidence of pages (salon_id, page_no, source_url, html): JSON-LD nodes and lines of
    text. A page is read once, by one generator that gives both. No html, no evidence."""
    return _of_pieces(pages, F.concat(_ld_pieces("html"), _line_pieces("html")))


def json_ld_evidence(pages: DataFrame) -> DataFrame:
    """The JSON-LD side of `page_evidence`; a broken block gives nothing."""
    return _of_pieces(pages, _ld_pieces("html"))


def text_evidence(pages: DataFrame) -> DataFrame:
    """The text side of `page_evidence`; currency is optional in a price."""
    return _of_pieces(pages, _line_pieces("html"))
