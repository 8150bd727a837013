"""Lenient JSON access: anything malformed reads as empty, never as an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from placeledger.functions.text import blank_to_null, col, let, strip


def lenient(text: Column | str) -> Column:
    """Text as VARIANT, NULL when it is no JSON. Documents that repeat a key need the
    session's `spark.sql.variant.allowDuplicateKeys` (see `placeledger.session`)."""
    return F.try_parse_json(col(text))


def lenient_object(text: Column | str) -> Column:
    """Text as VARIANT, NULL unless it is a JSON object."""
    return let(lenient(text), lambda x: F.when(is_object(x), x))


def kind_of(v: Column) -> Column:
    """object, array, string, number, boolean or null; NULL for a missing value. Reads
    the whole value, so containers of any size are asked `is_object` or `is_array`."""
    return let(
        F.schema_of_variant(v),
        lambda schema: F.when(schema.isNull(), F.lit(None).cast("string"))
        .when(schema.startswith("OBJECT"), "object")
        .when(schema.startswith("ARRAY"), "array")
        .when(schema == "STRING", "string")
        .when(schema == "BOOLEAN", "boolean")
        .when(schema == "VOID", "null")
        .otherwise("number"),
    )


def is_object(v: Column) -> Column:
    """Looks at the value's own keys only, whatever it contains."""
    return F.try_variant_get(v, "$", "struct<>").isNotNull()


def is_array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>").isNotNull()


def get(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def elements(v: Column, path: str = "$") -> Column:
    """Elements of the array at `path`; empty when it is missing or no array."""
    return F.coalesce(get(v, path, "array<variant>"), F.array().cast("array<variant>"))


def objects_within(v: Column, keys: tuple[str, ...]) -> Column:
    """Objects met from a VARIANT down through lists and the values of `keys`, as an array
    in reading order: an object before what it holds, keys in the order given.

    A fold takes the containers of one level to those of the next until none is left; the
    text's opening brackets bound the number of levels. Nesting may have any depth that the
    parser allows; a missing value holds nothing.
    """
    level = "array<struct<place:array<int>,value:variant>>"

    def at(place: Column, value: Column, pos: Column) -> Column:
        return F.struct(F.concat(place, F.array(pos)).alias("place"), value.alias("value"))

    def inside(node: Column) -> Column:
        place, value = node["place"], node["value"]
        listed = F.transform(elements(value), lambda x, i: at(place, x, i))
        named = F.array(*[at(place, get(value, f"$['{k}']"), F.lit(n)) for n, k in enumerate(keys)])
        return F.filter(F.concat(listed, named), lambda n: is_object(n["value"]) | is_array(n["value"]))

    def descend(state: Column, _: Column) -> Column:
        todo = state["todo"]
        objects = F.filter(todo, lambda n: is_object(n["value"]))
        deeper = F.struct(
            F.flatten(F.transform(todo, inside)).alias("todo"), F.concat(state["found"], objects).alias("found"))
        return F.when(F.size(todo) == 0, state).otherwise(deeper)

    def in_order(state: Column) -> Column:
        before = lambda a, b: F.when(a["place"] < b["place"], -1).otherwise(1)
        return F.transform(F.array_sort(state["found"], before), lambda n: n["value"])

    def walk(value: Column) -> Column:
        top = F.array(F.struct(F.array().cast("array<int>").alias("place"), value.alias("value"))).cast(level)
        start = F.struct(top.alias("todo"), F.array().cast(level).alias("found"))
        brackets = F.length(F.regexp_replace(F.to_json(value), r"[^\[{]+", ""))
        return F.aggregate(F.sequence(F.lit(0), F.coalesce(brackets, F.lit(0))), start, descend, in_order)

    return let(v, walk)


def string_at(v: Column, path: str) -> Column:
    """The value at `path` if it is a string."""
    return let(get(v, path), lambda x: F.when(F.schema_of_variant(x) == "STRING", get(x, "$", "string")))


def _container(schema: Column) -> Column:
    return schema.startswith("OBJECT") | schema.startswith("ARRAY")


def scalar_text(v: Column) -> Column:
    """Text of a scalar, JSON of a container (keys sorted); NULL for JSON null.

    Branches go by how often they are met: a string, the usual case, is asked for its
    type and read, and nothing else is computed."""
    def text(x: Column) -> Column:
        schema = F.schema_of_variant(x)
        return (
            F.when(x.isNull(), F.lit(None).cast("string"))
            .when(schema == "STRING", get(x, "$", "string"))
            .when(schema == "VOID", F.lit(None).cast("string"))
            .when(schema == "BOOLEAN", F.initcap(get(x, "$", "string")))
            .when(_container(schema), F.to_json(x))
            .otherwise(number_text(x))
        )

    return let(v, text)


def number_text(v: Column) -> Column:
    """A JSON number in plain notation: no exponent, no padding zeros.

    Whole numbers of up to 38 digits and fractions of up to 18 places keep every digit;
    only a number beyond those is shown as the nearest double.
    """
    whole = get(v, "$", "decimal(38,0)")
    fraction = get(v, "$", "decimal(38,18)")
    double = get(v, "$", "double")
    plain = F.regexp_replace(fraction.cast("string"), r"0+$", "")
    tiny = (fraction == 0) & (double != 0)
    return (
        F.when(whole == double, whole.cast("string"))
        .when(fraction.isNotNull() & ~tiny, plain)
        .otherwise(double.cast("string"))
    )


def text_at(v: Column, path: str) -> Column:
    """`scalar_text` of the value at `path`."""
    return scalar_text(get(v, path))


def _truth(x: Column) -> Column:
    schema = F.schema_of_variant(x)
    return (
        F.when(x.isNull(), False)
        .when(schema == "STRING", get(x, "$", "string") != "")
        .when(schema == "VOID", False)
        .when(schema == "BOOLEAN", get(x, "$", "boolean"))
        .when(_container(schema), ~F.to_json(x).isin("{}", "[]"))
        .otherwise(F.coalesce(get(x, "$", "double") != 0, F.lit(False)))
    )


def truthy(v: Column) -> Column:
    """False for missing, null, false, zero, empty text and empty containers."""
    return let(v, _truth)


def if_truthy(v: Column) -> Column:
    """The VARIANT itself, NULL unless truthy."""
    return let(v, lambda x: F.when(_truth(x), x))


def first_truthy(*values: Column) -> Column:
    """First truthy VARIANT, NULL when none is."""
    return F.coalesce(*[if_truthy(v) for v in values])


def string_list(text: Column | str) -> Column:
    """JSON array text as array<string>, falsy items dropped; [] when it is no array."""
    items = F.filter(elements(lenient(text)), truthy)
    return F.transform(items, scalar_text)


def string_map(text: Column | str) -> Column:
    """JSON object text as map<string,string>; empty when it is no object."""
    parsed = F.from_json(F.to_json(lenient_object(text)), "map<string,string>")
    return F.coalesce(parsed, F.create_map().cast("map<string,string>"))


def sorted_json(m: Column) -> Column:
    """Map as JSON text with keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))))


def nonblank(c: Column) -> Column:
    return blank_to_null(strip(c))
