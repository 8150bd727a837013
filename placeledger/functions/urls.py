"""URL splitting, normalisation, redaction and relative resolution as Columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from placeledger.functions.text import blank_to_null, col, let, strip

_PARTS = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(?s:.*))?$"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _PARTS, group)


def split_url(url: Column | str) -> Column:
    """struct(scheme, host, path, query); the last path segment loses its `;params`.

    `host` is the whole authority and NULL when the text is no absolute URL.
    """
    return let(
        col(url),
        lambda u: F.struct(
            F.lower(_part(u, 1)).alias("scheme"),
            blank_to_null(_part(u, 2)).alias("host"),
            F.regexp_replace(_part(u, 3), ";[^/]*$", "").alias("path"),
            _part(u, 4).alias("query"),
        ),
    )


def _query_suffix(query: Column) -> Column:
    return F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))


def build_url(scheme: Column, host: Column, path: Column, query: Column) -> Column:
    return F.concat(scheme, F.lit("://"), host, path, _query_suffix(query))


def _with_scheme(text: Column, has_scheme) -> Column:
    return let(text, lambda t: F.when(has_scheme(t), t).otherwise(F.concat(F.lit("https://"), t)))


def normalize_url(value: Column | str) -> Column:
    """Comparable form of a URL: https when no scheme, lower-case scheme and host, no
    trailing slash, no params or fragment, query kept; NULL without a host."""
    text = F.regexp_replace(strip(value), r"[\t\r\n]", "")
    url = _with_scheme(text, lambda t: F.contains(t, F.lit("://")))
    return let(
        split_url(url),
        lambda p: build_url(
            p["scheme"], F.lower(p["host"]), F.regexp_replace(p["path"], "/+$", ""), p["query"]
        ),
    )


def page_url(value: Column | str) -> Column:
    """Fetchable page address: https when no scheme, `/` for an empty path, no
    fragment; NULL unless http(s) with a host. Letter case is kept."""
    url = _with_scheme(strip(value), lambda t: F.rlike(t, F.lit(r"^[A-Za-z][A-Za-z0-9+.\-]*:")))
    return let(
        split_url(url),
        lambda p: F.when(
            p["scheme"].isin("http", "https"),
            build_url(
                p["scheme"], p["host"], F.when(p["path"] == "", "/").otherwise(p["path"]), p["query"]
            ),
        ),
    )


def _decode(c: Column) -> Column:
    """Percent and plus decoding; text that is not well encoded stays as it is."""
    return F.coalesce(F.try_url_decode(c), c)


def _encode(c: Column) -> Column:
    """Form encoding that leaves `~` alone and encodes `*`."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _query_pairs(query: Column) -> Column:
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    return F.transform(
        pairs,
        lambda p: F.struct(
            _decode(F.regexp_extract(p, "^([^=]*)", 1)).alias("key"),
            _decode(F.regexp_replace(p, "^[^=]*=?", "")).alias("value"),
        ),
    )


def _join_pairs(pairs: Column) -> Column:
    return F.array_join(
        F.transform(pairs, lambda p: F.concat(_encode(p["key"]), F.lit("="), _encode(p["value"]))), "&"
    )


def _rewrite_query(url: Column | str, pairs_of) -> Column:
    return let(
        split_url(url),
        lambda p: build_url(
            p["scheme"], p["host"], p["path"], _join_pairs(pairs_of(_query_pairs(p["query"])))
        ),
    )


def redact_url(url: Column | str, secret_words: tuple[str, ...] = ("key", "token")) -> Column:
    """Replace the value of every query key that contains a secret word."""
    pattern = F.lit("|".join(secret_words))

    def redacted(p: Column) -> Column:
        value = F.when(F.rlike(F.lower(p["key"]), pattern), "REDACTED").otherwise(p["value"])
        return F.struct(p["key"].alias("key"), value.alias("value"))

    return _rewrite_query(url, lambda pairs: F.transform(pairs, redacted))


def drop_query_keys(url: Column | str, keys: tuple[str, ...] = ("key",)) -> Column:
    """The URL without the named query keys."""
    return _rewrite_query(url, lambda pairs: F.filter(pairs, lambda p: ~p["key"].isin(*keys)))


def _tidy_path(path: Column) -> Column:
    """Resolve `.` and `..` segments of an absolute path."""
    def step(done: Column, segment: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return (
            F.when(segment == ".", done)
            .when(segment == "..", up)
            .otherwise(F.concat(done, F.array(segment)))
        )

    def tidy(segments: Column) -> Column:
        kept = F.aggregate(segments, F.array().cast("array<string>"), step)
        folder = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit("")))
        return F.concat(kept, F.coalesce(folder, F.array().cast("array<string>")))

    return F.concat(F.lit("/"), F.array_join(let(F.split(F.substr(path, F.lit(2)), "/"), tidy), "/"))


def resolve_link(base: Column | str, href: Column | str) -> Column:
    """Absolute http(s) form of `href` seen on page `base`, without params or fragment;
    NULL for other schemes."""
    scheme_re = r"^([A-Za-z][A-Za-z0-9+.\-]*):"

    def parts(target: Column) -> Column:
        relative = F.regexp_replace(target, scheme_re, "")
        return F.struct(
            target.alias("target"),
            F.lower(F.regexp_extract(target, scheme_re, 1)).alias("scheme"),
            relative.startswith("//").alias("has_host"),
            F.regexp_extract(relative, r"^([^?]*)", 1).alias("path"),
            F.regexp_extract(relative, r"^[^?]*\?((?s:.*))$", 1).alias("query"),
        )

    def absolute(b: Column, t: Column) -> Column:
        foreign = (t["scheme"] != "") & (t["scheme"] != b["scheme"])
        base_path = F.when(b["path"] == "", "/").otherwise(b["path"])
        nearby = F.concat(F.regexp_replace(base_path, "[^/]*$", ""), t["path"])
        merged = F.when(t["path"] == "", base_path).otherwise(
            # Doubled slashes survive in absolute paths but not in merged ones.
            _tidy_path(
                F.when(t["path"].startswith("/"), t["path"]).otherwise(F.regexp_replace(nearby, "/{2,}", "/"))
            )
        )
        query = F.when((t["path"] == "") & (t["query"] == ""), b["query"]).otherwise(t["query"])
        return (
            F.when(t["has_host"] & (t["scheme"] != ""), t["target"])
            .when(t["has_host"], F.concat(b["scheme"], F.lit(":"), t["target"]))
            # "http:page" on an http page is a relative reference, as in browsers.
            .when(~foreign, build_url(b["scheme"], b["host"], merged, query))
        )

    target = F.regexp_replace(col(href), "(?s)#.*$", "")
    return page_url(
        let(split_url(base), lambda b: let(let(target, parts), lambda t: absolute(b, t)))
    )
