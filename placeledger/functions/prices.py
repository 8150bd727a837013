"""Price parsing and display as Column expressions."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column, functions as F

from placeledger.fixed_values import CURRENCY_WORDS, DEFAULT_CURRENCY, PRICE_RANGE, PRICE_SINGLE
from placeledger.functions.text import col, let, strip

PRICE_TYPE = (
    "struct<price_type:string,amount_minor:bigint,currency:string,"
    "range_min_minor:bigint,range_max_minor:bigint>"
)


# Decimal digits of all scripts, and the same in ASCII.
_DIGITS = [chr(c) for c in range(128, sys.maxunicode + 1) if unicodedata.decimal(chr(c), None) is not None]
_ASCII = "".join(str(unicodedata.decimal(d)) for d in _DIGITS)


def ascii_digits(text: Column) -> Column:
    """Digits of any script as 0 to 9. Most texts have ASCII only and skip the lookup."""
    foreign = F.rlike(text, F.lit(r"(?U)(?![0-9])\d"))
    return F.when(foreign, F.translate(text, "".join(_DIGITS), _ASCII)).otherwise(text)


def _minor(major: Column) -> Column:
    # An amount beyond 64 bits is no price.
    return F.when(major > 0, F.rint(major * 100).try_cast("long"))


def amount_to_minor(text: Column | str) -> Column:
    """Minor units of a written amount, halves to even. Only plain spaces may group
    digits; NULL when not positive or not a number."""
    plain = F.replace(F.replace(col(text), F.lit(" "), F.lit("")), F.lit(","), F.lit("."))
    plain = ascii_digits(strip(plain))
    number = F.when(F.rlike(plain, F.lit(r"^\d+(\.\d+)?$")), plain.try_cast("double"))
    return _minor(number)


def detect_currency(
    text: Column | str,
    words: dict[str, str] = CURRENCY_WORDS,
    default: str = DEFAULT_CURRENCY,
) -> Column:
    """Currency of the first known word in the text, else the default."""
    lower = F.lower(col(text))
    hits = [F.when(F.contains(lower, F.lit(word)), F.lit(code)) for word, code in words.items()]
    return F.coalesce(*hits, F.lit(default))


def _price(kind, amount=None, low=None, high=None, currency=None) -> Column:
    def bigint(c):
        return F.lit(None).cast("long") if c is None else c

    return F.struct(
        F.lit(kind).alias("price_type") if isinstance(kind, str) else kind.alias("price_type"),
        bigint(amount).alias("amount_minor"),
        currency.alias("currency"),
        bigint(low).alias("range_min_minor"),
        bigint(high).alias("range_max_minor"),
    )


def price_of_text(text: Column | str, default_currency: str = DEFAULT_CURRENCY) -> Column:
    """Price struct of a written price: a range if one is present, else a single
    amount that is `from` after its prefix and `exact` without; NULL when neither."""
    range_re, single_re = f"(?iuU){PRICE_RANGE}", f"(?iuU){PRICE_SINGLE}"

    def amounts(shown: Column) -> Column:
        return F.struct(
            (F.regexp_extract(shown, range_re, 1) != "").alias("is_range"),
            amount_to_minor(F.regexp_extract(shown, range_re, 1)).alias("first"),
            amount_to_minor(F.regexp_extract(shown, range_re, 2)).alias("second"),
            (F.regexp_extract(shown, single_re, 1) != "").alias("is_from"),
            amount_to_minor(F.regexp_extract(shown, single_re, 2)).alias("amount"),
            detect_currency(shown, default=default_currency).alias("currency"),
        )

    def price(a: Column) -> Column:
        low, high = F.least(a["first"], a["second"]), F.greatest(a["first"], a["second"])
        both = a["first"].isNotNull() & a["second"].isNotNull()
        return (
            F.when(a["is_range"], F.when(both, _price("range", None, low, high, a["currency"])))
            .when(a["amount"].isNull(), F.lit(None).cast(PRICE_TYPE))
            .when(a["is_from"], _price("from", a["amount"], a["amount"], None, a["currency"]))
            .otherwise(_price("exact", a["amount"], None, None, a["currency"]))
        )

    return let(strip(text), lambda shown: let(amounts(shown), price))


def price_of_number(number: Column | str, default_currency: str = DEFAULT_CURRENCY) -> Column:
    """Price struct of a JSON number: always `exact`; the amount is NULL at or below 0."""
    return _price("exact", _minor(col(number).cast("double")), None, None, F.lit(default_currency))


def parse_price(text: Column | str, number: Column | str | None = None) -> Column:
    """Price struct of a value that is either a number or a text."""
    if number is None:
        return price_of_text(text)
    return F.when(col(number).isNotNull(), price_of_number(number)).otherwise(price_of_text(text))


def whole_units(minor: Column | str) -> Column:
    """Floor of minor units to whole units, in integers."""
    minor = col(minor)
    return ((minor - F.pmod(minor, F.lit(100))) / 100).cast("long")


def _display(kind, amount, low, high, dash: str, exact_only: bool) -> Column:
    kind, amount, low, high = col(kind), col(amount), col(low), col(high)
    single = whole_units(amount).cast("string")
    shown = F.when(
        kind == "range",
        F.concat(whole_units(low).cast("string"), F.lit(dash), whole_units(high).cast("string")),
    ).when(kind == "from", F.concat(F.lit("от "), single))
    return shown.when(kind == "exact", single) if exact_only else shown.otherwise(single)


def display_price(kind, amount, low, high) -> Column:
    """Short form kept with the current state: `1500-1900`, `от 1500`, `1800`."""
    return _display(kind, amount, low, high, "-", exact_only=False)


def display_price_report(kind, amount, low, high) -> Column:
    """Report form: en dash in ranges, NULL for any other price type."""
    return _display(kind, amount, low, high, "–", exact_only=True)
