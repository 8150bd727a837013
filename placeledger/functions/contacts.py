"""Contact normalisation as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from placeledger.fixed_values import SOCIAL_HOSTS
from placeledger.functions.text import blank_to_null, col, let, normalize_phone, strip
from placeledger.functions.urls import normalize_url, split_url

EMAIL = r"(?U)^[^@\s]+@[^@\s]+\.[^@\s]+$"


def normalize_email(value: Column | str) -> Column:
    """Lower case; NULL unless it looks like an address."""
    text = F.lower(strip(value))
    return F.when(F.rlike(text, F.lit(EMAIL)), text)


def link_type(url: Column | str, social_hosts: list[str] = SOCIAL_HOSTS) -> Column:
    """`social` when the host is one of the networks, else `website`."""
    return F.when(F.lower(split_url(url)["host"]).isin(social_hosts), "social").otherwise("website")


def normalize_contact(contact_type: Column | str, value: Column | str) -> Column:
    """struct(contact_type, display_value, normalized_value); NULL when not valid.

    Phone and e-mail types are routed by the given type, everything else must be a URL.
    """
    def contact(c: Column) -> Column:
        shown, kind = c["shown"], c["kind"]
        route = F.when(kind.isin("phone", "phone_number"), "phone").when(kind.isin("email", "mail"), "email")
        normalized = (
            F.when(route == "phone", normalize_phone(shown))
            .when(route == "email", normalize_email(shown))
            .otherwise(normalize_url(shown))
        )
        return let(
            normalized,
            lambda n: F.when(
                n.isNotNull(),
                F.struct(
                    F.coalesce(route, link_type(n)).alias("contact_type"),
                    shown.alias("display_value"),
                    n.alias("normalized_value"),
                ),
            ),
        )

    cleaned = F.struct(
        F.coalesce(F.lower(strip(contact_type)), F.lit("")).alias("kind"),
        blank_to_null(strip(value)).alias("shown"),
    )
    return let(cleaned, contact)


def split_contact(df, contact_type: str, value: str):
    """Add the three fields of `normalize_contact` to `df`, invalid rows removed."""
    parsed = df.withColumn("_contact", normalize_contact(col(contact_type), col(value)))
    return (
        parsed.filter("_contact IS NOT NULL")
        .withColumns({n: F.col(f"_contact.{n}") for n in ("contact_type", "display_value", "normalized_value")})
        .drop("_contact")
    )
