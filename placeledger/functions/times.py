"""Timestamps written in several ways, read as TIMESTAMP_NTZ."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from placeledger.functions.text import col, strip

_ISO = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?)?$"
_LOOSE = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
_OFFSET = r"(?<=[ T]\d{2}.{0,20})(Z|[+-]\d{2}(:?\d{2}(:?\d{2}(\.\d+)?)?)?)$"


def parse_datetime(c: Column | str) -> Column:
    """ISO 8601 or `Y-m-d H:M:S`. An offset is dropped, not applied; bad text is NULL."""
    text = strip(col(c).cast("string"))
    local = F.regexp_replace(text, _OFFSET, "")
    # An hour alone is valid ISO but not a valid cast: spell out the minutes.
    local = F.regexp_replace(local, r"^(\S{10}[ T]\d{2})$", "$1:00")
    local = F.replace(local, F.lit(","), F.lit("."))
    known = F.rlike(local, F.lit(_ISO)) | F.rlike(local, F.lit(_LOOSE))
    return F.when(known, local.try_cast("timestamp_ntz"))


def latest(*cols: Column | str) -> Column:
    """Latest of several written timestamps, missing ones ignored."""
    return F.greatest(*[parse_datetime(c) for c in cols])
