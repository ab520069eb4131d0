"""String helpers used by lookups and loaders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the source system.
DEFAULT_MEMBER = "None"            # name of the default dimension member
INACTIVE_USER_MARKER = "[X]"       # display-name suffix of a deactivated user
NAME_JUNK_PATTERN = "[^A-Za-z0-9 ]+"  # characters removed from epic and board names
KEY_SEPARATOR = "-"                # project key prefix separator in ticket keys


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trimmed(x: str | Column) -> Column:
    """PostgreSQL trim(): spaces only (tabs kept), same as Spark's trim."""
    return F.trim(_c(x))


def or_default(x: str | Column) -> Column:
    """``COALESCE(trim(x), 'None')`` - lookup side of the default member."""
    return F.coalesce(trimmed(x), F.lit(DEFAULT_MEMBER))


def clean_name(x: str | Column) -> Column:
    return F.regexp_replace(_c(x), NAME_JUNK_PATTERN, "")


def key_prefix(x: str | Column) -> Column:
    """``split_part(key, '-', 1)``."""
    return F.split_part(_c(x), F.lit(KEY_SEPARATOR), F.lit(1))


def option_ids(x: str | Column) -> Column:
    """Ids out of an option list: JSON as landed, ``[{"value":"A","id":"12"}]`` (or
    one object), or rendered, ``[<Option: value='A', id='12'>, <Option: value='B', id='13'>]``.

    In rendered text the id is always the last attribute of an option, so anchoring on ``'>``
    keeps labels that contain ``id``, ``=`` or quotes from breaking the parse.
    """
    text = _c(x)
    listed = F.when(text.startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).when(text.startswith("[{"), text)
    landed = F.transform(F.from_json(listed, "array<struct<id:string>>", {"mode": "FAILFAST"}), lambda o: o["id"])
    return F.when(listed.isNull(), F.regexp_extract_all(text, F.lit(r"id='([^']*)'>"), 1)).otherwise(landed)
