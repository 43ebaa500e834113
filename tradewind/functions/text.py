"""Text normalization as native expressions (no Python UDF)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes.
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def strip(text: Column | str) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


# A noncharacter marks where a word restarts; it never occurs in text.
_RESTART = "\uffff "


def title_case(text: Column) -> Column:
    """Upper-case the first letter of every run of cased letters and lower-case the rest.

    ``initcap`` restarts only after spaces; here a digit, quote or hyphen restarts too ("t-shirt 3d" ->
    "T-Shirt 3D"), so a marked space is put after each other run and taken out again.
    """
    marked = F.regexp_replace(text, r"([^\p{Lu}\p{Ll}\p{Lt}]+)", "$1" + _RESTART)
    return F.replace(F.initcap(marked), F.lit(_RESTART), F.lit(""))


def normalize_category(name: Column | str) -> Column:
    return title_case(strip(name))


def required(value: Column, field: str) -> Column:
    """The value itself; a NULL fails the job instead of slipping through."""
    return F.coalesce(value, F.raise_error(F.lit(f"{field} must not be NULL")))
