"""Text expressions for names, addresses, links and repeated values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Link pattern of a map marker and the lengths beyond which names are tidied.
MARKER_PATTERN = r"ll=([0-9\.\-]+),([0-9\.\-]+)"
LONG_NAME = 100
LONG_ALIAS = 200


def title_case(c: Column) -> Column:
    """Upper-case every letter that follows a non-letter; lower-case the other letters."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(
        F.transform(runs, lambda x: F.concat(F.upper(F.left(x, F.lit(1))), F.lower(F.substr(x, F.lit(2))))), ""
    )


def slug(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit(" "), F.lit("-"))


def first_integer(c: Column) -> Column:
    return F.regexp_extract(c, r"\d+", 0).try_cast("int")


def marker_coordinates(link: Column) -> Column:
    """struct(lat, long) from a marker link; a link without coordinates gives NULLs."""
    return F.struct(
        F.regexp_extract(link, MARKER_PATTERN, 1).try_cast("double").alias("lat"),
        F.regexp_extract(link, MARKER_PATTERN, 2).try_cast("double").alias("long"),
    )


def trailing_coordinates(link: Column, mark: str) -> Column:
    """struct(lat, long) from the text after the last `mark`, which reads 'lat,long'."""
    pair = F.split(F.substring_index(link, mark, -1), ",")
    return F.struct(
        F.get(pair, F.lit(0)).try_cast("double").alias("lat"),
        F.get(pair, F.lit(1)).try_cast("double").alias("long"),
    )


def address_block(c: Column) -> Column:
    """struct(province, address) of a text block: second-last line, and all lines but the last."""
    lines = F.split(c, "\n")
    return F.struct(
        F.try_element_at(lines, F.lit(-2)).alias("province"),
        F.array_join(F.slice(lines, F.lit(1), F.size(lines) - 1), ", ").alias("address"),
    )


def attribute(markup: Column, name: str) -> Column:
    """Value of the first attribute of that name; NULL when there is none."""
    return F.nullif(F.regexp_extract(markup, rf'\b{name}="([^"]*)"', 1), F.lit(""))


def attribute_coordinates(markup: Column, lat: str = "data-lat", long: str = "data-lng") -> Column:
    """struct(lat, long) from two attributes."""
    return F.struct(
        attribute(markup, lat).try_cast("double").alias("lat"), attribute(markup, long).try_cast("double").alias("long"))


def path_segment(link: Column, from_end: int) -> Column:
    """Segment of a '/'-separated link counted from its end (1 is the last); NULL when too short."""
    return F.try_element_at(F.split(link, "/"), F.lit(-from_end))


def bucket_and_key(link: Column) -> Column:
    """struct(bucket, key) of an object URL; up to two leading slashes of the key are dropped.

    A link that is no URL gives NULLs.
    """
    return F.struct(
        F.try_parse_url(link, F.lit("HOST")).alias("bucket"),
        F.regexp_replace(F.try_parse_url(link, F.lit("PATH")), "^/{1,2}", "").alias("key"),
    )


def collapse_long(c: Column, longer_than: int) -> Column:
    """Collapse white space, but only in texts longer than the limit."""
    return F.when(F.length(c) > longer_than, F.regexp_replace(c, r"\s+", " ")).otherwise(c)


def join_values(values: Column, separator: str = "; ") -> Column:
    """Repeated values as one text; no values give '' rather than NULL."""
    return F.coalesce(F.array_join(values, separator), F.lit(""))


def join_present(parts: Column, separator: str) -> Column:
    """Like join_values, but blank and missing parts leave no separator behind."""
    return join_values(F.filter(parts, lambda x: x.isNotNull() & (x != "")), separator)


def or_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))
