"""Extraction of records from landed documents: store pages, job postings, sanctions lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import texts
from ..schemas import JOB_COLUMNS
from .aggregates import latest_of
from .sequence import first_by_key


def stores(df: DataFrame, key: str, arrival: list[str], block: str, link: str) -> DataFrame:
    """One row per store, first seen wins: province and address from the text block, coordinates from the
    marker link."""
    first = first_by_key(df, [key], arrival)
    place, at = texts.address_block(F.col(block)), texts.marker_coordinates(F.col(link))
    return first.select(
        key, place["province"].alias("province"), place["address"].alias("address"), F.col(link).alias("map_url"),
        at["lat"].alias("latitude"), at["long"].alias("longitude"))


def store_cards(df: DataFrame, key: str, arrival: list[str], block: str, link: str, mark: str = "=") -> DataFrame:
    """Like `stores` for cards whose first two lines are name and address and whose link ends in the
    coordinates after the last `mark`."""
    first = first_by_key(df, [key], arrival)
    lines, at = F.split(F.col(block), "\n"), texts.trailing_coordinates(F.col(link), mark)
    return first.select(
        key, F.get(lines, F.lit(0)).alias("name"), F.get(lines, F.lit(1)).alias("address"),
        at["lat"].alias("latitude"), at["long"].alias("longitude"))


def stores_by_region(df: DataFrame, key: str, arrival: list[str], region_link: str, address: str, link: str) -> DataFrame:
    """Like `stores` where the province is the second-last part of the link of the region's list."""
    first, at = first_by_key(df, [key], arrival), texts.marker_coordinates(F.col(link))
    return first.select(
        key, texts.path_segment(F.col(region_link), 2).alias("province"), F.col(address).alias("address"),
        F.col(link).alias("map_url"), at["lat"].alias("latitude"), at["long"].alias("longitude"))


def stores_by_row(df: DataFrame, key: str, arrival: list[str], province: str, address: str, link: str,
                  mark: str = "=") -> DataFrame:
    """Like `stores` where rows carry their province and the link ends in the coordinates after the last
    `mark`, which is `=` or `/`."""
    first, at = first_by_key(df, [key], arrival), texts.trailing_coordinates(F.col(link), mark)
    return first.select(
        key, F.col(province).alias("province"), F.col(address).alias("address"), F.col(link).alias("map_url"),
        at["lat"].alias("latitude"), at["long"].alias("longitude"))


# Tag patterns. A section is the inner text of one element; DOTALL lets it span lines.
def element(html: Column, tag: str) -> Column:
    """Inner markup of the first element of that tag; NULL when there is none."""
    return F.nullif(F.regexp_extract(html, rf"(?s)<{tag}\b[^>]*>(.*?)</{tag}>", 1), F.lit(""))


def elements(html: Column, tag: str) -> Column:
    """Inner markup of every element of that tag, in document order."""
    return F.regexp_extract_all(html, F.lit(rf"(?s)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1))


def nested_elements(html: Column, tag: str) -> Column:
    """Inner markup of every outermost element of that tag, in document order, with the elements of the same tag that it
    holds: an element ends at the end tag that balances its start tag.

    The markup is cut before every start and end tag of that name, and one pass over the pieces keeps the depth. An end
    tag without a start is ignored, an element that is never closed goes on to the end, and a start tag that
    closes itself is an empty element. NULL markup gives NULL.
    """
    start, stop = rf"(?i)^<{tag}(?=[\s/>])[^>]*>", rf"(?i)^</{tag}\s*>"
    pieces = F.split(html, rf"(?i)(?=</?{tag}(?=[\s/>])[^>]*>)")
    nothing = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("held"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        opens, closes = x.rlike(start), x.rlike(stop)
        alone = opens & x.rlike(rf"(?i)^<{tag}[^>]*/>")
        inside, last = s["depth"] > 0, closes & (s["depth"] == 1)
        first = opens & ~inside
        none = F.array().cast("array<string>")
        depth = F.when(opens & ~alone, s["depth"] + 1).when(closes & inside, s["depth"] - 1).otherwise(s["depth"])
        held = F.when(last | (first & alone), none).when(first, F.array(F.regexp_replace(x, start, ""))).when(
            inside, F.concat(s["held"], F.array(x))).otherwise(none)
        out = F.when(last, F.concat(s["out"], F.array(F.array_join(s["held"], "")))).when(
            first & alone, F.concat(s["out"], F.array(F.lit("")))).otherwise(s["out"])
        return F.struct(depth.alias("depth"), held.alias("held"), out.alias("out"))

    def finish(s: Column) -> Column:
        return F.when(s["depth"] > 0, F.concat(s["out"], F.array(F.array_join(s["held"], "")))).otherwise(s["out"])

    return F.aggregate(pieces, nothing, step, finish)


def nested_element(html: Column, tag: str) -> Column:
    """Inner markup of the first outermost element of that tag; NULL when there is none."""
    return F.get(nested_elements(html, tag), F.lit(0))


def plain(markup: Column) -> Column:
    """Markup without tags."""
    return F.regexp_replace(markup, "<[^>]*>", "")


def job_postings(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """The 13 text columns of a posting from field expressions: arrays are joined, missing values are ''."""
    unknown = set(fields) - set(JOB_COLUMNS)
    if unknown:
        raise ValueError(f"not columns of a posting: {sorted(unknown)}")
    found = df.select("*", *[fields.get(c, F.lit(None).cast("string")).alias(c) for c in JOB_COLUMNS])
    types = dict(found.select(*[F.col(f"`{c}`") for c in JOB_COLUMNS]).dtypes)
    columns = []
    for c in JOB_COLUMNS:
        value = F.col(f"`{c}`")
        is_list = types[c].startswith("array")
        columns.append((texts.join_values(value, ", ") if is_list else texts.or_blank(value)).alias(c))
    return found.select(*df.columns, *columns)


def _joined(element_name: str) -> Column:
    """VALUE texts below every element of that name, joined."""
    return texts.join_values(F.flatten(F.col(f"{element_name}.VALUE")))


def _latest() -> Column:
    return latest_of(F.flatten(F.col("LAST_DAY_UPDATED.VALUE")))


def individuals(df: DataFrame) -> DataFrame:
    return df.select(
        "DATAID", "VERSIONNUM", "FIRST_NAME", "SECOND_NAME", "THIRD_NAME", "UN_LIST_TYPE", "REFERENCE_NUMBER",
        "LISTED_ON", "NAME_ORIGINAL_SCRIPT",
        _joined("TITLE").alias("TITLES"),
        _joined("DESIGNATION").alias("DESIGNATIONS"),
        _joined("NATIONALITY").alias("NATIONALITIES"),
        _joined("LIST_TYPE").alias("LIST_TYPES"),
        _latest().alias("LAST_DAYS_UPDATED"),
        F.lit("Individual").alias("TYPE"))


def entities(df: DataFrame) -> DataFrame:
    address = F.transform(
        "ENTITY_ADDRESS", lambda a: texts.join_present(F.array(a["STREET"], a["CITY"], a["COUNTRY"]), ", "))
    alias = texts.join_present(F.col("ENTITY_ALIAS.ALIAS_NAME"), "; ")
    return df.select(
        "DATAID", "VERSIONNUM",
        texts.collapse_long(F.col("FIRST_NAME"), texts.LONG_NAME).alias("FIRST_NAME"),
        "UN_LIST_TYPE", "REFERENCE_NUMBER", "LISTED_ON",
        _joined("LIST_TYPE").alias("LIST_TYPES"),
        _latest().alias("LAST_DAYS_UPDATED"),
        texts.collapse_long(alias, texts.LONG_ALIAS).alias("ALIAS_NAME"),
        texts.join_values(address).alias("ADDRESS"),
        F.lit("Entity").alias("TYPE"))


def sanctions(individual_rows: DataFrame, entity_rows: DataFrame) -> DataFrame:
    """Both lists by column name; columns one of them lacks are NULL."""
    return individual_rows.unionByName(entity_rows, allowMissingColumns=True)
