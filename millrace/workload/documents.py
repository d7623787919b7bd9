"""Text expressions and extraction of records from pages and sanctions documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import texts
from ..functions.times import shifted_text
from ..operators import extract
from ..schemas import ENTITY, INDIVIDUAL
from ..session import new_folder
from ..sinks.files import write_csv, write_split
from ..sources.files import read_csv, read_elements
from .tables import table


def local_time_shift(spark, sf_dir):
    """Event times as ISO text moved to local time; purchases have no time."""
    iso = F.when(F.col("event_type") == "purchase", F.lit("")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return table(spark, sf_dir, "events").select("event_id", shifted_text(iso).alias("local_time"))


def title_case(spark, sf_dir):
    name = F.concat("p_name", F.lit(" ("), "p_type", F.lit(") "), F.lower("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", texts.title_case(name).alias("title"))


def path_parts(spark, sf_dir):
    place = texts.bucket_and_key(F.col("url"))
    return table(spark, sf_dir, "pages").select(
        "page_id", place["bucket"].alias("bucket"), place["key"].alias("key"))


def record_text(spark, sf_dir):
    """Fields of a JSON text with a default, slugs, formatted text and encoded records."""
    field = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select(
        "event_id", field.alias("k"), F.get_json_object("props", "$.none").alias("absent"),
        texts.slug(F.concat(F.initcap("event_type"), F.lit(" Of User "), "user_id")).alias("slug"),
        F.format_string("%s.%s@example.com", "event_type", field).alias("email"),
        F.to_json(F.struct("event_id", "event_type")).alias("encoded"))


def extract_coordinates(spark, sf_dir):
    """Coordinates from marker links, from the ends of query and path links, and from attributes."""
    pages = table(spark, sf_dir, "pages")
    lat, long = (F.col("page_id") % 90).cast("string"), (-(F.col("page_id") % 180)).cast("string")
    marker = F.when(F.length("html") % 2 == 0, F.concat(F.lit("https://maps.example/?z=3&ll="), lat, F.lit(".5,"), long))
    pair = F.concat(lat, F.lit(".25,"), long, F.lit(".5"))
    marked = F.concat(F.lit('<li data-lat="'), lat, F.lit('" data-lng="'), long, F.lit('">'), "html")
    links = pages.select(
        "page_id", marked.alias("item"), F.coalesce(marker, "url").alias("marker"), F.concat("url", F.lit("&q="), pair).alias("query"),
        F.concat("url", F.lit("/"), pair).alias("path"))
    found = {"marker": texts.marker_coordinates(F.col("marker")),
             "query": texts.trailing_coordinates(F.col("query"), "="),
             "path": texts.trailing_coordinates(F.col("path"), "/"),
             "item": texts.attribute_coordinates(F.col("item"))}
    return links.select("page_id", *[at[c].alias(f"{n}_{c}") for n, at in found.items() for c in ("lat", "long")])


def extract_address(spark, sf_dir):
    """Link texts of a page read as the lines of an address."""
    lines = F.array_join(extract.elements(F.col("html"), "a"), "\n")
    place = texts.address_block(lines)
    return table(spark, sf_dir, "pages").select(
        "page_id", place["province"].alias("province"), place["address"].alias("address"))


def extract_slug(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", texts.path_segment(F.col("url"), 2).alias("region"), texts.path_segment(F.col("url"), 9).alias("none"))


def first_integer(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", texts.first_integer(F.col("url")).alias("number"))


def store_rows(spark, sf_dir):
    """One store per host, the first page of a host giving its address and link."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"),
        F.array_join(extract.elements(F.col("html"), "a"), "\n").alias("block"),
        F.concat("url", F.lit("?ll=1.5,"), F.col("page_id").cast("string")).alias("link"))
    return extract.stores(pages, "host", ["page_id"], "block", "link").drop("map_url")


def store_cards(spark, sf_dir):
    """One card per host: its first two link texts, and coordinates at the end of its link."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"),
        F.array_join(extract.elements(F.col("html"), "a"), "\n").alias("block"),
        F.concat("url", F.lit("?at="), F.col("page_id").cast("string"), F.lit(",7.5")).alias("link"))
    return extract.store_cards(pages, "host", ["page_id"], "block", "link")


def _store_pages(spark, sf_dir, link):
    """One row per page: host, its first link text as address, and a link with coordinates made of its number."""
    return table(spark, sf_dir, "pages").select(
        "page_id", "url", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"),
        F.get(extract.elements(F.col("html"), "a"), F.lit(0)).alias("address"), link.alias("link"))


def store_regions(spark, sf_dir):
    """One store per host; its province is the part of its address before the page's name."""
    link = F.concat(F.lit("https://maps/?ll=2.25,-"), F.col("page_id").cast("string"), F.lit("&z=1"))
    pages = _store_pages(spark, sf_dir, link)
    return extract.stores_by_region(pages, "host", ["page_id"], "url", "address", "link").drop("map_url")


def store_marked(spark, sf_dir):
    """One store per host with the province in the row and coordinates after an equals sign."""
    pages = _store_pages(spark, sf_dir, F.concat(F.lit("https://maps/?q="), F.col("page_id").cast("string"), F.lit(",3.5")))
    pages = pages.withColumn("province", F.regexp_extract("host", "[^.]+$", 0))
    return extract.stores_by_row(pages, "host", ["page_id"], "province", "address", "link").drop("map_url")


def store_paths(spark, sf_dir):
    """The same with coordinates as the last part of the link's path."""
    pages = _store_pages(spark, sf_dir, F.concat(F.lit("https://maps/dir/"), F.col("page_id").cast("string"), F.lit(",4.5")))
    pages = pages.withColumn("province", F.regexp_extract("host", "[^.]+$", 0))
    return extract.stores_by_row(pages, "host", ["page_id"], "province", "address", "link", "/").drop("map_url")


def page_sections(spark, sf_dir):
    """Postings from whole pages: sections by element, list sections joined, missing sections ''."""
    html = F.col("html")
    postings = extract.job_postings(table(spark, sf_dir, "pages").select("page_id", "url", "html"), {
        "Job Title": extract.element(html, "h1"),
        "Job URL": F.col("url"),
        "Job Description": extract.element(html, "article"),
        "Candidate Requirements": extract.elements(html, "p"),
        "Benefits": F.transform(extract.elements(html, "li"), extract.plain),
        "Experience": extract.element(html, "table"),
    })
    names = {c: c.lower().replace(" ", "_") for c in postings.columns}
    return postings.drop("url", "html").toDF(*[names[c] for c in postings.columns if c not in ("url", "html")])


def page_nested_sections(spark, sf_dir):
    """Sections of one tag inside each other: links as cards, two deep, in an outer section of pages with scripts, unclosed
    paragraphs and other noise; the outer section, its cards and the text of the cards."""
    html = F.col("html")
    card = lambda x, i: F.concat(F.lit('<Section class="card"><section>'), x, F.lit("</section>"), i.cast("string"), F.lit("</section >"))
    cards = F.array_join(F.transform(extract.elements(html, "a"), card), "\n")
    wrapped = F.concat(F.lit('</section><section\nid="outer">'), cards, F.lit("</section><sections>"), html, F.lit("<section/><section>open"))
    found = table(spark, sf_dir, "pages").select("page_id", extract.nested_elements(wrapped, "section").alias("all"))
    inner = F.transform(extract.nested_elements(F.col("all")[0], "section"), lambda x: extract.nested_element(x, "section"))
    return found.select("page_id", F.col("all")[0].alias("outer_section"), F.size("all").cast("bigint").alias("n_sections"),
                        inner.alias("cards"), F.element_at("all", -1).alias("last_section"))


def page_output(spark, sf_dir):
    """Page records in one folder per language, read back with their folder value."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.regexp_extract("html", 'lang="([a-z]*)"', 1).alias("page"))
    folder = new_folder(spark, "pages")
    write_split(pages, folder, ["page"])
    return spark.read.schema("page_id bigint, url string, page string").parquet(folder)


def _list_file(spark, sf_dir) -> str:
    """Sanctions documents made from customers (individuals) and suppliers (entities)."""
    folder = new_folder(spark, "sanctions")

    def values(*columns):
        return F.struct(F.array(*columns).alias("VALUE"))

    even = F.col("c_nationkey") % 2 == 0
    key = F.col("c_custkey").cast("string")
    people = table(spark, sf_dir, "customer").select(
        key.alias("DATAID"), F.lit("1").alias("VERSIONNUM"), F.col("c_name").alias("FIRST_NAME"),
        F.col("c_mktsegment").alias("SECOND_NAME"), F.when(even, F.lit("Third")).alias("THIRD_NAME"),
        F.lit("List A").alias("UN_LIST_TYPE"), F.concat(F.lit("QDi."), key).alias("REFERENCE_NUMBER"),
        F.lit("2001-01-25").alias("LISTED_ON"), F.lit(None).cast("string").alias("NAME_ORIGINAL_SCRIPT"),
        F.when(even, F.array(values(F.lit("Mr"), F.lit("Dr")))).alias("TITLE"),
        F.array(values(F.col("c_mktsegment")), values(F.lit("Director"))).alias("DESIGNATION"),
        F.array(values(F.concat(F.lit("Nation "), "c_nationkey"))).alias("NATIONALITY"),
        F.array(values(F.lit("UN List"))).alias("LIST_TYPE"),
        F.when(F.col("c_nationkey") % 3 == 0, F.array(values(F.lit("2010-05-01"), F.lit("2012-03-04"))))
        .when(F.col("c_nationkey") % 3 == 1, F.array(values(F.lit("2011-07-08")))).alias("LAST_DAY_UPDATED"))
    people.write.format("xml").option("rootTag", "INDIVIDUALS").option("rowTag", "INDIVIDUAL").save(f"{folder}/people")

    odd = F.col("s_nationkey") % 2 == 1
    number = F.col("s_suppkey").cast("string")
    firms = table(spark, sf_dir, "supplier").select(
        number.alias("DATAID"), F.lit("2").alias("VERSIONNUM"),
        F.when(odd, F.concat_ws("  ", *["s_name"] * 7)).otherwise(F.concat("s_name", F.lit("  Ltd"))).alias("FIRST_NAME"),
        F.lit("List B").alias("UN_LIST_TYPE"), F.concat(F.lit("QDe."), number).alias("REFERENCE_NUMBER"),
        F.lit("2003-06-07").alias("LISTED_ON"), F.array(values(F.lit("UN List"))).alias("LIST_TYPE"),
        F.when(odd, F.array(values(F.lit("2015-01-02")), values(F.lit("2014-01-02")))).alias("LAST_DAY_UPDATED"),
        F.array(
            F.struct(F.lit("Good").alias("QUALITY"), F.col("s_name").alias("ALIAS_NAME")),
            F.struct(F.lit("Low").alias("QUALITY"), F.lit(None).cast("string").alias("ALIAS_NAME")),
            F.struct(F.lit("Good").alias("QUALITY"), F.concat(F.lit("AKA "), number).alias("ALIAS_NAME")),
        ).alias("ENTITY_ALIAS"),
        F.array(
            F.struct(F.when(odd, F.lit("1 Main St")).alias("STREET"), F.concat(F.lit("City "), number).alias("CITY"),
                     F.lit("Land").alias("COUNTRY")),
            F.struct(F.lit(None).cast("string").alias("STREET"), F.lit("Port").alias("CITY"),
                     F.lit(None).cast("string").alias("COUNTRY")),
        ).alias("ENTITY_ADDRESS"))
    firms.write.format("xml").option("rootTag", "ENTITIES").option("rowTag", "ENTITY").save(f"{folder}/firms")
    return folder


def sanctions_individuals(spark, sf_dir):
    return extract.individuals(
        read_elements(spark, f"{_list_file(spark, sf_dir)}/people", "INDIVIDUAL", INDIVIDUAL))


def sanctions_entities(spark, sf_dir):
    return extract.entities(read_elements(spark, f"{_list_file(spark, sf_dir)}/firms", "ENTITY", ENTITY))


def sanctions_union(spark, sf_dir):
    """Both lists as one CSV, read back."""
    folder = _list_file(spark, sf_dir)
    both = extract.sanctions(
        extract.individuals(read_elements(spark, f"{folder}/people", "INDIVIDUAL", INDIVIDUAL)),
        extract.entities(read_elements(spark, f"{folder}/firms", "ENTITY", ENTITY)))
    out = write_csv(both, f"{folder}/out")
    return read_csv(spark, out, both.schema).select("DATAID", "TYPE", "FIRST_NAME", "LAST_DAYS_UPDATED", "ADDRESS")


QUERIES = {f.__name__: f for f in (
    local_time_shift, title_case, path_parts, record_text, extract_coordinates, extract_address, extract_slug,
    first_integer, store_rows, store_cards, store_regions, store_marked, store_paths, page_sections, page_nested_sections, page_output, sanctions_individuals, sanctions_entities, sanctions_union,
)}

_LINKS = r"regexp_extract_all(html, '(?s)<a\b[^>]*>(.*?)</a>', 1)"


_STORE_PAGES = f"""WITH p AS (SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, {_LINKS}[1] AS address,
        string_split(url, '/') AS parts FROM pages),
    r AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id) AS n FROM p)"""


def _element(tag):
    return rf"regexp_extract(html, '(?s)<{tag}\b[^>]*>(.*?)</{tag}>', 1)"


def _elements(tag):
    return rf"regexp_extract_all(html, '(?s)<{tag}\b[^>]*>(.*?)</{tag}>', 1)"


_PERSON = """c_custkey AS k, CAST(c_custkey AS VARCHAR) AS "DATAID", 'Individual' AS "TYPE", c_name AS "FIRST_NAME",
    CASE c_nationkey % 3 WHEN 0 THEN '2012-03-04' WHEN 1 THEN '2011-07-08' END AS "LAST_DAYS_UPDATED\""""
_FIRM = """CAST(s_suppkey AS VARCHAR) AS "DATAID", 'Entity' AS "TYPE", CASE WHEN s_nationkey % 2 = 1
    THEN rtrim(repeat(s_name || ' ', 7)) ELSE s_name || '  Ltd' END AS "FIRST_NAME",
    CASE WHEN s_nationkey % 2 = 1 THEN '2015-01-02' END AS "LAST_DAYS_UPDATED",
    CASE WHEN s_nationkey % 2 = 1 THEN '1 Main St, ' ELSE '' END || 'City ' || s_suppkey || ', Land; Port' AS "ADDRESS\""""

ORACLES = {
    "local_time_shift": """SELECT event_id, CASE WHEN event_type <> 'purchase'
        THEN strftime(date_trunc('second', ts) + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') END AS local_time FROM events""",
    "title_case": r"""SELECT p_partkey, array_to_string([upper(x[1]) || lower(x[2:]) FOR x IN
        regexp_extract_all(p_name || ' (' || p_type || ') ' || lower(p_brand), '[A-Za-z]+|[^A-Za-z]+')], '') AS title
        FROM part""",
    "path_parts": r"""SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS bucket,
        regexp_replace(regexp_extract(url, '^https?://[^/]+(/[^?#]*)', 1), '^/{1,2}', '') AS key FROM pages""",
    "record_text": """SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS absent,
        event_type || '-of-user-' || user_id AS slug,
        event_type || '.' || json_extract_string(props, '$.k') || '@example.com' AS email,
        '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS encoded FROM events""",
    "extract_coordinates": """SELECT page_id,
        CASE WHEN length(html) % 2 = 0 THEN page_id % 90 + 0.5e0 END AS marker_lat,
        CASE WHEN length(html) % 2 = 0 THEN CAST(-(page_id % 180) AS DOUBLE) END AS marker_long,
        CAST((page_id % 90) || '.25' AS DOUBLE) AS query_lat, CAST(-(page_id % 180) || '.5' AS DOUBLE) AS query_long,
        CAST((page_id % 90) || '.25' AS DOUBLE) AS path_lat, CAST(-(page_id % 180) || '.5' AS DOUBLE) AS path_long,
        CAST(page_id % 90 AS DOUBLE) AS item_lat, CAST(-(page_id % 180) AS DOUBLE) AS item_long FROM pages""",
    "extract_address": f"""SELECT page_id, CASE WHEN len(l) >= 2 THEN l[len(l) - 1] END AS province,
        array_to_string(l[:len(l) - 1], ', ') AS address
        FROM (SELECT page_id, string_split(array_to_string({_LINKS}, chr(10)), chr(10)) AS l FROM pages)""",
    "extract_slug": """SELECT page_id, string_split(url, '/')[-2] AS region, CAST(NULL AS VARCHAR) AS none FROM pages""",
    "first_integer": r"""SELECT page_id, TRY_CAST(NULLIF(regexp_extract(url, '[0-9]+'), '') AS INTEGER) AS number
        FROM pages""",
    "store_rows": f"""WITH p AS (SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host,
            string_split(array_to_string({_LINKS}, chr(10)), chr(10)) AS l FROM pages),
        r AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id) AS n FROM p)
        SELECT host, CASE WHEN len(l) >= 2 THEN l[len(l) - 1] END AS province,
        array_to_string(l[:len(l) - 1], ', ') AS address, CAST(1.5 AS DOUBLE) AS latitude,
        CAST(page_id AS DOUBLE) AS longitude FROM r WHERE n = 1""",
    "store_cards": f"""WITH p AS (SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host,
            string_split(array_to_string({_LINKS}, chr(10)), chr(10)) AS l FROM pages),
        r AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id) AS n FROM p)
        SELECT host, l[1] AS name, l[2] AS address, CAST(page_id AS DOUBLE) AS latitude,
        CAST(7.5 AS DOUBLE) AS longitude FROM r WHERE n = 1""",
    "store_regions": f"""{_STORE_PAGES} SELECT host, CASE WHEN len(parts) >= 2 THEN parts[len(parts) - 1] END AS province, address,
        CAST(2.25 AS DOUBLE) AS latitude, CAST('-' || page_id AS DOUBLE) AS longitude FROM r WHERE n = 1""",
    "store_marked": f"""{_STORE_PAGES} SELECT host, regexp_extract(host, '[^.]+$') AS province, address,
        CAST(page_id AS DOUBLE) AS latitude, CAST(3.5 AS DOUBLE) AS longitude FROM r WHERE n = 1""",
    "store_paths": f"""{_STORE_PAGES} SELECT host, regexp_extract(host, '[^.]+$') AS province, address,
        CAST(page_id AS DOUBLE) AS latitude, CAST(4.5 AS DOUBLE) AS longitude FROM r WHERE n = 1""",
    "page_sections": f"""SELECT page_id, {_element("h1")} AS job_title, '' AS company_name, url AS job_url,
        {_element("article")} AS job_description, array_to_string({_elements("p")}, ', ') AS candidate_requirements,
        array_to_string([regexp_replace(x, '<[^>]*>', '', 'g') FOR x IN {_elements("li")}], ', ') AS benefits,
        '' AS location, '' AS work_location, '' AS salary, {_element("table")} AS experience,
        '' AS application_deadline, '' AS "domain", '' AS company_size FROM pages""",
    "page_nested_sections": rf"""SELECT page_id, array_to_string([
            '<Section class="card"><section>' || x || '</section>' || (i - 1) || '</section >' FOR x, i IN {_LINKS}], chr(10)) AS outer_section,
        CAST(3 AS BIGINT) AS n_sections, {_LINKS} AS cards, 'open' AS last_section FROM pages""",
    "page_output": """SELECT page_id, url, regexp_extract(html, 'lang="([a-z]*)"', 1) AS page FROM pages""",
    "sanctions_individuals": f"""SELECT * EXCLUDE (k) FROM (SELECT {_PERSON}, '1' AS "VERSIONNUM",
        c_mktsegment AS "SECOND_NAME", CASE WHEN c_nationkey % 2 = 0 THEN 'Third' END AS "THIRD_NAME",
        'List A' AS "UN_LIST_TYPE", 'QDi.' || c_custkey AS "REFERENCE_NUMBER", '2001-01-25' AS "LISTED_ON",
        CAST(NULL AS VARCHAR) AS "NAME_ORIGINAL_SCRIPT",
        CASE WHEN c_nationkey % 2 = 0 THEN 'Mr; Dr' ELSE '' END AS "TITLES",
        c_mktsegment || '; Director' AS "DESIGNATIONS", 'Nation ' || c_nationkey AS "NATIONALITIES",
        'UN List' AS "LIST_TYPES" FROM customer)""",
    "sanctions_entities": f"""SELECT {_FIRM}, '2' AS "VERSIONNUM", 'List B' AS "UN_LIST_TYPE",
        'QDe.' || s_suppkey AS "REFERENCE_NUMBER", '2003-06-07' AS "LISTED_ON", 'UN List' AS "LIST_TYPES",
        s_name || '; AKA ' || s_suppkey AS "ALIAS_NAME" FROM supplier""",
    "sanctions_union": f"""SELECT {_FIRM} FROM supplier UNION ALL BY NAME
        SELECT * EXCLUDE (k) FROM (SELECT {_PERSON} FROM customer)""",
}
