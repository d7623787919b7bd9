"""Scans of files: Parquet directories, CSV, JSON payloads, XML, object listings."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def file_name(path: Column, extension: str = "parquet") -> Column:
    """Name of the file, or of the dataset folder named like a file, in a path."""
    return F.regexp_extract(path, rf"([^/]+\.{extension})(/[^/]*)*$", 1)


def read_directory(spark: SparkSession, folder: str, prefix: str = "", extension: str = "parquet") -> DataFrame:
    """Every file of a folder whose name has the prefix and extension, with its path in `path`."""
    return spark.read.parquet(f"{folder}/{prefix}*.{extension}").select("*", F.col("_metadata.file_path").alias("path"))


def rows_per_file(df: DataFrame, extension: str = "parquet") -> DataFrame:
    """Rows of each file. Paths are counted first, so names are made once per path and not per row."""
    paths = df.groupBy("path").agg(F.count("*").alias("n"))
    return paths.groupBy(file_name(F.col("path"), extension).alias("file")).agg(F.sum("n").alias("rows"))


def read_split(spark: SparkSession, folder: str, column: str, prefix: str = "", **options: str) -> DataFrame:
    """Folder split by `column`; a prefix of the value selects sub-folders before anything is listed."""
    reader = spark.read.options(basePath=folder, **options)
    return reader.parquet(f"{folder}/{column}={prefix}*")


def read_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Union of the schemas of all files of a folder; a column a file lacks reads NULL."""
    return spark.read.option("mergeSchema", True).parquet(folder)


def read_partitions(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """Partitioned folder with declared types, so that an hour reads '05' rather than 5."""
    return spark.read.schema(schema).parquet(folder)


def covering_folders(start: datetime, end: datetime) -> list[str]:
    """Fewest year/month/day/hour folders that hold exactly the hours from `start` up to, not including, `end`; both are
    taken down to the hour."""
    at, end = (t.replace(minute=0, second=0, microsecond=0, tzinfo=None) for t in (start, end))
    parts = ("year={0:%Y}", "month={0:%m}", "day={0:%d}", "hour={0:%H}")
    folders = []
    while at < end:
        year = at.replace(year=at.year + 1, month=1, day=1, hour=0)
        month = at.replace(year=at.year + at.month // 12, month=at.month % 12 + 1, day=1, hour=0)
        day, hour = at.replace(hour=0) + timedelta(days=1), at + timedelta(hours=1)
        begins = ((at.month, at.day, at.hour) == (1, 1, 0), (at.day, at.hour) == (1, 0), at.hour == 0, True)
        depth, after = next((k, t) for k, (t, whole) in enumerate(zip((year, month, day, hour), begins, strict=True)) if whole and t <= end)
        folders.append("/".join(parts[: depth + 1]).format(at))
        at = after
    return folders


def read_declared(spark: SparkSession, folder: str, schema: StructType | str, start: datetime, end: datetime,
                  declared: tuple[datetime, datetime] | None = None, file_format: str = "parquet") -> DataFrame:
    """Rows of the hours from `start` to before `end` of a folder laid out by year, month, day and hour.

    The folders to read are computed from the range, cut to the `declared` one, so the root is never listed, however
    many hours it has; a computed folder that does not exist is left out. Types come from the schema, which also
    names the partition columns. Without any folder the result is empty.
    """
    if declared:
        start, end = max(start, declared[0]), min(end, declared[1])
    configuration, paths = spark._jsc.hadoopConfiguration(), []
    for name in covering_folders(start, end):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        if path.getFileSystem(configuration).exists(path):
            paths.append(f"{folder}/{name}")
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", folder).format(file_format).load(paths)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header; types are inferred when no schema is declared."""
    reader = spark.read.option("header", True)
    return reader.option("inferSchema", True).csv(path) if schema is None else reader.schema(schema).csv(path)


def read_payload(spark: SparkSession, path: str, schema: StructType | str, whole_file: bool = False) -> DataFrame:
    """JSON payloads, each an object or an array of objects, one per line or one per file."""
    return spark.read.schema(schema).option("multiLine", whole_file).json(path)


# An XML file beyond this size is cut; the longest text between two end tags that a cut may hold.
WHOLE_BYTES = 128 * 1024 ** 2
_PIECE_BYTES = 64 * 1024 ** 2


def read_elements(spark: SparkSession, path: str, tag: str, schema: StructType,
                  whole_bytes: int | None = None) -> DataFrame:
    """One row per XML element of that name, at any depth.

    Spark's XML source reads a file in one task. Files of more than `whole_bytes` (WHOLE_BYTES) are therefore read as text cut at the end tags,
    which every task finds by itself, and each piece is parsed alone. A first scan tells which of them `_plain` allows
    to be cut; the others, and small ones, go through the XML source. That stops where a file is not well-formed; in a cut file
    a malformed element spoils its own row only.
    """
    reader = spark.read.format("xml").option("rowTag", tag).schema(schema)
    whole_bytes, whole = WHOLE_BYTES if whole_bytes is None else whole_bytes, reader.load(path)
    found = spark.read.format("binaryFile").load(path).select("path", F.col("_metadata.file_path").alias("file"), "length")
    corrupt = spark.conf.get("spark.sql.columnNameOfCorruptRecord")
    if whole.columns != schema.names or corrupt in schema.names or found.filter(F.col("length") > whole_bytes).isEmpty():
        return whole  # the XML source alone fills other columns than those of the elements
    listed = found.collect()
    if any(set(r["path"]) & set("*?[]{}\\") for r in listed):  # names that cannot be given one by one
        return whole
    cut = _plain(_pieces(spark, [r["path"] for r in listed if r["length"] > whole_bytes], tag), tag)
    if not cut:
        return whole
    rest = [r["path"] for r in listed if r["file"] not in cut]
    text = F.concat(F.expr("substring(value, at)"), F.lit(f"</{tag}>"))
    rows = _pieces(spark, [r["path"] for r in listed if r["file"] in cut], tag).filter("at > 0").select(
        F.from_xml(text, schema).alias("row")).select(*[F.col("row").getField(c).alias(c) for c in schema.names])
    return rows.unionByName(reader.load(rest)) if rest else rows


def _start_tag(tag: str) -> str:
    return rf"<\Q{tag}\E(?=[\s/>])"


def _pieces(spark: SparkSession, paths: list[str], tag: str) -> DataFrame:
    """Texts of files between the end tags of that name, where their first start tag is, and the file's name and size. Texts
    longer than a piece may be are left out."""
    reader = spark.read.option("lineSep", f"</{tag}>").option("mapreduce.input.linerecordreader.line.maxlength", _PIECE_BYTES)
    return reader.text(paths).select(
        "value", F.regexp_instr("value", F.lit(_start_tag(tag))).alias("at"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))


def _plain(pieces: DataFrame, tag: str) -> set[str]:
    """Files that can be cut at the end tags: every piece has one start tag, but for what follows the last element, all bytes are
    there, and nothing needs what lies outside of an element or hides tags: comments, CDATA, document types, instructions,
    name prefixes, other encodings; nor are there empty elements of that name or end tags with blanks."""
    name, attributes = rf"\Q{tag}\E", r"""(?:\s+[^\s<>="':]+\s*=\s*(?:"[^"]*"|'[^']*'))*+"""
    odd = (rf"""<(?:!|\?(?!xml\s)|\?xml\s[^>]*encoding\s*=\s*["'](?!(?i:utf-8)["'])|/?[^\s<>/:]+:|/{name}\s"""
           rf"""|{name}{attributes}\s*/>)""")
    prefixed = rf"""<[^\s<>/]+{attributes}\s+[^\s<>="':/]+:"""  # an attribute, as an element's own; those outside do not matter
    seen = pieces.select(
        "file", "size", F.octet_length("value").alias("bytes"), F.regexp_count("value", F.lit(_start_tag(tag))).alias("starts"),
        (F.col("value").rlike(odd) | F.expr("substring(value, at)").rlike(prefixed)).alias("odd"))
    files = seen.groupBy("file", "size").agg(
        F.bool_or("odd").alias("odd"), F.sum("starts").alias("starts"), F.max("starts").alias("most"), F.count("*").alias("n"),
        F.sum("bytes").alias("bytes"))
    ends = (F.col("size") - F.col("bytes")) / len(f"</{tag}>".encode())
    ok = files.filter(~F.col("odd") & (F.col("most") == 1) & (F.col("starts") == ends) & ends.isin(F.col("n"), F.col("n") - 1))
    return {r["file"] for r in ok.select("file").collect()}


def list_objects(spark: SparkSession, path: str, extension: str | None = None) -> DataFrame:
    """Path, size and modification time of the files below a path; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if extension:
        reader = reader.option("pathGlobFilter", f"*.{extension.lstrip('.')}")
    return reader.load(path).select("path", "length", "modificationTime")


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as bytes."""
    return spark.read.format("binaryFile").load(path).select("path", "content")
