"""File sources.

Always with an explicit schema: no inference pass over the input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_json_lines(spark: SparkSession, path: str | list[str], schema: T.StructType,
                    quarantine: bool = False, path_glob: str | None = None,
                    recursive: bool = False, options: dict | None = None) -> DataFrame:
    """JSON-lines scan (A1).  With ``quarantine=True`` malformed lines are kept
    in ``_corrupt_record`` (PERMISSIVE) so they can be split off (B11);
    without it a malformed line fails the scan, so no line is lost silently."""
    r = spark.read.schema(
        T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())]) if quarantine else schema)
    r = r.option("mode", "PERMISSIVE" if quarantine else "FAILFAST")
    if quarantine:
        r = r.option("columnNameOfCorruptRecord", CORRUPT)
    if path_glob:
        r = r.option("pathGlobFilter", path_glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.json(path)


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, bad rows with the raw line).
    The bad side keeps all columns: Spark refuses plans over a raw JSON/CSV
    scan that reference only the corrupt-record column."""
    bad = F.col(CORRUPT).isNotNull()
    return df.filter(~bad).drop(CORRUPT), df.filter(bad)


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType,
                        recursive: bool = True, options: dict | None = None, quarantine: bool = False) -> DataFrame:
    """Whole-file (multi-line) JSON documents (A10): an array document yields
    one row per element.  A broken document fails the scan; with ``quarantine``
    it is one row with its text in ``_corrupt_record`` (``split_quarantine``)."""
    r = spark.read.schema(
        T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())]) if quarantine else schema)
    r = r.option("multiLine", "true").option("mode", "PERMISSIVE" if quarantine else "FAILFAST")
    if quarantine:
        r = r.option("columnNameOfCorruptRecord", CORRUPT)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.json(path)


def json_documents_to_lines(spark: SparkSession, src: str, dst: str, schema: T.StructType,
                            options: dict | None = None) -> None:
    """A10 conversion job: multi-line documents -> JSON lines."""
    w = read_json_documents(spark, src, schema, options=options).write.mode("overwrite")
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.json(dst)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True,
             sep: str = ",", drop_malformed: bool = False, quarantine: bool = False) -> DataFrame:
    """CSV / TSV with header (A6, A8).  A line that does not fit the schema
    fails the scan; ``quarantine`` keeps it in ``_corrupt_record`` instead, and
    ``drop_malformed`` drops it (A7).  Spark reads no more columns than a query
    takes: a value of another type is noticed where its column is taken, a
    wrong number of fields always."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if quarantine:
        kind = T.StructType(list(kind.fields) + [T.StructField(CORRUPT, T.StringType())])
    mode = "DROPMALFORMED" if drop_malformed else "PERMISSIVE" if quarantine else "FAILFAST"
    return (spark.read.schema(kind).option("header", header).option("sep", sep).option("mode", mode)
            .option("columnPruning", False).option("columnNameOfCorruptRecord", CORRUPT).csv(path))


def read_text_fields(spark: SparkSession, path: str, sep: str, fields: dict[str, int]) -> DataFrame:
    """Text lines split into fields (A9): ``fields`` maps output name to the
    0-based position; positions past the end give NULL."""
    parts = F.split(F.col("value"), sep if sep not in ".|*+?^$()[]{}\\" else "\\" + sep)
    return spark.read.text(path).select(*[F.get(parts, i).alias(n) for n, i in fields.items()])


def inventory(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True,
              modified_after: str | None = None, modified_before: str | None = None) -> DataFrame:
    """File inventory (A13/D11): ``(path, name, size, modified)`` without
    reading file contents (the binaryFile scan skips ``content`` when it is
    not selected)."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if modified_after:
        r = r.option("modifiedAfter", modified_after)
    if modified_before:
        r = r.option("modifiedBefore", modified_before)
    df = r.load(path).select("path", "length", "modificationTime")
    return df.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
                     F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def inventory_summary(inv: DataFrame, min_size: int | None = None, max_size: int | None = None) -> DataFrame:
    """Total size and count, optionally over files of more than ``min_size``
    or up to ``max_size`` bytes."""
    if min_size is not None:
        inv = inv.filter(F.col("size") > min_size)
    if max_size is not None:
        inv = inv.filter(F.col("size") <= max_size)
    return inv.agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))


def parse_archive_name(name_col: str = "name", prefix: str = "[a-z]+") -> dict[str, F.Column]:
    """``<prefix>_<from>_<to>_price_<date>.zip`` -> route and date."""
    pat = rf"^(?:{prefix})_([^_]+)_([^_]+)_price_([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})"
    c = F.col(name_col)
    return {"fromCity": F.regexp_extract(c, pat, 1), "toCity": F.regexp_extract(c, pat, 2),
            "fileDate": F.try_to_date(F.regexp_extract(c, pat, 3)),
            "flatKey": F.replace(c, F.lit("/"), F.lit("__"))}
