"""File sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_posts(spark: SparkSession, path: str, schema: StructType, array: bool | None = None,
               max_records: int | None = None) -> DataFrame:
    """A JSON array file (``multiLine``) or JSON lines; blank and
    malformed lines are skipped; optional row cap (the reference's
    ``max_records`` argument)."""
    if array is None:
        first = spark.read.text(path).where(F.trim("value") != "").limit(1).collect()
        array = bool(first) and first[0][0].lstrip().startswith("[")
    r = spark.read.schema(schema).option("mode", "DROPMALFORMED")
    df = r.option("multiLine", True).json(path) if array else r.json(path)
    return df.limit(max_records) if max_records else df


def _file_formats(spark: SparkSession, path: str) -> DataFrame:
    """Per file: size, first non-blank character's format, first line."""
    lines = spark.read.text(path, recursiveFileLookup=True).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size_bytes"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"))
    first = F.ltrim("first_line")
    return lines.where(F.trim("value") != "").groupBy("file", "size_bytes").agg(
        F.min_by("value", "place").alias("first_line")).withColumn(
        "format", F.when(first.startswith("["), "array").when(first.startswith("{"), "jsonl").otherwise("unknown"))


def json_items(spark: SparkSession, path: str) -> DataFrame:
    """Every entry of the JSON files under ``path`` -- the elements of an
    array file, the non-blank lines of any other -- as ``(file, format, place,
    item variant)``.  A malformed line, a malformed array file (one row) and
    elements that are no objects have a null item; blank and empty files have
    no rows.

    An array can't be split, so each array file is parsed in one task; lines are
    split as Spark splits text files."""
    # names of the array files, which Spark's own file listing holds as well; the
    # filter on the name prunes the other files before they are read whole
    arrays = [r["file"] for r in _file_formats(spark, path).where(F.col("format") == "array").select("file").collect()]
    file = F.col("_metadata.file_path")
    parsed = spark.read.text(path, wholetext=True, recursiveFileLookup=True).where(file.isin(arrays)).select(
        file.alias("file"), F.try_parse_json("value").alias("parsed"))
    elements = spark.sql("""SELECT file, 'array' AS format, cast(pos AS bigint) AS place, value AS entry
                            FROM {parsed}, LATERAL variant_explode_outer(parsed)
                            WHERE pos IS NOT NULL OR parsed IS NULL""", parsed=parsed)
    lines = (spark.read.text(path, recursiveFileLookup=True).where(~file.isin(arrays) & (F.trim("value") != ""))
                  .select(file.alias("file"), F.lit("jsonl").alias("format"), F.monotonically_increasing_id().alias("place"),
                          F.try_parse_json("value").alias("entry")))
    found = elements.unionByName(lines)
    is_object = F.schema_of_variant("entry").startswith("OBJECT")
    return found.select("file", "format", "place", F.when(is_object, F.col("entry")).alias("item"))


def read_items(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """S1 over arrays and lines alike: the well-formed objects as rows of
    ``schema``; fields that are missing or of another type are null."""
    items = json_items(spark, path).where(F.col("item").isNotNull())
    return items.select(*[F.try_variant_get("item", f"$['{f.name}']", f.dataType.simpleString()).alias(f.name)
                          for f in schema.fields])


def read_table_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON list or single object as rows; a missing path is an
    empty table."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)


def scan(spark: SparkSession, path: str, columns: list[str] | None = None,
         limit: int | None = None, order: str | None = None) -> DataFrame:
    """Projected Parquet scan, optional (deterministic) row limit."""
    df = spark.read.parquet(path)
    if columns:
        df = df.select(*columns)
    if limit is not None:
        df = (df.orderBy(order) if order else df).limit(limit)
    return df


def existing_ids(df: DataFrame, key: str = "_id", group_col: str = "subreddit",
                 group_val: str | None = None) -> DataFrame:
    """Ids stored for one community (filter pushed to Parquet)."""
    if group_val is not None:
        df = df.where(F.col(group_col) == group_val)
    return df.select(key)


def profile_source(spark: SparkSession, path: str) -> DataFrame:
    """Per file that is not blank -- size in bytes, format (array / jsonl /
    unknown) by the first non-blank character, number of well-formed and of
    malformed items, and the first well-formed item's keys."""
    entries = json_items(spark, path).groupBy("file").agg(
        F.count("item").alias("item_count"), F.count_if(F.col("item").isNull()).alias("malformed"),
        F.min_by(F.json_object_keys(F.to_json("item")), F.when(F.col("item").isNotNull(), F.col("place"))).alias("first_item_keys"))
    return _file_formats(spark, path).join(entries, "file", "left").select(
        "file", "size_bytes", "format", F.coalesce("item_count", F.lit(0)).alias("item_count"),
        F.coalesce("malformed", F.lit(0)).alias("malformed"), "first_item_keys")
