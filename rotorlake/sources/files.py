"""Text readers: delimited tables, per-turbine header CSVs, rule files, columns from paths."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rotorlake.functions.text import pairs_text
from rotorlake.operators.joins import lookup_join
from rotorlake.session import shared_folder

CORRUPT = "_corrupt"
_FILES = "spark.sql.files"
#: Splits that a task reads one after another, at most; tasks for each core.
SPLITS_A_TASK, TASKS_A_CORE = 1000, 4


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = ",",
    header: bool = False,
    timestamp_format: str | None = None,
    null_value: str = "\\N",
    reject_column: str | None = None,
) -> DataFrame:
    """Delimited text with a fixed schema; ``sep`` may be a comma, a tab or the ``\\x01`` of warehouse text.

    With ``reject_column`` bad rows are kept with their text in that column and null fields.
    """
    full = T.StructType(list(schema.fields))
    if reject_column:
        full = full.add(reject_column, T.StringType())
    reader = spark.read.schema(full).option("sep", sep).option("header", header).option("mode", "PERMISSIVE")
    reader = reader.option("nullValue", null_value).option("ignoreLeadingWhiteSpace", True)
    if reject_column:
        reader = reader.option("columnNameOfCorruptRecord", reject_column)
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
    return reader.csv(path)


def alias_paths(master: DataFrame, day: str | Column) -> DataFrame:
    """Master list (wtg_id, alias ``a.b.c``, site_id) to the day folder ``a/c/day/minute``; alias NULL is skipped."""
    parts = F.split("alias", "\\.")
    day = F.lit(day) if isinstance(day, str) else day
    return master.where("alias <> 'NULL'").select(
        "wtg_id",
        "site_id",
        F.concat_ws("/", F.get(parts, 0), F.get(parts, 2), day, F.lit("minute")).alias("folder"),
        F.concat(F.lit("minute_"), day, F.lit(".csv")).alias("file_name"),
    )


def _folder(file: str) -> Column:
    """The four folders above a file."""
    return F.array_join(F.slice(F.split(file, "/"), -5, 4), "/")


@contextmanager
def _settings(spark: SparkSession, values: dict[str, int]) -> Iterator[None]:
    """Session settings that hold inside a ``with`` block."""
    old = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _task_bytes(spark: SparkSession) -> int:
    """Bytes that the session gives to a task; the setting may have a unit, such as ``128MB``."""
    number, unit = re.match("([0-9]+) *([kmgtp]?)", spark.conf.get(f"{_FILES}.maxPartitionBytes").lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def _task_count(spark: SparkSession) -> int:
    """Tasks that list folders, and that read splits at least."""
    return TASKS_A_CORE * spark.sparkContext.defaultParallelism


def _read_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of files, patterns or folders with all below them; many folders are listed by few tasks, not one each."""
    with _settings(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": _task_count(spark)}):
        return spark.read.option("recursiveFileLookup", True).text(path)


def stored_lines(spark: SparkSession, path: str | list[str], split_bytes: int | None = None) -> DataFrame:
    """All lines of text files as (file, block, place, n_fields, value), read once and written to the shared folder.

    ``block`` is where a line's split starts in its file; ``place`` grows by one from line to line of a split. A file of
    any size is read in splits, of ``split_bytes`` if given. A task reads up to ``SPLITS_A_TASK`` splits one after
    another, as long as they are no more bytes than the session gives to a task, so neither small files nor small splits
    make a task and a stored file each.
    """
    task_bytes = _task_bytes(spark)
    stored = shared_folder(spark, "lines")
    text = _read_text(spark, path)
    lines = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.size(F.split(F.trim("value"), ",")).alias("n_fields"),
        "value",
    )
    packed = {f"{_FILES}.openCostInBytes": max(1, task_bytes // SPLITS_A_TASK)}
    if split_bytes:
        packed = {f"{_FILES}.maxPartitionBytes": split_bytes}
        with _settings(spark, packed):
            splits = text.rdd.getNumPartitions()
        a_task = max(1, min(SPLITS_A_TASK, task_bytes // split_bytes))
        packed[f"{_FILES}.maxPartitionNum"] = max(_task_count(spark), -(-splits // a_task))
    with _settings(spark, packed):
        lines.write.parquet(stored)
    return spark.read.schema(lines.schema).parquet(stored)


def _line() -> Column:
    return F.col("before") + F.col("place") - F.col("first")


def split_table(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """One row for each split of ``stored_lines``, written to the shared folder.

    ``first`` is the place of its first line and ``before`` how many lines of the file come before it; of its file
    ``head`` is the place of the header, ``wanted`` the header's number of fields and ``stop`` the number of the first
    line that has another one. All come from one row for each split and number of fields.
    """
    kinds = lines.groupBy("file", "block", "n_fields").agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("n"))
    file = Window.partitionBy("file")
    earlier = file.orderBy("block").rangeBetween(Window.unboundedPreceding, -1)
    ordered = file.orderBy("block", "place")
    kinds = kinds.select(
        "*",
        F.min("place").over(file.orderBy("block").rangeBetween(0, 0)).alias("first"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.first("place").over(ordered).alias("head"),
        F.first("n_fields").over(ordered).alias("wanted"),
    )
    kinds = kinds.withColumn("stop", F.min(F.when(F.col("n_fields") != F.col("wanted"), _line())).over(file))
    columns = ["first", "before", "head", "wanted", "stop"]
    return _stored(spark, kinds.groupBy("file", "block").agg(*[F.min(c).alias(c) for c in columns]), "splits")


def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _of_splits(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """Lines with the columns of their split. No split has more lines than a task reads, so its rows need no salt."""
    return lookup_join(lines, splits, ["file", "block"], salts=1)


def numbered_lines(spark: SparkSession, path: str | list[str], split_bytes: int | None = None) -> DataFrame:
    """All lines of text files as (file, block, line, n_fields, value), with ``line`` the number in the file, from 0.

    See ``stored_lines``. Lines are numbered within their split as they are read; the lines before a split come from a
    table with one row a split.
    """
    lines = stored_lines(spark, path, split_bytes)
    return _of_splits(lines, split_table(spark, lines)).select("file", "block", _line().alias("line"), "n_fields", "value")


def unowned_lines(spark: SparkSession, path: str | list[str], ids: DataFrame) -> DataFrame:
    """Lines (headers too) of files whose folder has no ids, which ``read_header_csv`` leaves out."""
    lines = _read_text(spark, path).select(F.col("_metadata.file_path").alias("file"), "value").withColumn("folder", _folder("file"))
    owned = lookup_join(lines, ids.select("folder", "wtg_id"), "folder", "left")
    return owned.where("wtg_id is null").select("file", "value")


def read_header_csv(
    spark: SparkSession, path: str | list[str], ids: DataFrame, stop_at_bad: bool = False, split_bytes: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Turbine day files, each with its own header, as (``key:value`` rows, rejected lines with their numbers).

    ``path`` names files, patterns or folders, which are read with all below them.
    ``ids`` gives wtg_id and site_id per folder; for other folders see ``unowned_lines``. A row whose field count
    differs from its file's header is rejected; with ``stop_at_bad`` the rest of that file is left out too. The text
    is read once, as ``stored_lines``; headers, first bad lines and ids come to the lines with their split.
    """
    lines = stored_lines(spark, path, split_bytes)
    splits = split_table(spark, lines)
    fits = F.col("n_fields") == F.col("wanted")
    rejects = _of_splits(lines, splits.select("file", "block", "first", "before", "wanted")).where(~fits)
    heads = splits.where("first = head").select(F.col("head").alias("place"))
    headers = lookup_join(lines.select("file", "place", F.col("value").alias("header")), heads, "place", salts=1).drop("place")
    # A line is before the first bad one if its place is, counted from the first place of its split.
    stop = [(F.col("stop") - F.col("before") + F.col("first")).alias("stop")] if stop_at_bad else []
    files = splits.select("file", "block", "head", "wanted", *stop).join(headers, "file").withColumn("folder", _folder("file"))
    own = _stored(spark, files.join(ids.select("folder", "wtg_id", "site_id"), "folder").drop("folder"), "headers")
    body = _of_splits(lines, own).where(fits & (F.col("place") != F.col("head")))
    if stop_at_bad:
        body = body.where("stop is null or place < stop")
    own_ids = F.concat(F.lit("site_id:"), F.col("site_id"), F.lit(",wtg_id:"), F.col("wtg_id"))
    row = F.concat_ws(",", pairs_text(F.split(F.trim("header"), ","), F.split(F.trim("value"), ",")), own_ids)
    return body.select("wtg_id", "site_id", row.alias("all_key_value")), rejects.select("file", _line().alias("line"), "value")


def read_tagged(spark: SparkSession, roots: dict[str, str], glob: str = "") -> DataFrame:
    """Lines of several folders in one scan, as (tag, file, value).

    ``roots`` names the tag of each folder; ``glob`` is added to each, such as ``/ds=*/*.csv`` for all partitions of a
    level. Rows are told apart by the file that they come from; of folders inside each other the deepest counts.
    """
    lines = spark.read.text([root.rstrip("/") + glob for root in roots.values()])
    file = F.col("_metadata.file_path")
    tag = F.lit(None).cast("string")
    for name, root in sorted(roots.items(), key=lambda r: len(r[1])):
        tag = F.when(F.contains(file, F.lit(_local(root).rstrip("/") + "/")), F.lit(name)).otherwise(tag)
    return lines.select(tag.alias("tag"), file.alias("file"), "value")


def _local(path: str) -> str:
    """A path without scheme and host, as it occurs in the path of every file below it."""
    return re.sub("^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "", path)


def with_path_columns(df: DataFrame, file_name: str = "file_name") -> DataFrame:
    """``log_type.site.day.hour`` file names to columns and the folder they belong to."""
    parts = F.split(file_name, "\\.")
    return df.withColumns(
        {
            "log_type": F.get(parts, 0),
            "site": F.get(parts, 1),
            "yyyymmdd": F.get(parts, 2),
            "hour": F.get(parts, 3),
            "folder": F.concat(
                F.get(parts, 0), F.lit("/site="), F.get(parts, 1), F.lit("/yyyymmdd="), F.get(parts, 2)
            ),
        }
    )


def read_logs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Log lines with the columns of their file name."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file_name"))
    return with_path_columns(lines)


def parse_rules(lines: DataFrame, col: str = "value") -> DataFrame:
    """Rule lines, ``FIELD:[lo,hi]`` or ``field, lo, hi``, to (field, low, high).

    Blank and ``#`` lines are skipped. The kind of bracket has no meaning: both ends are included.
    """
    number = "[+-]?[0-9]+(?:[.][0-9]*)?(?:[eE][+-]?[0-9]+)?"
    pattern = f"^([^:,]+?)\\s*[:,]\\s*[\\[(]?\\s*({number})\\s*,\\s*({number})\\s*[\\])]?$"
    text = F.trim(col)
    return lines.where((text != "") & ~text.startswith("#")).select(
        F.regexp_extract(text, pattern, 1).alias("field"),
        F.regexp_extract(text, pattern, 2).try_cast("double").alias("low"),
        F.regexp_extract(text, pattern, 3).try_cast("double").alias("high"),
    )


def rules_dict(rules: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """The rules of a table's columns for ``clean_ranges`` and ``range_terms``: at most one for each column.

    Of several rules of a field the one with the greatest bounds counts.
    """
    own = rules.where(F.col("field").isin(*columns)).groupBy("field").agg(F.max(F.struct("low", "high")).alias("r"))
    return {r["field"]: (r["r"]["low"], r["r"]["high"]) for r in own.collect()}
