"""File sources (S1-S5) and sinks (K1-K4).

Sinks write into a folder under the cluster's shared
``spark.checkpoint.dir`` (or a caller-given path), never a machine-local
temp folder.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.session import ensure_checkpoint_dir, ensure_python_package, write_table


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run's artefacts on the shared file system."""
    return f"{ensure_checkpoint_dir(spark)}/artifacts/{name}-{uuid.uuid4().hex[:12]}"


# ------------------------------------------------- metadata on the shared store
def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of the store that Spark would use for ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def first_existing(spark: SparkSession, candidates: Sequence[str]) -> str | None:
    """The first of the ordered paths that exists."""
    for path in candidates:
        fs, p = hadoop_path(spark, path)
        if fs.exists(p):
            return path
    return None


def write_file_text(spark: SparkSession, path: str, text: str) -> str:
    """A small text as one file (contracts, markers)."""
    fs, p = hadoop_path(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    return path


def file_text(spark: SparkSession, path: str) -> str:
    fs, p = hadoop_path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


# --------------------------------------------------------------------- S1
def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Header CSV; explicit schema when known (no inference pass); empty
    fields read as NULL."""
    r = spark.read.option("header", True).option("nullValue", "")
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


# --------------------------------------------------------------------- S2
MAP_SCHEMA = T.MapType(T.StringType(), T.ArrayType(T.StringType()))


def read_category_map(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """JSON ``{column: [rare values]}`` objects -> long ``(column, value)``.

    ``whole_file=True`` reads one (possibly pretty-printed) object per file;
    otherwise every line is an object (as written by ``write_category_map``).
    """
    raw = spark.read.text(path, wholetext=whole_file)
    m = raw.filter(F.trim("value") != "").select(F.from_json("value", MAP_SCHEMA).alias("m"))
    return (m.select(F.explode("m").alias("column", "values"))
             .select("column", F.explode("values").alias("value")))


# --------------------------------------------------------------------- S3
def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Glob on the Hadoop file system (metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = p.getFileSystem(conf)
    statuses = fs.globStatus(p) or []
    return sorted(str(s.getPath().toString()) for s in statuses)


def prediction_files(spark: SparkSession, pattern: str, stem_regex: str,
                     required: Sequence[str] = ("y_true", "y_pred")) -> tuple[DataFrame, DataFrame]:
    """S3: ``(rows, files)`` of all prediction CSVs matched by ``pattern``,
    whatever other columns each has and in whatever order.

    ``rows``: the ``required`` columns as doubles and ``model``, group 1 of
    ``stem_regex`` applied to the file path.  ``files``: (path, model, header,
    reason), one row per file; a reason tells why it gives no rows.

    One job finds every file's first line, one reads all files; columns are
    picked by their place in the file's own header.  The number of jobs does
    not depend on the number of files.
    """
    paths = list_files(spark, pattern)
    schema = ", ".join(f"{c} double" for c in required) + ", model string"
    if not paths:
        return (spark.createDataFrame([], schema),
                spark.createDataFrame([], "path string, model string, header string, reason string"))
    model = F.regexp_extract("path", stem_regex, 1).alias("model")
    lines = (spark.read.option("ignoreCorruptFiles", True).text(paths)
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("row"), "value").where(F.trim("value") != ""))
    heads = write_table(lines.groupBy("path").agg(F.min(F.struct("block", "row", "value"))["value"].alias("header")),
                        "headers")
    width = heads.agg(F.max(F.size(F.split("header", ",")))).first()[0] or 1
    cells = ", ".join(f"c{i} string" for i in range(width))

    def fields(line: str):
        parsed = F.from_csv(F.col(line), cells, {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"})
        return F.transform(F.array(parsed), lambda p: F.array(*[p[f"c{i}"] for i in range(width)]))[0]

    at = [F.array_position(fields("header"), c).cast("int").alias(f"at_{i}") for i, c in enumerate(required)]
    known = heads.select("path", "header", *at)
    lacks = F.concat_ws(", ", *[F.when(F.col(f"at_{i}") == 0, c) for i, c in enumerate(required)])
    files = known.select("path", model, "header", F.when(lacks != "", F.concat(F.lit("no column "), lacks)).alias("reason"))
    # files without a line are only known from the listing
    listed = spark.createDataFrame([(p,) for p in paths], "path string").select("path", model)
    silent = listed.join(files.select("model").distinct(), "model", "left_anti").select(
        "path", "model", F.lit(None).cast("string").alias("header"), F.lit("empty or unreadable").alias("reason"))
    full = known.where(lacks == "").withColumnRenamed("path", "_path")
    rows = lines.join(full, (F.col("path") == F.col("_path")) & (F.col("value") != F.col("header"))).withColumn("_f", fields("value"))
    return rows.select(*[F.try_element_at("_f", F.col(f"at_{i}")).try_cast("double").alias(c) for i, c in enumerate(required)],
                       model), files.unionByName(silent)


def read_prediction_files(spark: SparkSession, pattern: str, stem_regex: str,
                          required: Sequence[str] = ("y_true", "y_pred")) -> DataFrame:
    """The rows of ``prediction_files``; files that give none are skipped."""
    return prediction_files(spark, pattern, stem_regex, required)[0]


# --------------------------------------------------------------------- S5
WHOLE = 1 << 30     # bytes of a file that may be one value
CHUNK = 8 << 20     # bytes read at once of a larger one


def _digests(batches):
    for b in batches:
        found = []
        for path in b.column("path").to_pylist():
            uri = "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path
            fs, name = pyarrow.fs.FileSystem.from_uri(uri)
            digest = hashlib.sha256()
            with fs.open_input_stream(name) as f:
                while chunk := f.read(CHUNK):
                    digest.update(chunk)
            found.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.string())], names=[*b.schema.names, "sha256"])


def manifest(spark: SparkSession, pattern: str, whole: int = WHOLE) -> DataFrame:
    """Path, modification time, size and sha256 for every matched file.

    Files of up to ``whole`` bytes are read as one value; larger ones (a value
    cannot exceed 2 GB) are streamed by ``CHUNK`` bytes in the task."""
    ensure_python_package(spark)
    files = spark.read.format("binaryFile").load(pattern)     # the bound on length is pushed into the scan
    small = files.where(F.col("length") <= whole).select(
        "path", "modificationTime", "length", F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > whole).select("path", "modificationTime", "length").mapInArrow(
        _digests, "path string, modificationTime timestamp, length long, sha256 string")
    # the reader gives no row for an empty file; the listing knows it
    fs, p = hadoop_path(spark, pattern)
    empty = [(s.getPath().toString(), s.getModificationTime()) for s in fs.globStatus(p) or [] if s.isFile() and s.getLen() == 0]
    none = spark.createDataFrame(empty, "path string, at long").select(
        "path", F.timestamp_millis("at").alias("modificationTime"), F.lit(0).cast("long").alias("length"),
        F.lit(hashlib.sha256().hexdigest()).alias("sha256"))
    return small.unionByName(large).unionByName(none)


# ------------------------------------------------------------------ K1-K4
def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    w = df.write.mode("overwrite").option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
    return path


def write_backup_once(df: DataFrame, backup_path: str) -> str:
    """K2: the first backup wins; later writes are ignored."""
    df.write.mode("ignore").parquet(backup_path)
    return backup_path


def write_json_summary(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def write_category_map(rare_long: DataFrame, path: str, values_per_line: int = 1000) -> str:
    """K3 for the rare map: JSON lines ``{column: [values]}``.

    A column's rare list can grow with the data (e.g. unique time strings),
    so it is split over ``ceil(n / values_per_line)`` hash buckets: every
    line holds about ``values_per_line`` values and no task gathers a whole
    column.  ``read_category_map`` merges the lines back per column.
    """
    counts = rare_long.groupBy("column").agg(F.count(F.lit(1)).alias("_n"))
    # one row per column name: bounded by the schema width
    buckets = F.broadcast(counts.select("column", F.greatest(F.lit(1), F.ceil(F.col("_n") / values_per_line))
                                        .cast("int").alias("_b")))
    tagged = rare_long.join(buckets, "column").withColumn(
        "_bucket", F.pmod(F.xxhash64("value"), F.col("_b")))
    per_line = tagged.groupBy("column", "_bucket").agg(F.sort_array(F.collect_list("value")).alias("values"))
    per_line.select(F.to_json(F.create_map(F.col("column"), F.col("values"))).alias("value")) \
        .write.mode("overwrite").text(path)
    return path
