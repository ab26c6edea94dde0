"""File sources and sinks (A1, A2, A6, A7, A9, A10) and batch embedding."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfscore.session import materialize
from perfscore.sources import folders

# Admitted image types and the upload size limit.
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "webp")
MAX_IMAGE_BYTES = 10 * 1024 * 1024
EMBED_BATCH = 32

# Quoted multi-line fields, surrounding blanks kept, and NULL written as \N so an
# empty string and a missing value stay distinct after a round trip.
CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"',
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
               "nullValue": "\\N"}
CSV_WRITE_OPTIONS = {**CSV_OPTIONS, "emptyValue": '""'}
# A file whose fields hold line breaks cannot be split: one task reads it whole, so files end after so many rows.
CSV_ROWS_PER_FILE = 20_000
# Level of gzip: the fastest leaves about a tenth more bytes of mixed texts than the usual one, in a third of the time.
GZIP_LEVEL = {"zlib.compress.level": "BEST_SPEED"}


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Typed CSV read: explicit schema, multi-line quoted fields, ``NA`` kept as text
    (only the ``\\N`` marker reads as NULL)."""
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                snapshot: str | None = None, partition_by: list[str] | None = None,
                compression: str | None = None) -> str:
    """Write a table (no index column).  With ``snapshot`` the rows go to
    ``path/snapshot=<ts>`` so earlier runs stay readable side by side.

    ``compression`` names a codec of the format (``gzip``); Spark's readers know it by the
    files' names, so compressed and plain snapshots can lie side by side.
    """
    target = os.path.join(path, f"snapshot={snapshot}") if snapshot else path
    w = df.write.mode(mode)
    if compression:
        w = w.options(**GZIP_LEVEL).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.options(**CSV_WRITE_OPTIONS).option("maxRecordsPerFile", CSV_ROWS_PER_FILE).csv(target)
    elif fmt == "json":
        w.json(target)
    else:
        w.format(fmt).save(target)
    return target


def read_latest_snapshot(spark: SparkSession, path: str, fmt: str = "parquet",
                         schema: T.StructType | str | None = None) -> DataFrame:
    """Rows of the newest committed snapshot under ``path``.

    The folder is listed, so older snapshots are not read, and one that is still being
    written (no commit marker) is not chosen.
    """
    done = folders.values(spark, path, "snapshot")
    if not done:
        raise FileNotFoundError(f"no committed snapshot under {path}")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(os.path.join(path, f"snapshot={done[-1]}"))


def write_instances(df: DataFrame, path: str, key: str = "video_id", embedding: str = "embedding",
                    tab_cols: list[str] | None = None) -> str:
    """Scoring instances as JSON lines: ``{key, instance: {embedding: [...], tabular: [[...]]}}``."""
    tab = F.array(F.array(*[F.col(c).cast("double") for c in (tab_cols or [])]))
    inst = F.struct(F.col(embedding).alias("embedding"), tab.alias("tabular"))
    df.select(F.col(key), inst.alias("instance")).write.mode("overwrite").json(path)
    return path


INSTANCE_SCHEMA = T.StructType([
    T.StructField("video_id", T.StringType()),
    T.StructField("instance", T.StructType([
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("tabular", T.ArrayType(T.ArrayType(T.DoubleType()))),
    ])),
])


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows of all JSON-lines files of a folder, and the lines that are not JSON of the schema."""
    marked = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = spark.read.text(path).where(F.trim("value") != "").select(
        "value", F.from_json("value", marked, {"columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
    broken = F.col("r").isNull() | F.col("r._corrupt").isNotNull()
    good = parsed.where(~broken).select(*[F.col("r")[f.name].alias(f.name) for f in schema.fields])
    return good, parsed.where(broken).select(F.col("value").alias("line"))


def read_instances(spark: SparkSession, path: str, schema: T.StructType = INSTANCE_SCHEMA) -> DataFrame:
    """All JSON-lines files of a folder, explicit schema; the key travels in each line (``json_lines``
    also gives the broken lines)."""
    return json_lines(spark, path, schema)[0]


PREDICTION_SCHEMA = T.StructType([
    T.StructField("video_id", T.StringType()),
    T.StructField("prediction", T.ArrayType(T.DoubleType())),
])


def write_predictions(df: DataFrame, path: str, key: str = "video_id", value: str = "prediction") -> str:
    """Batch predictions as JSON lines ``{key, prediction: [v]}`` (the key travels along)."""
    df.select(F.col(key), F.array(F.col(value).cast("double")).alias("prediction")) \
        .write.mode("overwrite").json(path)
    return path


def read_predictions(spark: SparkSession, path: str, key: str = "video_id") -> DataFrame:
    """Every output file of a prediction folder, re-keyed by id (never by position)."""
    df = json_lines(spark, path, PREDICTION_SCHEMA)[0]
    return df.select(F.col("video_id").alias(key), F.get(F.col("prediction"), 0).alias("prediction"))


def scan_images(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Image folder → ``video_id`` (file stem), ``path``, ``length``, ``extension``.

    ``content`` is not selected, so the bytes are not read by this scan.
    """
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", "true").load(folder))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return df.select(
        F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1).alias("video_id"),
        F.col("path"), F.col("length"),
        F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).alias("extension"))


def admit_images(images: DataFrame, max_bytes: int = MAX_IMAGE_BYTES,
                 extensions=IMAGE_EXTENSIONS) -> DataFrame:
    """Keep jpeg/png/webp files of at most ``max_bytes`` (metadata only)."""
    return images.where(F.col("extension").isin(*extensions) & (F.col("length") <= max_bytes))


def load_admitted_images(spark: SparkSession, folder: str, glob: str = "*",
                         max_bytes: int = MAX_IMAGE_BYTES, extensions=IMAGE_EXTENSIONS) -> DataFrame:
    """Admitted images with their bytes: ``video_id, path, length, content``.

    The size predicate is evaluated on file metadata and the extension on the
    path, so files that are not admitted are filtered before their content
    is read.
    """
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", "true").load(folder))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    ext = F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1))
    return (df.where((F.col("length") <= max_bytes) & ext.isin(*extensions))
            .select(F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1).alias("video_id"),
                    "path", "length", "content"))


EMBED_SCHEMA = "video_id string, embedding array<float>, error string"


ARROW_RECORDS_PER_BATCH = 64   # images of at most 10 MB per Arrow batch: well below its 2 GB


def embed_images(images: DataFrame, make_embedder: Callable[[], Callable],
                 batch_size: int = EMBED_BATCH,
                 records_per_arrow_batch: int = ARROW_RECORDS_PER_BATCH) -> DataFrame:
    """Batch embedding with ``mapInPandas``: the model is built once per task,
    images go through it in batches; an unreadable image gets a NULL vector and
    an error text instead of failing the task.

    Image bytes are large, so the vectors are written here and now, under a lower
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` that is put back afterwards.
    """
    def run(batches: Iterator) -> Iterator:
        import pandas as pd
        embed = make_embedder()
        for pdf in batches:
            ids, vecs, errs = [], [], []
            rows = list(zip(pdf["video_id"], pdf["content"]))
            for i in range(0, len(rows), batch_size):
                chunk = rows[i:i + batch_size]
                try:
                    res = embed([c for _, c in chunk])
                    errors = [None if v is not None else "unreadable" for v in res]
                except Exception as exc:  # a bad batch: retry row by row
                    res, errors = [], []
                    for _, c in chunk:
                        try:
                            v = embed([c])[0]
                            res.append(v)
                            errors.append(None if v is not None else "unreadable")
                        except Exception as row_exc:  # noqa: BLE001
                            res.append(None)
                            errors.append(str(row_exc) or type(exc).__name__)
                ids.extend(i_ for i_, _ in chunk)
                vecs.extend(res)
                errs.extend(errors)
            yield pd.DataFrame({"video_id": ids, "embedding": vecs, "error": errs})

    conf, setting = images.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(setting)
    conf.set(setting, str(records_per_arrow_batch))
    try:
        return materialize(images.select("video_id", "content").mapInPandas(run, EMBED_SCHEMA), "embedded")
    finally:
        conf.set(setting, before)


def missing_embeddings(images: DataFrame, existing: DataFrame) -> DataFrame:
    """Only images without a stored embedding (recompute nothing twice)."""
    return images.join(existing.select("video_id"), "video_id", "left_anti")


CONTENT_KEY = "content_key"


def with_content_key(images: DataFrame, model: str) -> DataFrame:
    """Add the key that a vector is stored under: the image's bytes and the model's version.

    A changed image gets another key; copies share one.
    """
    return images.withColumn(CONTENT_KEY, F.sha2(F.concat(F.col("content"), F.encode(F.lit(f"/{model}"), "UTF-8")), 256))


def embed_store(images: DataFrame, store: str, make_embedder: Callable[[], Callable], model: str,
                batch_size: int = EMBED_BATCH) -> DataFrame:
    """Vectors of all images (``video_id, embedding, error``) from a store by content.

    Only contents that the store lacks are embedded, each once however many images share it; they are
    appended to the store, unreadable ones too (so they are not tried again by the same model).
    """
    spark = images.sparkSession
    keyed = with_content_key(images, model)
    first = keyed.groupBy(CONTENT_KEY).agg(F.min("video_id").alias("video_id"))
    known = spark.read.parquet(store) if folders.exists(spark, store) else None
    if known is not None:
        first = first.join(known.select(CONTENT_KEY), CONTENT_KEY, "left_anti")
    first = materialize(first, "new_contents")
    todo = keyed.join(first, [CONTENT_KEY, "video_id"], "left_semi").dropDuplicates([CONTENT_KEY])
    new = embed_images(todo.select(F.col(CONTENT_KEY).alias("video_id"), "content"), make_embedder, batch_size)
    new.withColumnRenamed("video_id", CONTENT_KEY).write.mode("append").parquet(store)
    return keyed.select("video_id", CONTENT_KEY).join(spark.read.parquet(store), CONTENT_KEY).drop(CONTENT_KEY)
