"""Incremental ingestion of landed day documents with Structured Streaming.

A file-source stream with ``trigger(availableNow=True)`` processes every file
not yet recorded in its checkpoint and stops: rerun it after new files land
and only those are read.  The checkpoint and sink live in the shared folder,
so a restarted driver or a lost executor resumes from the last committed
batch (exactly-once file sink).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pulsekit.operators.samples import flatten_day_documents
from pulsekit.sources import schemas as S


# A landed record: the source key plus the day document as delivered.
LANDED = T.StructType([T.StructField("user_id", T.LongType()),
                       T.StructField("document", T.ArrayType(S.DAY_DOCUMENT))])
CORRUPT = "_corrupt_record"


SINK_SCHEMA = T.StructType([T.StructField("user_id", T.LongType()),
                            T.StructField("file_name", T.StringType()),
                            T.StructField("time", T.StringType()),
                            T.StructField("value", T.IntegerType()),
                            T.StructField("HOUR", T.StringType()),
                            T.StructField("date", T.StringType())])


def landed_lines(user_col: str, document_col: str):
    """One JSON line per landed document: ``{"user_id": .., "document": [..]}``
    (the document text is embedded as is, not re-encoded)."""
    return F.concat(F.lit('{"user_id":'), F.col(user_col).cast("string"),
                    F.lit(',"document":'), F.col(document_col), F.lit("}"))


def day_document_stream(spark: SparkSession, landing_dir: str,
                        max_files: int | None = None) -> DataFrame:
    """Stream of landed records (JSON lines), one row per day document, with
    the landed file's name."""
    reader = spark.readStream.schema(LANDED)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.json(landing_dir)
    return raw.select("user_id", F.col("_metadata.file_name").alias("file_name"),
                      F.explode("document").alias("d")).select("user_id", "file_name", "d.*")


def ingest_day_documents(spark: SparkSession, landing_dir: str, sink_dir: str,
                         checkpoint_dir: str) -> StreamingQuery:
    """Flatten every new landed document into the Parquet sink (one folder per
    day); runs until the files present at start are done, then stops.  Read
    the sink with ``SINK_SCHEMA`` so ``date`` stays text."""
    flat = flatten_day_documents(day_document_stream(spark, landing_dir),
                                 keep=["user_id", "file_name"])
    query = (flat.writeStream.format("parquet").outputMode("append").partitionBy("date")
             .option("checkpointLocation", checkpoint_dir)
             .trigger(availableNow=True).start(sink_dir))
    query.awaitTermination()
    return query


def _replace_batch(batch: DataFrame, batch_id: int, sink_dir: str, quarantine_dir: str) -> None:
    """One micro-batch into the sink, under its own number: a batch that runs again replaces what it wrote."""
    from pulsekit.session import scratch_path
    spark, work = batch.sparkSession, scratch_path(batch.sparkSession, f"batch-{batch_id}")
    batch.write.parquet(work)  # parsed once for rows and rejects
    parsed = spark.read.schema(batch.schema).parquet(work)

    def put(df: DataFrame, path: str, *by: str) -> None:
        (df.withColumn("batch", F.lit(batch_id).cast("long")).hint("rebalance", *by).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch", *by).parquet(path))

    good = parsed.filter(F.col(CORRUPT).isNull())
    days = good.select("user_id", "file_name", F.explode("document").alias("d")).select("user_id", "file_name", "d.*")
    put(flatten_day_documents(days, keep=["user_id", "file_name"]), sink_dir, "date")
    put(parsed.filter(F.col(CORRUPT).isNotNull()).select("file_name", F.col(CORRUPT).alias("record")), quarantine_dir)


def ingest_bounded(spark: SparkSession, landing_dir: str, sink_dir: str, checkpoint_dir: str, quarantine_dir: str,
                   max_files: int, each=_replace_batch) -> StreamingQuery:
    """Everything landed and not yet ingested, in batches of at most ``max_files`` files.

    A batch is written under its number, into folders that it replaces, so a driver that dies between the
    write and the commit repeats the batch without a trace.  Records that do not parse go to the quarantine
    with their text.  ``current_days`` reads the sink.
    """
    schema = T.StructType([*LANDED.fields, T.StructField(CORRUPT, T.StringType())])
    raw = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT).json(landing_dir)
           .withColumn("file_name", F.col("_metadata.file_name")))
    query = (raw.writeStream.foreachBatch(lambda df, i: each(df, i, sink_dir, quarantine_dir))
             .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


BOUNDED_SCHEMA = T.StructType([*SINK_SCHEMA.fields, T.StructField("batch", T.LongType())])


def current_days(spark: SparkSession, sink_dir: str) -> DataFrame:
    """Samples of the sink as they stand: of a person's day, those of the batch that delivered it last."""
    table = spark.read.schema(BOUNDED_SCHEMA).parquet(sink_dir)
    last = table.groupBy("user_id", "date").agg(F.max("batch").alias("batch"))
    return table.join(last, ["user_id", "date", "batch"], "left_semi")
