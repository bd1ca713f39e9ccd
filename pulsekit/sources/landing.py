"""Landing: one file per document under its own name, opaque tables with a derived key, and an index of
landed keys that an anti join reads only in the buckets a delivery touches."""

from __future__ import annotations

import re
import uuid
from collections import Counter
from multiprocessing.pool import ThreadPool
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of the landed-key index; a bucket is a hash of the key's day.
KEY_BUCKETS = 64


def land_files(df: DataFrame, path: str, name_col: str, text_col: str) -> None:
    """One file ``path/<name>`` per row with the text as its content; a file of that name is replaced.

    One Spark job writes a staging folder per name below ``path`` (its name starts with ``_``, so readers skip
    it), then the files are renamed, as the usual output committer does for every file at the end of a job.
    Names have to be unique and hold no ``/``; a null text is an empty document.
    """
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}/_staged-{uuid.uuid4().hex[:12]}"
    (df.select(F.col(name_col).alias("_name"), F.coalesce(F.col(text_col), F.lit("")).alias("value"))
     .repartition("_name").write.partitionBy("_name").text(staged))
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(conf)

    # the tasks list the folders: three calls of the driver to rename a file are all that is left to it
    literal = re.sub(r"([\\{}\[\]*?^])", r"\\\1", staged)
    sources = [r[0] for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(literal).select("path").collect()]
    for folder, count in Counter(p.rpartition("/")[0] for p in sources).items():
        if count != 1:
            raise ValueError(f"{count} documents are named {_file_name(folder)}")

    def publish(source: str) -> None:
        name = _file_name(source.rpartition("/")[0])
        written, target = at(source), at(f"{path.rstrip('/')}/{name}")
        if fs.rename(written, target):
            return
        if fs.exists(target):
            fs.delete(target, False)
        if not fs.rename(written, target):
            raise OSError(f"{name} was not renamed")

    with ThreadPool(8) as pool:
        pool.map(publish, sources)
    fs.delete(at(staged), True)


def _file_name(folder: str) -> str:
    return unquote(folder.rpartition("/")[2].removeprefix("_name="))


def key_bucket(key_col: str | Column, buckets: int = KEY_BUCKETS) -> Column:
    """Bucket of a landing key ``yyyy-MM-dd_...``: a hash of its day, so a delivery of a few days touches few buckets.

    A null key is in the bucket of nulls like any other value."""
    key = F.col(key_col) if isinstance(key_col, str) else key_col
    return F.pmod(F.xxhash64(F.substring(key, 1, 10)), F.lit(buckets)).cast("int")


def land_keyed(docs: DataFrame, path: str, key_col: str = "file_key", buckets: int = KEY_BUCKETS) -> None:
    """Append documents to the landed table at ``path``, one folder per key bucket, a file per bucket and task."""
    (docs.withColumn("bucket", key_bucket(key_col, buckets)).hint("rebalance", "bucket")
     .write.mode("append").partitionBy("bucket").parquet(path))


def landed_keys(spark: SparkSession, path: str, delivery: DataFrame, key_col: str = "file_key",
                buckets: int = KEY_BUCKETS) -> DataFrame:
    """The landed keys of the buckets that ``delivery`` touches, read from these folders only.

    The touched buckets are at most ``buckets`` numbers, so they go into the plan as a partition filter."""
    touched = [r[0] for r in delivery.select(key_bucket(key_col, buckets).alias("b")).distinct().collect()]
    table = spark.read.schema(f"`{key_col}` string, bucket int").parquet(path)
    return table.filter(F.col("bucket").isin(touched)).select(key_col)


def land_new(delivery: DataFrame, path: str, key_col: str = "file_key", order: list[str] | None = None,
             buckets: int = KEY_BUCKETS) -> DataFrame:
    """Land those documents of a delivery whose key is not landed yet; returns the anti join it has written.

    Documents of one delivery that share a key are one: the least by ``order`` (default: all columns).  The
    result is read before the append, so delivering the same twice lands nothing the second time.  Documents
    without a key belong nowhere and are left out.
    """
    from pulsekit.session import scratch_path
    spark = delivery.sparkSession
    named = delivery.filter(F.col(key_col).isNotNull())
    rest = [c for c in named.columns if c != key_col]
    one = (named.groupBy(key_col).agg(F.min_by(F.struct(*rest), F.struct(*(order or rest))).alias("_row"))
           .select(key_col, "_row.*"))
    known = landed_keys(spark, path, named, key_col, buckets) if _exists(spark, path) else None
    new = one if known is None else one.join(known, key_col, "left_anti")
    work = scratch_path(spark, "delivery")
    new.write.parquet(work)  # what is new is settled before the table changes
    settled = spark.read.schema(new.schema).parquet(work)
    land_keyed(settled, path, key_col, buckets)
    return settled


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
