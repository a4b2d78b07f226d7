"""The query log as a stream of arriving audit files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfmark.operators.querylog import query_log

# folders of keys per day
BUCKETS = 16
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _with_day(log: DataFrame) -> DataFrame:
    """Adds the day, and a key by which a replayed event is known."""
    whole = F.sha2(F.to_json(F.struct(*log.columns)), 256)
    return log.withColumn("event_ts", F.to_timestamp("start_time")).withColumns(
        {"day": F.to_date("event_ts"), "event_key": F.coalesce("event_id", whole)}
    )


class KeyIndex:
    """Keys of the events a sink has, in the hidden folder ``_keys`` of the sink: by day, by a hash
    of the key, and by the batch that wrote them. So a batch reads the folders of its own keys only.
    """

    def __init__(self, spark: SparkSession, sink: str):
        self.spark, self.path = spark, f"{sink.rstrip('/')}/_keys"

    @staticmethod
    def bucket(key: str = "event_key"):
        return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")

    def folders(self, touched: list[tuple[str, int]]) -> list[str]:
        """Those of the (day, bucket) folders that are there; one listing per day."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        wanted: dict[str, set[str]] = {}
        for day, bucket in touched:
            wanted.setdefault(f"day={day}", set()).add(f"bucket={bucket}")
        found = []
        for day, buckets in wanted.items():
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(root, day)
            if fs.exists(folder):
                names = {s.getPath().getName() for s in fs.listStatus(folder)}
                found += [f"{self.path}/{day}/{b}" for b in sorted(buckets & names)]
        return found

    def held(self, touched: list[tuple[str, int]], batch: str) -> DataFrame:
        """(event_key) of the touched folders, without what ``batch`` itself has written."""
        folders = self.folders(touched)
        schema = "event_key string, day string, bucket int, batch string"
        if not folders:
            return self.spark.createDataFrame([], "event_key string")
        read = self.spark.read.schema(schema).option("basePath", self.path).parquet(*folders)
        return read.where(F.col("batch") != batch).select("event_key")

    def add(self, rows: DataFrame, batch: str) -> None:
        keys = rows.select(
            "event_key", "day", self.bucket().alias("bucket"), F.lit(batch).alias("batch")
        )
        _replace(keys, ["day", "bucket", "batch"], self.path)


def _replace(df: DataFrame, by: list[str], path: str) -> None:
    """Writes the folders that ``df`` has rows for, in place of any that an earlier run left."""
    writer = df.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


def append_new(batch: DataFrame, sink: str, number: str) -> None:
    """Append the events of a batch that the sink does not have from other batches.

    Rows and keys are written below the batch's own ``number``. So a batch that runs again after a
    failure, wherever it broke off, replaces just what it had written, and finds neither its own keys
    nor leaves a row twice.
    """
    index = KeyIndex(batch.sparkSession, sink)
    batch = batch.dropDuplicates(["day", "event_key"])
    touched = batch.select(
        F.coalesce(F.col("day").cast("string"), F.lit(_NO_DAY)).alias("day"), index.bucket().alias("bucket")
    )
    pairs = [(r["day"], r["bucket"]) for r in touched.distinct().collect()]
    new = batch.join(index.held(pairs, number), "event_key", "left_anti").select(*batch.columns).persist()
    _replace(new.withColumn("batch", F.lit(number)), ["day", "batch"], sink)
    index.add(new, number)
    new.unpersist()


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Name of the stream that a checkpoint belongs to, the same after a restart."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"])["id"]


def stream_query_log(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    sink: str,
    checkpoint: str,
    files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Append the started queries of new files to parquet folders by day, each event once.

    Runs over all files that are there and stops; call it again for later files. Nothing is
    discarded for being late: files may come in any order, and what a replayed file repeats is
    found by its key, however long ago it was written (see ``KeyIndex``). Events without an id are
    told apart by their whole record. ``batch`` names the stream and the batch that wrote a row, so a
    batch replayed after a failure is known; a new checkpoint is another stream.
    """
    arriving = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)
    )
    log = _with_day(query_log(arriving))
    empty = spark.createDataFrame([], log.schema).withColumn("batch", F.lit(""))
    empty.write.mode("append").partitionBy("day", "batch").parquet(sink)

    def append(batch: DataFrame, number: int) -> None:
        append_new(batch, sink, f"{_stream_id(spark, checkpoint)}-{number}")

    return (
        log.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
