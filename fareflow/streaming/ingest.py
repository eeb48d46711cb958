"""Incremental ingest.

The original loop walks a file list from a hand-set start index, converts
each archive, appends, and moves failures aside.  Here a file-source
stream does the bookkeeping: the checkpoint records which files were
committed (exactly-once into the sink), ``maxFilesPerTrigger`` is the chunk
size, and ``trigger(availableNow=True)`` processes what is there and stops,
so the job can run as a batch on a schedule and resumes after a crash.
Each micro-batch is split into good rows and quarantined lines; both are
written to a slice of their own, named by the checkpoint's stream id and the
batch id.  A replayed batch replaces its own slice; a stream with another
checkpoint adds to the target and never touches what is there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.sources.files import CORRUPT


def ingest_available(spark: SparkSession, src: str, dst: str, checkpoint: str,
                     schema: T.StructType, max_files: int = 100,
                     transform: Callable[[DataFrame], DataFrame] | None = None,
                     quarantine: str | None = None, fmt: str = "json",
                     partition_by: tuple[str, ...] = (),
                     timestamp_format: str = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") -> None:
    """Process every not-yet-committed file under ``src`` into ``dst``, in
    slices ``_run`` (stream id of the checkpoint) / ``_batch``.  Without a
    ``quarantine`` a malformed line fails its batch before anything is written."""
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    stream = (spark.readStream.format(fmt).schema(full)
              .option("maxFilesPerTrigger", max_files)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .option("timestampNTZFormat", timestamp_format)
              .load(src))

    def batch(df: DataFrame, batch_id: int) -> None:
        # the stream's id lives in its checkpoint and survives restarts
        run = df.sparkSession.read.text(f"{checkpoint}/metadata") \
            .select(F.get_json_object("value", "$.id")).first()[0]

        def write(rows: DataFrame, path: str, *by: str) -> None:
            (rows.withColumns({"_run": F.lit(run), "_batch": F.lit(batch_id)}).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("_run", "_batch", *by).parquet(path))

        bad = F.col(CORRUPT).isNotNull()
        df.persist()  # parsed once for both writes
        try:
            if not quarantine and (line := df.filter(bad).first()) is not None:
                # uncommitted, so the file is read again once there is a place for its lines
                raise ValueError(f"malformed line and no quarantine given: {line[CORRUPT][:200]!r}")
            good = df.filter(~bad).drop(CORRUPT)
            write(good if transform is None else transform(good), dst, *partition_by)
            if quarantine:
                write(df.filter(bad), quarantine)
        finally:
            df.unpersist()

    q = (stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
