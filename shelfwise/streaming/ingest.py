"""Snapshot CSV drops -> Parquet table, incrementally, exactly once and with unique keys.

This is load S1 (CSV with header -> inventory_snapshots) for a folder that
keeps receiving files.  The stream source tracks which files were read; every
micro-batch is one load of the keyed table (``sources.keyed``), named by its
number: rows with a NULL in the key, or with a key that the table has or that
repeats in the batch, go to the side table of rejects, the others are
committed by one rename.  A batch that is run again after a failure finds its
load there, so a restarted run neither loses nor duplicates rows.  The
insights build stays a batch job on the ingested table: LEAD needs a whole
ordered partition, which streaming aggregation does not offer.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import checkpoint_dir, list_names, touch
from ..sources import keyed
from ..sources.csv_io import as_text, reader_options, typed
from ..sources.schemas import SNAPSHOT_SCHEMA


def stream_folder(spark: SparkSession, name: str, source_dir: str, table_path: str) -> str:
    """Checkpoint of one stream: its name, its source and its table decide, so that ingesting a source into
    a second table, or a second source, starts from the first file."""
    key = hashlib.sha256(f"{source_dir.rstrip('/')}\n{table_path.rstrip('/')}".encode()).hexdigest()[:16]
    return f"{checkpoint_dir(spark).rstrip('/')}/shelfwise/streams/{name}-{key}"


def start_snapshot_ingest(spark: SparkSession, source_dir: str, table_path: str, *,
                          name: str = "snapshot_ingest", available_now: bool = True,
                          max_files_per_trigger: int | None = None, multiline: bool = False,
                          strict: bool = False) -> StreamingQuery:
    """Start the ingest; ``available_now`` processes what is there and stops.

    A table takes one source: its loads are numbered by the stream's batches,
    and another stream's first ones would pass for repeats, so that is an
    error.  ``strict``: a batch with a row that breaks a rule fails the stream
    and is not committed, instead of going on without the row.

    The stream checkpoint goes under the cluster's shared folder, and stays
    there for the next run.  Output is partitioned by load and snapshot date,
    so the build can prune by day; read it with ``keyed.read_table``.
    """
    folder = stream_folder(spark, name, source_dir, table_path)
    own = f"_stream-{folder.rpartition('-')[2]}"
    others = [n for n in list_names(spark, table_path) if n == "_spark_metadata" or n.startswith("_stream-")]
    if others not in ([], [own]):
        raise ValueError(f"{table_path} already takes another stream; ingest {source_dir} into its own table")
    touch(spark, f"{table_path.rstrip('/')}/{own}")
    reader = spark.readStream.schema(as_text(SNAPSHOT_SCHEMA)).options(**reader_options(multiline))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(source_dir).withColumn(keyed.SOURCE, F.col("_metadata.file_path"))
    rows = keyed.with_partition(typed(raw, SNAPSHOT_SCHEMA, keep=[keyed.SOURCE]), keyed.SNAPSHOTS)

    def commit(batch: DataFrame, number: int) -> None:
        keyed.load(batch, table_path, keyed.SNAPSHOTS, f"{number:012d}", source=F.col(keyed.SOURCE), strict=strict)

    writer = (rows.writeStream.foreachBatch(commit)
              .option("checkpointLocation", folder)
              .queryName(name))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
