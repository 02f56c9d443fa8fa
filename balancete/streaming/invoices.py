"""Incremental invoice-folder ingestion with Structured Streaming.

The batch job reads a whole folder; invoices usually *arrive* in a folder,
so the same flattening runs as a stream over the file source: each
micro-batch picks up the new XML files (one row of bytes per file),
parses them once, and writes three outputs through ``foreachBatch``:

  <out>/itens/batch_id=N       one row per item (37 columns, CSV dialect)
  <out>/notas/batch_id=N       one row per document
  <out>/quarantine/batch_id=N  documents that did not parse

Each micro-batch overwrites its own ``batch_id`` folder, so a batch that is
re-run after a failure replaces its earlier output instead of duplicating it.
Together with the source's committed-file log in the checkpoint folder, every
file is written exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.invoices import write_invoices
from ..sources.invoices import BINARY_FILE, file_rows


def invoice_file_stream(spark: SparkSession, in_dir: str, *, glob: str = "*.xml",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of the documents (see ``file_rows``), one row per new file."""
    r = (spark.readStream.format("binaryFile").schema(BINARY_FILE).option("recursiveFileLookup", "true")
         .option("pathGlobFilter", glob))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return file_rows(r.load(in_dir))


def _write_batch(out_dir: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        write_invoices(batch, out_dir, f"/batch_id={batch_id}")
    return write


def start_invoice_stream(spark: SparkSession, in_dir: str, out_dir: str, checkpoint_dir: str, *,
                         available_now: bool = False, processing_time: str = "1 minute",
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the folder -> CSV stream. ``available_now`` processes what is there and stops."""
    w = (invoice_file_stream(spark, in_dir, max_files_per_trigger=max_files_per_trigger)
         .writeStream.foreachBatch(_write_batch(out_dir))
         .option("checkpointLocation", checkpoint_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()
