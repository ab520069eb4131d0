"""Incremental pickup of landed pages with Structured Streaming.

The batch jobs pull "everything created or updated since the last successful
run" (A2/A3). When pages are landed as files, a file-source stream gives the
same incremental contract without a watermark query: the stream's commit log
records which files were processed, each micro-batch sees only new files,
and a failed batch is retried from its checkpoint. A retry needs a sink that
takes one: :func:`ticket_run_batches` publishes each batch as a run of a
:class:`~dimwright.sources.publish.Store`, where what a failed try has written
is not seen, and a batch that was published but not yet marked as done by the
stream is left as it is. Each micro-batch is handed to an ordinary batch function (``foreachBatch``), so the load itself stays
the DataFrame job of :mod:`dimwright.plans.jobs`; no streaming state is kept.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from dimwright.operators import control
from dimwright.plans import jobs
from dimwright.sources.publish import Store

BatchFn = Callable[[DataFrame, int], None]


def landed_pages(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of landed JSON pages, one document per line, as ``value``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(landing_dir)


def run_landed(pages: DataFrame, process: BatchFn, checkpoint_location: str,
               available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Run ``process(batch, batch_id)`` for every micro-batch of newly landed pages.

    ``checkpoint_location`` must be shared storage on a cluster: it is what
    makes a restarted run skip files already loaded.
    """
    writer = pages.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_location)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def ticket_batches(load_warehouse: Callable[[], Mapping[str, DataFrame]],
                   reference_pages: Callable[[], Mapping[str, DataFrame]],
                   publish: Callable[[Mapping[str, DataFrame], int], None],
                   as_of: Callable[[], str]) -> BatchFn:
    """A ``foreachBatch`` function running the ticket load (E1) on each batch of
    landed issue pages: read the current warehouse, load, publish the new state
    (for instance :func:`dimwright.plans.jobs.write_snapshot` plus a pointer
    switch)."""

    def process(batch: DataFrame, batch_id: int) -> None:
        pages = dict(reference_pages())
        pages["issues"] = batch
        publish(jobs.ticket_load(load_warehouse(), pages, as_of(), batch_id), batch_id)

    return process


def ticket_run_batches(store: Store, reference_pages: Callable[[], Mapping[str, DataFrame]],
                       lookups: Callable[[], Mapping[str, DataFrame]], as_of: Callable[[], str], first_run: int = 1,
                       log_folder: str | None = None) -> BatchFn:
    """A ``foreachBatch`` function that runs and publishes E1 for each batch of
    landed issue pages, as run ``first_run`` + batch id. A batch may hold a part
    of a search only, so pages are not held against their totals."""

    def process(batch: DataFrame, batch_id: int) -> None:
        run_id = first_run + batch_id
        log = control.RunLog(store.spark, log_folder, "servicedesk", run_id) if log_folder else None
        jobs.ticket_run(store, {**reference_pages(), "issues": batch}, lookups(), as_of(), run_id, log, listing=None)

    return process
