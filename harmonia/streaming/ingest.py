"""Incremental ingest of a raw-export folder by Structured Streaming.

``readStream`` over the folder with ``trigger(availableNow=True)`` processes every file not yet
seen and stops; the streaming checkpoint (in the shared folder) replaces the file ledger, so a
re-run ingests only new files and an executor loss replays the unfinished batch.

``ingest_stream`` feeds the tables of ``plans.stages``: the stream's header goes through the same inference, renaming,
identifier removal and padding as a batch export, and every micro-batch becomes a part of the commit log named by the query's id and
the batch's number.  A replayed batch finds its entry and writes nothing; a batch that died before its commit left a folder that
nothing reads; streams with checkpoints of their own have ids of their own, so none overwrites another's rows.

``ingest_folder`` writes one folder for each (query, batch) without a log.
"""

from __future__ import annotations

import json
import logging

from pyspark.sql import DataFrame, SparkSession

from ..operators.deid import drop_phi, redact_strings
from ..plans import stages as S

log = logging.getLogger(__name__)


def preprocess_batch(df: DataFrame, table_name: str) -> DataFrame:
    return redact_strings(drop_phi(df, table_name))


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that owns a checkpoint: the same over all its runs."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


def _source(spark: SparkSession, folder: str, schema, fmt: str, max_files_per_trigger: int) -> DataFrame:
    return (spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .option("header", True).load(folder))


def _run(src: DataFrame, write_batch, checkpoint: str):
    q = (src.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def ingest_folder(spark: SparkSession, folder: str, schema, table_name: str, out_path: str,
                  checkpoint: str, fmt: str = "parquet", max_files_per_trigger: int = 100):
    """Run an availableNow stream folder -> staged parquet; returns the finished query."""
    def write_batch(batch: DataFrame, batch_id: int):
        # one folder per query and batch, overwritten on replay: a retried batch never duplicates rows, and a query with another
        # checkpoint never replaces them
        owner = query_id(batch.sparkSession, checkpoint)
        preprocess_batch(batch, table_name).write.mode("overwrite").parquet(f"{out_path}/query_id={owner}/batch_id={batch_id}")

    return _run(_source(spark, folder, schema, fmt, max_files_per_trigger), write_batch, checkpoint)


def ingest_stream(spark: SparkSession, folder: str, schema, root: str, known_schemas: dict[str, list[str]], checkpoint: str,
                  fmt: str = "parquet", max_files_per_trigger: int = 100, threshold: float = 0.9, method: str = "ratcliff",
                  phi: dict | None = None):
    """Stage the new files of ``folder`` below ``root`` as parts of the table that their header (``schema``) belongs to; returns
    the finished query.  Raises if no table reaches ``threshold`` (Q7), before any file is read.

    Every batch is written once and checked for row parity (Q1).  The parts go on through ``clean_stage`` as those of ``preprocess``
    do.  Files seen by one checkpoint are staged again by another; the final tables are distinct all the same."""
    columns = schema.fieldNames()
    table, score = S.infer_headers(spark, [("stream", columns)], known_schemas, threshold, method).get("stream", ("unknown", 0.0))
    if table == "unknown":
        raise ValueError(f"no table reaches {threshold} for the stream's header (best score {score:.2f})")

    def write_batch(batch: DataFrame, batch_id: int):
        session = batch.sparkSession
        source = f"stream:{query_id(session, checkpoint)}:{batch_id}"
        rows = S.prepared(batch, table, columns, known_schemas, threshold, method, phi)
        if S.add_part(session, root, S.STAGED, table, source, rows, source) is None:
            log.info("%s was committed before", source)

    return _run(_source(spark, folder, schema, fmt, max_files_per_trigger), write_batch, checkpoint)
