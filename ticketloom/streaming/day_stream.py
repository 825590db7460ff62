"""Day files as a stream: every file once, by Spark's own file source and checkpoint.

The stream is for sources that only ever add files. What a corrected or repeated file
means is decided by ``arrivals``, which replaces whole days; a stream never takes a row back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.operators.agent_load import daily_agent_load
from ticketloom.operators.clean import fact_tickets
from ticketloom.operators.daily import backlog_daily, features_daily, running_backlog
from ticketloom.operators.ticket_days import ticket_rows
from ticketloom.schema import FACT_COLUMNS
from ticketloom.sources import folders
from ticketloom.sources.day_files import DayFiles, stream_files


@dataclass(frozen=True)
class DayStream:
    """Tables that a stream appends to, under ``root``: ``facts``, one row per ticket, and
    ``ticket_days``, the additive rows that every day-level result is a sum of.

    Each table is written by a query with a checkpoint of its own. Its Parquet sink keeps
    a log of whole batches, so a batch that is run again after a failure counts once.
    """

    spark: SparkSession
    root: str

    def advance(self, files: DayFiles, files_per_batch: int = 1000) -> dict[str, int]:
        """Take in every file that has come since the last time, then stop. Returns how many
        records each query read (in its last 100 batches): none where no file is new.

        Malformed records are appended to ``quarantine``, not to the other tables.
        """
        raw = stream_files(self.spark, files, files_per_batch)
        if raw is None:
            return {}
        good = raw.where("_malformed is null")
        facts = fact_tickets(good, ("source_date",))
        tables = {
            "facts": facts,
            "ticket_days": ticket_rows(facts, "source_date"),
            # The CSV source gives this text only beside a cell; a malformed record has none.
            "quarantine": raw.where("_malformed is not null and ticket_id is null").selectExpr(
                "source_date", "_source_file", "_malformed AS record"
            ),
        }
        running = {name: self._append(name, rows) for name, rows in tables.items()}
        read = {}
        for name, query in running.items():
            query.awaitTermination()
            read[name] = sum(progress["numInputRows"] for progress in query.recentProgress)
        return read

    def _append(self, name: str, rows: DataFrame):
        return (
            rows.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", f"{self.root}/checkpoints/{name}")
            .trigger(availableNow=True)
            .partitionBy("source_date")
            .start(f"{self.root}/{name}")
        )

    def table(self, name: str) -> DataFrame:
        """``fact_tickets``, ``quarantine``, or a day-level result, of all whole batches."""
        results = {
            "features_daily": features_daily,
            "backlog_daily": backlog_daily,
            "running_backlog": running_backlog,
            "daily_agent_load": daily_agent_load,
        }
        if name in results:
            return results[name](self._read("ticket_days"))
        return self._read("quarantine") if name == "quarantine" else self._read("facts").select(*FACT_COLUMNS)

    def _read(self, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        if not folders.exists(self.spark, f"{path}/_spark_metadata"):
            raise FileNotFoundError(f"no stream has written {path} yet")
        return self.spark.read.parquet(path)
