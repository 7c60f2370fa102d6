"""Plain Parquet tables for jobs that may run a batch again.

Each run of a job (a micro-batch of a checkpoint, or a scheduled run) writes its
rows into partitions of its own, ``<root>/<table>/.../writer=<w>/run=<n>``. A run
that is repeated overwrites just these (dynamic partition overwrite), so a
repeat changes nothing. When all its tables are written, the run gets its one row
in the table ``runs``, and readers join their rows with ``runs``: what several
tables got from a run shows together, and a run that broke off doesn't show.
The join is on partition columns, so unfinished runs are pruned, not read.

Nothing is merged on write. Readers take the last row per key with the
aggregates of ``skyroll.operators.upsert``, ordered by ``finished_at`` first:
what is finished later wins. Jobs of several drivers that write the same root
need clocks that agree; one writer's runs are in order anyway.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUNS = "runs"
RESET = "reset"
RUN_KEY = [T.StructField("writer", T.StringType()), T.StructField("run", T.LongType())]
RUNS_SCHEMA = T.StructType([T.StructField("finished_at", T.TimestampType()), *RUN_KEY])


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- runs --------------------------------------------------------------
    def runs(self) -> DataFrame:
        """One row per finished run: finished_at, writer, run."""
        return self._rows(RUNS, RUNS_SCHEMA)

    def last_run(self, writer: str) -> int:
        """The writer's last finished run, -1 if there is none. Runs of one writer only grow."""
        last = self.runs().filter(F.col("writer") == writer).agg(F.max("run")).first()[0]
        return -1 if last is None else last

    def begin(self, writer: str, run: int | None = None) -> int:
        """The number of a scheduled run, the next one if None; one that isn't newer than the last is refused."""
        last = self.last_run(writer)
        if run is not None and run <= last:
            raise ValueError(f"run {run} of {writer} isn't newer than the last one finished in {self.root}")
        return last + 1 if run is None else run

    def finish(self, writer: str, run: int) -> None:
        """Show the run's rows: the last thing that a run writes, one row in one file."""
        now = _dt.datetime.now(_dt.timezone.utc)
        row = self.spark.createDataFrame([(now, writer, run)], RUNS_SCHEMA)
        self.write(row.select("finished_at").coalesce(1), RUNS, writer, run)

    def reset(self) -> None:
        """Start over (optional before a full reload): runs finished up to now no longer show.

        Nothing is deleted, and writers keep their run numbers: a running stream goes on with its next batch.
        """
        self.finish(RESET, self.begin(RESET))

    # -- rows --------------------------------------------------------------
    def write(self, df: DataFrame, table: str, writer: str, run: int, by: tuple[str, ...] = ()) -> None:
        """Write a run's rows of ``table``, partitioned by the columns ``by`` first."""
        (df.withColumn("writer", F.lit(writer)).withColumn("run", F.lit(run).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*by, "writer", "run").parquet(f"{self.root}/{table}"))

    def of_run(self, table: str, schema: T.StructType, writer: str, run: int) -> DataFrame:
        """What a run has written, finished or not."""
        rows = self._rows(table, T.StructType([*schema.fields, *RUN_KEY]))
        return rows.filter((F.col("writer") == writer) & (F.col("run") == run)).select(*schema.names)

    def staged(self, df: DataFrame, table: str, writer: str, run: int) -> DataFrame:
        """``df`` as written by this run; growing sources no longer change it."""
        self.write(df, table, writer, run)
        return self.of_run(table, df.schema, writer, run)

    def read(self, table: str, schema: T.StructType) -> DataFrame:
        """Rows of finished runs since the last reset, with finished_at, writer and run."""
        rows = self._rows(table, T.StructType([*schema.fields, *RUN_KEY]))
        return rows.join(self._shown(), ["writer", "run"]).select(*schema.names, "finished_at", "writer", "run")

    def newest(self, table: str, schema: T.StructType, writer: str) -> DataFrame:
        """A table that each run writes whole: the rows of the last finished run since the last reset."""
        last = self._shown().filter(F.col("writer") == writer).agg(F.max("run")).first()[0]
        return self.of_run(table, schema, writer, -1 if last is None else last)

    def _shown(self) -> DataFrame:
        """Finished runs since the last reset."""
        since = self.runs().filter(F.col("writer") == RESET).agg(F.max("finished_at")).first()[0]
        return self.runs() if since is None else self.runs().filter(F.col("finished_at") > F.lit(since))

    def _rows(self, table: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{table}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
