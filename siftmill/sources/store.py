"""Tables on Parquet by run, configuration, and files that readers see whole."""

from __future__ import annotations

import atexit
import csv
import json
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local: list[str] = []
_sent: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a local session without one gets a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="siftmill-"))
        atexit.register(shutil.rmtree, _local[0], ignore_errors=True)
    return f"file://{_local[0]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    A cut in its lineage that outlives executors: a later stage that loses one reads the
    files again. Files stay until ``unstage``, or until the folder is cleared.
    """
    path = f"{shared_folder(df.sparkSession)}/siftmill/{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{name}")
    out = df.sparkSession.read.schema(df.schema).parquet(f"{path}/{name}")
    out._staged = path
    return out


def unstage(df: DataFrame) -> None:
    """Deletes a table that ``stage`` gave and nothing will read again."""
    spark, jvm = df.sparkSession, df.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(df._staged)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of an Arrow batch, unless the session says otherwise than Spark's own default: texts are long.
ARROW_ROWS, _ARROW, _SPARKS = 2000, "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def shipped(df: DataFrame) -> DataFrame:
    """``df``, once the Python workers of its session can import this package and get batches of a size that fits them."""
    if df.sparkSession.conf.get(_ARROW) == _SPARKS:
        df.sparkSession.conf.set(_ARROW, str(ARROW_ROWS))
    root = Path(__file__).resolve().parents[2]
    context = df.sparkSession.sparkContext
    if str(root) not in os.environ.get("PYTHONPATH", "").split(os.pathsep) and context.applicationId not in _sent:
        folder = tempfile.mkdtemp(prefix="siftmill-zip-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.addPyFile(shutil.make_archive(f"{folder}/siftmill", "zip", root, "siftmill"))
        _sent.add(context.applicationId)
    return df


class Store:
    """articles, excluded, runs and delivered under one root. Runs only append; upkeep replaces whole runs.

    What the articles' state is follows from the logs: a run is what its last row in
    ``runs`` says, an article is delivered once ``delivered`` has a row for it.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def append(self, table: str, df: DataFrame, partition: str | None = "run_id") -> None:
        w = df.write.mode("append")
        (w.partitionBy(partition) if partition else w).parquet(self.path(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def start_run(self, run_id: int, requested_at: str, search_start: str, search_end: str) -> None:
        self._run(run_id, "running", requested_at, search_start, search_end)

    def finish_run(self, run_id: int, status: str, at: str) -> None:
        self._run(run_id, status, at, None, None)

    def _run(self, run_id: int, status: str, at: str, start: str | None, end: str | None) -> None:
        schema = "run_id long, status string, at string, search_start string, search_end string"
        self.append("runs", self.spark.createDataFrame([(run_id, status, at, start, end)], schema), None)

    def runs(self) -> DataFrame:
        """run_id, status, requested_at, finished_at, search_start, search_end of each run, from its rows."""
        done = F.col("status") != "running"
        return self.read("runs").groupBy("run_id").agg(
            F.max_by("status", F.struct("at", done)).alias("status"),
            F.min("at").alias("requested_at"),
            F.max(F.when(done, F.col("at"))).alias("finished_at"),
            F.max("search_start").alias("search_start"),
            F.max("search_end").alias("search_end"),
        )

    def deliver(self, run_id: int, ids: DataFrame, at: str) -> None:
        """Marks ``ids`` (id) delivered and the run successful. Call it after publishing.

        The run's row is the one record that counts: rows that are marked before it are delivered once it is there,
        so a run that breaks off in between has delivered nothing.
        """
        self.append("delivered", ids.select("id", F.lit(at).alias("delivered_at"), F.lit(run_id).cast("long").alias("run_id")))
        self.finish_run(run_id, "success", at)

    def delivered(self) -> DataFrame:
        """id of the rows that a successful run delivered."""
        done = self.runs().where("status = 'success'").select("run_id")
        return self.read("delivered").select("id", "run_id").join(done, "run_id", "left_semi").select("id").distinct()

    def history(self) -> DataFrame:
        """Delivered articles."""
        return self.read("articles").join(self.delivered(), "id", "left_semi")

    def last_success(self) -> str | None:
        """When the last successful run was asked for; none if there was none."""
        done = self.runs().where("status = 'success'").agg(F.max_by("requested_at", "run_id").alias("at")).first() if self.exists("runs") else None
        return done["at"] if done else None

    def exists(self, table: str) -> bool:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(table))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def as_if_delivered(self, current: DataFrame) -> DataFrame:
        """History and the current rows, as the report will show them."""
        return self.history().unionByName(current, allowMissingColumns=True)

    def replace_runs(self, table: str, runs: DataFrame, rows: DataFrame) -> None:
        """Puts ``rows`` in place of all rows of ``runs`` (run_id): partition by partition, the others are not touched.

        ``rows`` may be read from the table itself; they are written aside first.
        """
        new = stage(rows, "replaced")
        gone = [r["run_id"] for r in runs.select("run_id").distinct().join(new.select("run_id").distinct(), "run_id", "left_anti").collect()]  # runs are few
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(self.path(table))
        jvm = self.spark._jvm
        for run in gone:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.path(table)}/run_id={run}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def retain(self, table: str, column: str, since: str) -> None:
        """Drops rows whose ``column`` is before ``since``, in the runs that have such rows."""
        rows = self.read(table)
        runs = stage(rows.where(F.col(column) < F.lit(since)).select("run_id").distinct(), "runs")
        self.replace_runs(table, runs, rows.join(F.broadcast(runs), "run_id", "left_semi").where(F.col(column) >= F.lit(since)))

    def to_drop(self, table: str, ids: DataFrame) -> DataFrame:
        """The rows that ``drop`` would remove: a look at them changes nothing."""
        return self.read(table).join(ids.select("id").distinct(), "id", "left_semi")

    def drop(self, table: str, ids: DataFrame) -> int:
        """Removes the rows of ``ids`` (id) for good; how many rows are left."""
        rows = self.read(table)
        gone = stage(rows.join(ids.select("id").distinct(), "id", "left_semi").select("id", "run_id"), "gone")
        runs = gone.select("run_id").distinct()
        self.replace_runs(table, runs, rows.join(runs, "run_id", "left_semi").join(gone.select("id"), "id", "left_anti"))
        return self.read(table).count() if self.exists(table) else 0

    def update(self, table: str, changed: DataFrame) -> None:
        """Puts ``changed`` (all columns) in place of the rows with the same id."""
        rows = self.read(table)
        new = stage(changed, "changed")
        runs = new.select("run_id").distinct()
        self.replace_runs(table, runs, rows.join(runs, "run_id", "left_semi").join(new.select("id"), "id", "left_anti").unionByName(new))


def load_config(path: str) -> dict:
    """A nested configuration from a YAML or JSON file."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        return json.loads(text)
    import yaml

    return yaml.safe_load(text)


def publish(path: str, text: str) -> None:
    """Writes beside ``path`` and renames, so that a reader sees the old text or the new."""
    part = f"{path}.tmp"
    Path(part).write_text(text, encoding="utf-8")
    os.replace(part, path)


def write_csv(path: str, header: Iterable[str], rows: Iterable[Iterable]) -> None:
    """CSV with a byte order mark, published whole."""
    part = f"{path}.tmp"
    with open(part, "w", encoding="utf-8-sig", newline="") as f:
        out = csv.writer(f)
        out.writerow(list(header))
        out.writerows(rows)
    os.replace(part, path)
