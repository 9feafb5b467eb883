"""Pages that executors write: a part for each block of a run, and a pointer that moves only once all parts are there."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 1000  # cards of one block

_SAFE = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"))


def escaped(c: str) -> Column:
    out = F.coalesce(F.col(c).cast("string"), F.lit(""))
    for a, b in _SAFE:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def cards(rows: DataFrame) -> DataFrame:
    """run_id, pub_date, id, html of each row (run_id, id, title, url, company, press, pub_date, summary): a card for the archive."""
    line = F.concat_ws(" · ", escaped("company"), escaped("press"), escaped("pub_date"))
    told = F.replace(escaped("summary"), F.lit("\n"), F.lit("<br>"))
    html = F.concat(F.lit('<div class="item"><h3><a href="'), escaped("url"), F.lit('">'), escaped("title"), F.lit("</a></h3><p>"), line, F.lit("</p><p>"), told, F.lit("</p></div>"))
    return rows.select("run_id", "pub_date", "id", html.alias("html"))


class Pages:
    """Versions of a published archive under ``root``, of which the file ``CURRENT`` names the one to read.

    A version is written by tasks through Spark's own committer, each run in a folder of its own, its
    cards from the latest on. Only then ``CURRENT`` is replaced by one rename: a task that fails leaves the version before, and readers see
    one version or the other, whole. Nothing but the pointer's few bytes passes the driver. ``root`` is any folder that Spark can write.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def publish(self, cards: DataFrame) -> str:
        """Writes ``cards`` (run_id, pub_date, id, html) as a new version and makes it the current one; its name."""
        version = uuid.uuid4().hex
        parts = cards.repartitionByRange(F.col("run_id").desc(), F.col("pub_date").desc(), F.col("id").desc()).sortWithinPartitions(F.col("run_id").desc(), F.col("pub_date").desc(), F.col("id").desc())
        writer = parts.select("run_id", F.replace("html", F.lit("\n"), F.lit(" ")).alias("html")).write.partitionBy("run_id").option("maxRecordsPerFile", BLOCK)
        try:
            writer.text(f"{self.root}/versions/{version}")
        except Exception:
            self._files("versions").delete(self._path(f"versions/{version}"), True)
            raise
        self._point(version)
        return version

    def _files(self, name: str):
        return self._path(name).getFileSystem(self._conf)

    def _point(self, version: str) -> None:
        new = self._path(f".{version}")
        out = self._files("CURRENT").create(new, True)
        out.write(bytearray(version.encode()))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), self._conf).rename(new, self._path("CURRENT"), options)

    def current(self) -> str | None:
        """The version that readers see."""
        if not self._files("CURRENT").exists(self._path("CURRENT")):
            return None
        return self.spark.read.text(f"{self.root}/CURRENT").first()["value"]

    def read(self) -> DataFrame:
        """run_id, html of the current version's cards."""
        version = self.current()
        if version is None:
            return self.spark.createDataFrame([], "run_id long, html string")
        return self.spark.read.schema("value string, run_id long").text(f"{self.root}/versions/{version}").select("run_id", F.col("value").alias("html"))
