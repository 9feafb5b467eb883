"""The library's shared folder and written tables, under the names used here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.store import shared_folder, shipped
from ..sources.store import stage as written
from ..sources.store import unstage as done_with

__all__ = ["documents", "done_with", "shared_folder", "shipped", "written"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
