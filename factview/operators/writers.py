"""Writing Parquet so that readers see all of it or nothing."""

from __future__ import annotations

import os
import shutil
import uuid
from pathlib import Path

from pyspark.sql import DataFrame

from factview.operators.normalize import compact, contours, total_order
from factview.plans.manifest import ContourDataset
from factview.plans.views import contour_plan


def write_folder(df: DataFrame, path: str, *, compression: str = "zstd", max_records: int | None = None) -> int:
    """A new folder of Parquet files, written by the executors; the number of its rows.

    The folder must not exist: versions are never overwritten. ``max_records``
    bounds the rows of a file.
    """
    writer = df.write.mode("errorifexists").option("compression", compression)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def write_file(df: DataFrame, path: str | Path, *, compression: str = "zstd", row_group_bytes: int | None = None, ordered: bool = False) -> int:
    """One Parquet file, put in place by a rename; for results that fit one file. The number of its rows.

    Rows are made by many tasks and written by one, which keeps their order if
    they are ``ordered``.
    """
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    beside = path.parent / f".{path.name}.{uuid.uuid4().hex}"
    try:
        writer = (df.coalesce(1) if ordered else df.repartition(1)).write.option("compression", compression)
        if row_group_bytes:
            writer = writer.option("parquet.block.size", row_group_bytes)
        writer.parquet(str(beside))
        rows = df.sparkSession.read.schema(df.schema).parquet(str(beside)).count()
        (part,) = beside.glob("part-*.parquet")
        os.replace(part, path)
        return rows
    finally:
        shutil.rmtree(beside, ignore_errors=True)


def write_components(dataset: ContourDataset, facts: DataFrame, contour: DataFrame, directory: str | Path) -> dict[str, int]:
    """Compact facts and contours as files of reproducible bytes (totally ordered)."""
    out = Path(directory)
    return {
        name: write_file(total_order(df, first), out / f"{name}.parquet", ordered=True)
        for name, df, first in (
            (dataset.compact_table, compact(facts, dataset), dataset.fact_join_columns),
            (dataset.contour_table, contours(contour, dataset), dataset.contour_join_columns),
        )
    }


def export_joined(dataset: ContourDataset, facts: DataFrame, contour: DataFrame, path: str | Path, row_group_bytes: int = 16 << 20) -> int:
    """The wide table as a file, unsorted: it may be much larger than its parts."""
    return write_file(contour_plan(dataset, facts, contour), path, row_group_bytes=row_group_bytes)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV in which an empty text ("") and null (nothing) differ."""
    df.write.mode("errorifexists").option("emptyValue", '""').option("nullValue", "").option("escape", '"').csv(path)
