"""Sources as DataFrames, and what identifies their content."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factview.functions.names import column

CHUNK = 1 << 20


@dataclass(frozen=True)
class ArrowSource:
    """A table in memory; pandas frames are converted first."""

    name: str
    table: pa.Table


@dataclass(frozen=True)
class TableSource:
    """A table published in a store, as it is now; its identity is its marker's update id."""

    table: str
    locations: tuple[str, ...]
    update_id: str


Source = str | Path | ArrowSource | TableSource | DataFrame


def as_source(value: Any, name: str = "source") -> Source:
    if isinstance(value, pd.DataFrame):
        return ArrowSource(name, pa.Table.from_pandas(value, preserve_index=False))
    if isinstance(value, pa.Table):
        return ArrowSource(name, value)
    return str(value) if isinstance(value, Path) else value


def resolve(spark: SparkSession, source: Any) -> DataFrame:
    """The rows of a source. Only a table in memory goes through the driver."""
    source = as_source(source)
    if isinstance(source, DataFrame):
        return source
    if isinstance(source, ArrowSource):
        plain = [f.with_type(f.type.value_type) if pa.types.is_dictionary(f.type) else f for f in source.table.schema]
        return spark.createDataFrame(source.table.cast(pa.schema(plain)))
    if isinstance(source, TableSource):
        return spark.read.parquet(*source.locations)
    return spark.read.parquet(source)


def bind(spark: SparkSession, sources: Mapping[str, Any]) -> dict[str, DataFrame]:
    return {name: resolve(spark, source) for name, source in sources.items()}


def from_directory(keys: list[str], directory: str | Path) -> dict[str, str]:
    """<directory>/<key>.parquet for each source key."""
    return {key: f"{str(directory).rstrip('/')}/{key}.parquet" for key in keys}


def _sha256(path: Path) -> str:
    out = hashlib.sha256()
    with path.open("rb") as file:
        while chunk := file.read(CHUNK):
            out.update(chunk)
    return out.hexdigest()


def _remote(spark: SparkSession, path: str) -> str:
    """A digest of the names and contents of a remote path's files, computed on the executors."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    rows = files.select(F.regexp_extract("path", "[^/]+$", 0).alias("name"), F.sha2("content", 256).alias("sha"))
    one = rows.agg(F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list(F.concat_ws(" ", "name", "sha")))).cast("binary"), 256).alias("sha"))
    return one.first()["sha"]


def _rows(df: DataFrame) -> str:
    """A digest of schema and multiset of rows, in one pass: rows counted, and two 64-bit hashes of each summed."""
    # Maps have no order of their own and aren't hashed as they are.
    values = [F.to_json(column(f.name)) if "map<" in f.dataType.simpleString() else column(f.name) for f in df.schema.fields]
    absent = F.concat_ws(",", *[F.when(v.isNull(), F.lit(str(k))) for k, v in enumerate(values)])
    sums = [F.sum(F.xxhash64(F.lit(seed), absent, *values).cast("decimal(38,0)")).alias(f"s{seed}") for seed in (1, 2)]
    row = df.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    return hashlib.sha256(f"{json.dumps(describe(df))} {row['n']} {row['s1']} {row['s2']}".encode()).hexdigest()


def identity(spark: SparkSession, source: Any) -> str:
    """What changes if and only if the content changes; of a DataFrame, its schema and rows, whatever plan they come from."""
    source = as_source(source)
    if isinstance(source, TableSource):
        return source.update_id
    if isinstance(source, ArrowSource):
        sink = pa.BufferOutputStream()
        table = source.table.combine_chunks()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        return hashlib.sha256(sink.getvalue()).hexdigest()
    if isinstance(source, DataFrame):
        return _rows(source)
    path = Path(source.removeprefix("file://")) if "://" not in source or source.startswith("file://") else None
    if path is None:
        return _remote(spark, source)
    if path.is_file():
        return _sha256(path)
    parts = sorted(p for p in path.rglob("*") if p.is_file() and not p.name.startswith(("_", ".")))
    if not parts:
        raise FileNotFoundError(source)
    return hashlib.sha256("".join(f"{p.relative_to(path)} {_sha256(p)}\n" for p in parts).encode()).hexdigest()


def describe(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def statistics(df: DataFrame) -> tuple[int, dict[str, int]]:
    """Rows, and nulls of each column, in one pass."""
    counts = [F.count_if(column(c).isNull()).alias(f"n{k}") for k, c in enumerate(df.columns)]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *counts).first()
    return row["rows"], {c: row[f"n{k}"] for k, c in enumerate(df.columns)}
