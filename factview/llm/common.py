"""Shared pieces of the corpus operators: tables, words, work folder, batches."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word definition: space and U+0009 to U+000D, nothing else.
SPACE_CLASS = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
#: Rows that a side of a join may have, after counting, to be broadcast (a few numbers each: about 2 MB).
BROADCAST_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text as an array; empty for a text without words."""
    return F.array_remove(F.split(text, SPACE_CLASS + "+"), "")


def shingle_hashes(tokens: Column, size: int) -> Column:
    """64-bit hashes of all runs of ``size`` words; none for fewer words."""
    return F.when(
        F.size(tokens) >= size,
        F.transform(
            F.sequence(F.lit(0), F.size(tokens) - F.lit(size)),
            lambda i: F.xxhash64(*[F.get(tokens, i + F.lit(k)) for k in range(size)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def work_dir(spark: SparkSession) -> str:
    """A new folder under the checkpoint directory that the session names.

    A folder of this machine is used only where none is named and the master
    is local; on a cluster without the setting this raises.
    """
    context = spark.sparkContext
    base = context.getCheckpointDir()
    if base is None:
        base = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if base is None:
            master = context.master
            if not master.startswith("local") or master.startswith("local-cluster"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            base = tempfile.mkdtemp(prefix="factview-checkpoint-")
        context.setCheckpointDir(base)
        base = context.getCheckpointDir()
    return f"{base}/work-{uuid.uuid4().hex}"


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session may be gone at exit
        pass


#: Whether Spark deletes a query's shuffle files as it ends, instead of when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Queries within leave no shuffle files; only for those that are run once."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """The rows of ``df`` from a Parquet table in the shared work folder.

    Cuts the lineage: a lost executor costs the files' rereading only.
    The shuffles that made it end with it.
    """
    spark, path = df.sparkSession, work_dir(df.sparkSession)
    with shuffles_end(spark):
        df.write.option("compression", compression).parquet(path)
    _PATHS[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


#: Stored tables that are still there.
_PATHS: dict[str, SparkSession] = {}


def _remove_all() -> None:
    for path, spark in list(_PATHS.items()):
        _remove(spark, path)


atexit.register(_remove_all)


def forget(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more; what follows them must be stored or checkpointed itself."""
    for df in tables:
        path = getattr(df, "_stored_at", None)
        if path in _PATHS:
            _remove(_PATHS.pop(path), path)


def checked(df: DataFrame) -> DataFrame:
    """``df`` checkpointed in the shared folder, for steps of an iteration."""
    work_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Holds the columns that an operator passes on, so that no name clashes with its own.
OTHERS = "__others"


def packed(docs: DataFrame, *needed: str) -> DataFrame:
    """The needed columns as far as there are any, and all others as one."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in needed]
    return docs.select(*[c for c in needed if c in docs.columns], F.struct(*others or [F.lit(None).alias("none")]).alias(OTHERS))


def unpacked(rows: DataFrame, columns: list[str], needed: tuple[str, ...], added: Sequence[str] = ()) -> DataFrame:
    """The columns from before ``packed`` in their order, less those that are added at the end."""
    own = [F.col(c) if c in needed else F.col(OTHERS).getField(c).alias(c) for c in columns if c not in added]
    return rows.select(*own, *added)


def release(spark: SparkSession) -> None:
    """Lets Spark drop the broadcasts and shuffle files of steps that are done, which it does as objects are collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def where_computed(df: DataFrame, condition: Column) -> DataFrame:
    """The rows for which a costly condition holds.

    A plain filter would be moved below the projections that compute its
    columns and repeat their work; a generator stays where it is.
    """
    names = [F.col(f"`{c}`") for c in df.columns]
    return df.select(*names, F.explode(F.when(condition, F.array(F.lit(True)))).alias("__held")).drop("__held")


def small_or_shuffled(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it has at most BROADCAST_ROWS rows, else as it is."""
    n = df.limit(BROADCAST_ROWS + 1).count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items whose sizes sum to at most ``most`` (single items may be larger)."""
    begin, held = 0, 0
    for i, n in enumerate(sizes):
        if i > begin and held + n > most:
            yield begin, i
            begin, held = i, 0
        held += n
    if begin < len(sizes):
        yield begin, len(sizes)
