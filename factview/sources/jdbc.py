"""Databases over JDBC; the driver's jar must be on the class path."""

from __future__ import annotations

from urllib.parse import parse_qsl, unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession

#: Settings that never appear in options shown or in errors.
SECRET = {"password", "user", "sslkey", "sslpassword", "passfile"}


def connection(url: str) -> tuple[dict[str, str], dict[str, str]]:
    """(open settings, secrets) of a postgresql:// URL; several hosts are joined by commas."""
    parts = urlsplit(url)
    if parts.scheme.split("+")[0] not in ("postgres", "postgresql"):
        raise ValueError("a postgresql:// URL is needed")
    hosts = parts.netloc.rpartition("@")[2] or "localhost"
    settings = {"url": f"jdbc:postgresql://{hosts}/{unquote(parts.path.lstrip('/'))}", "driver": "org.postgresql.Driver"}
    settings |= {k: v for k, v in parse_qsl(parts.query) if k not in SECRET}
    secrets = {k: v for k, v in parse_qsl(parts.query) if k in SECRET}
    secrets |= {k: unquote(v) for k, v in (("user", parts.username), ("password", parts.password)) if v}
    return settings, secrets


def read_table(spark: SparkSession, url: str, table: str, partition_column: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 1) -> DataFrame:
    """A table of a database; errors name the host and the table only."""
    settings, secrets = connection(url)
    reader = spark.read.format("jdbc").options(**settings, **secrets, dbtable=table)
    if partition_column and bounds:
        reader = reader.options(partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions)
    try:
        return reader.load()
    except Exception as error:
        raise ConnectionError(f"cannot read {table!r} at {settings['url'].split('?')[0]}: {type(error).__name__}") from None
