"""Where rows come from: files, Arrow or pandas tables in memory, published tables, databases."""

from factview.sources.resolve import ArrowSource, TableSource, as_source, bind, describe, from_directory, identity, resolve, statistics

__all__ = ["ArrowSource", "TableSource", "as_source", "bind", "describe", "from_directory", "identity", "resolve", "statistics"]
