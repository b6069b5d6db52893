"""Tables laid out for lookups: ranges of a clustering key, Bloom filters on the columns that ranges cannot serve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_clustered(df: DataFrame, path: str, cluster: Sequence[str], bloom: Sequence[str] = (), files: int | None = None, distinct: int = 1_000_000, group_bytes: int = 128 << 20) -> None:
    """Writes df sorted by cluster, each file a range of it, with Bloom filters on the bloom columns.

    A test on the first clustering column passes over row groups by their least and greatest values; a test for a value
    of a bloom column, scattered over all ranges, passes over those whose filter lacks it. Dictionaries are switched off
    for the bloom columns, as keys rarely repeat in a row group. distinct is the number of values expected in a row
    group: a filter takes about 1.2 bytes for each. files defaults to the session's shuffle partitions.

    Null keys come first and are kept; an empty table gives an empty table; columns keep their names and order.
    """
    ranged = df.repartitionByRange(files, *cluster) if files else df.repartitionByRange(*cluster)
    out = ranged.sortWithinPartitions(*cluster).write.option("compression", "zstd").option("parquet.block.size", group_bytes)
    for c in bloom:
        out = out.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.expected.ndv#{c}", distinct)
        out = out.option(f"parquet.enable.dictionary#{c}", "false")
    out.parquet(path)
