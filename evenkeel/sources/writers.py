"""Sinks: bounded files, training sets, numbered shards, result tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.operators.events import assign_files


def write_bounded(df: DataFrame, path: str, max_rows: int) -> None:
    """Parquet files of at most ``max_rows`` rows."""
    df.write.mode("overwrite").option("maxRecordsPerFile", max_rows).parquet(path)


def write_numbered(df: DataFrame, path: str, number: str, per_file: int = 1, name: str = "shard") -> None:
    """Folders ``name=0, 1, ...`` of ``per_file`` files each; ``number`` says which file a row goes to, from 0.

    Each file is one task's, whatever the others hold: rows are dealt by the number itself, not by a hash of it.
    """
    files = (df.agg(F.max(number)).first()[0] or 0) + 1
    dealt = df.withColumn(name, F.floor(F.col(number) / per_file).cast("int")).repartitionById(files, F.col(number).cast("int"))
    dealt.drop(number).write.mode("overwrite").partitionBy(name).parquet(path)


def write_shards(df: DataFrame, path: str, n_shards: int, hashed: str, per_shard: int = 1) -> None:
    """Rows in ``n_shards`` numbered folders of ``per_shard`` files, all files of one size but for one row.

    Files take ranges of the hash order, so any shard is a random sample; more files per shard spread large shards over tasks.
    """
    write_numbered(assign_files(df, n_shards * per_shard, [], hashed, 1), path, "file_no", per_shard)


def write_training_set(df: DataFrame, path: str, shuffle_key: str | None = None) -> None:
    """Training rows as Parquet; sorted by ``shuffle_key`` within and across files if given.

    The key is a hash in hex digits (``keys.shuffled``): as hashes are spread evenly, the range of every file is known
    beforehand, and the rows are not computed once more to find it.
    """
    ordered = df
    if shuffle_key:
        files = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        lead = F.when(F.col(shuffle_key).rlike("^[0-9a-f]{8}"), F.conv(F.substring(shuffle_key, 1, 8), 16, 10).cast("bigint"))
        number = F.coalesce(lead, F.raise_error(F.lit(f"{shuffle_key} is not a hash in hex digits")).cast("bigint"))
        ordered = df.repartitionById(files, F.shiftright(number * files, 32).cast("int")).sortWithinPartitions(shuffle_key)
    ordered.write.mode("overwrite").parquet(path)


def write_results(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Every result table to its own folder."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def write_json(table: DataFrame, path: str) -> None:
    """A small table (statistics, metrics) as one file of JSON lines; missing values stay out, NaN and infinities are written as such."""
    table.coalesce(1).write.mode("overwrite").json(path)
