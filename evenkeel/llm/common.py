"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import pickle
import uuid

from pyspark import cloudpickle
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.session import shared_dir

# The white space of the word and line rules, and the pattern of a word.
WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Tables counted to hold at most this many narrow rows may be broadcast.
SMALL_ROWS = 200_000


def shipped(spark: SparkSession, value) -> Broadcast:
    """A broadcast of ``value`` that tasks open with ``received``.

    Pickled as functions are, so the classes of this subpackage travel with their objects and
    executors need no copy of it; a plain broadcast would name the class and leave the import to them.
    """
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(shared: Broadcast):
    return pickle.loads(shared.value)


def text_of(column: str = "text") -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(column), F.lit(""))


def lowered(text: Column) -> Column:
    """A-Z in lower case, everything else untouched."""
    return F.translate(text, UPPER, LOWER)


def remainder(n: int, key: str = "doc_id") -> Column:
    """crc32 of the key's decimal text, modulo ``n`` (a null key counts as empty text)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


def fresh(spark: SparkSession, name: str) -> str:
    """A new place in the folder all executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, computed once."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted_small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table whose counted ``rows`` are few; leave others to the planner."""
    return F.broadcast(df) if rows <= SMALL_ROWS else df


def joined_by_share(rows: DataFrame, table: DataFrame, on: list[str], size: str, total: int, hot: int = 1000) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has one row per key and the number of its rows in ``size``.

    Keys with at least 1/``hot`` of the ``total`` rows are joined by broadcast: there are at most
    ``hot`` of them, whatever the data. The others are shuffled, each at most that share.
    """
    many = table.filter(F.col(size) * hot >= total)
    found = rows.join(F.broadcast(many.withColumn("__hot", F.lit(True))), on, "left")
    names = [*rows.columns, *[c for c in table.columns if c not in on]]
    rest = found.filter("__hot IS NULL").select(*rows.columns).join(table.filter(F.col(size) * hot < total).hint("merge"), on)
    return found.filter("__hot").select(*names).unionByName(rest.select(*names))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
