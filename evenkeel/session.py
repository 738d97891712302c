"""Session defaults and the two rules every operator follows for small tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A table known to hold at most this many narrow rows may be broadcast.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 512 << 20


def build_session(app_name: str = "evenkeel", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators expect; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # wide expressions make generated methods that the JVM would otherwise only interpret
        "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
        "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named in ``spark.checkpoint.dir``.

    A machine-local folder is made only for a local master, where driver and
    executors are one process; a cluster must name its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="evenkeel-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


# Places of tables written by this process and not yet removed.
_places: list[str] = []


def new_place(spark: SparkSession, name: str) -> str:
    """A fresh folder for a table, in the folder all executors share."""
    place = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _places.append(place)
    return place


def remove_written(spark: SparkSession) -> int:
    """Delete every table written so far; frames that read them are of no use afterwards. Returns their number.

    For the end of a run whose results are elsewhere.
    """
    removed = 0
    while _places:
        place = spark._jvm.org.apache.hadoop.fs.Path(_places.pop())
        removed += bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True))
    return removed


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The table survives executor loss, later uses do not repeat its plan, and one job
    computes it. For tables that are used several times and are small next to the
    rows they come from.
    """
    path = new_place(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_bytes(kind: T.DataType) -> int:
    """A generous size of a value: 8 bytes a number, 64 a text, 32 entries an array or map."""
    if isinstance(kind, T.StructType):
        return sum(row_bytes(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return 32 * row_bytes(kind.elementType)
    if isinstance(kind, T.MapType):
        return 32 * (row_bytes(kind.keyType) + row_bytes(kind.valueType))
    return 64 if isinstance(kind, (T.StringType, T.BinaryType)) else 8


def small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` if its proven row bound, at the width of its rows, allows it; else leave it to the planner."""
    fits = max_rows <= BROADCAST_ROWS and max_rows * row_bytes(df.schema) <= BROADCAST_BYTES
    return F.broadcast(df) if fits else df


def small_counted(df: DataFrame) -> DataFrame:
    """``small`` for a table without a known bound: it is written, counted, and broadcast if it is small."""
    table = cut_lineage(df)
    return small(table, table.count())
