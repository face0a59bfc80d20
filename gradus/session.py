"""Session helpers: runtime settings, checkpoint folder and size-checked broadcast."""

from __future__ import annotations

import re
import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only after its rows were counted and found below this.
BROADCAST_ROW_LIMIT = 200_000

# A broadcast side has this many bytes at most, as its values are counted.
BROADCAST_BYTE_LIMIT = 64 << 20

# Held partitions with fewer rows than this on average are merged.
ROWS_PER_TASK = 50_000

# A task reads this many bytes of a file at most. What it groups before a shuffle stays in its memory.
SCAN_BYTES = 32 << 20

# Folders of written copies, by application.
_written: dict[str, list[str]] = {}

# Runtime SQL settings the operators rely on. Skewed join partitions are split
# even where that costs one more exchange, because a key may hold a third of
# all rows. A join may reuse a partitioning on some of its keys, so that joins
# on (person), (person, term) and (person, term, course) move a base table once.
# Held frames are planned adaptively like any other.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that already exists."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    if _plain_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")) > SCAN_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(SCAN_BYTES))
    return spark


def _plain_bytes(size: str) -> int:
    """Bytes of a size as settings are written, such as 128m or 134217728b."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; if unset, one in the warehouse.

    Executors must see it, so without the setting a warehouse on the driver's own disk is
    refused, unless the executors are on the same machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    own_disk = warehouse.startswith(("file:", "/"))
    if own_disk and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
    return f"{warehouse}/gradus-copies"


def materialise(df: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and continue from the written copy.

    Cuts the lineage like a checkpoint, but computes the frame only once, is
    read by column, and lets later joins see its real size. The copy survives
    the loss of executors.
    """
    return materialise_at(df)[0]


def materialise_at(df: DataFrame) -> tuple[DataFrame, str]:
    """As ``materialise``, with the folder of the copy, for ``drop_path``."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/gradus-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete one written copy that is no longer read."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
    known = _written.get(context.applicationId, [])
    if path in known:
        known.remove(path)


def written_copies(spark: SparkSession) -> list[str]:
    """Folders of the copies that this application has written and not deleted."""
    return list(_written.get(spark.sparkContext.applicationId, []))


def drop_copies(spark: SparkSession) -> None:
    """Delete the copies that ``materialise`` wrote in this application, once their results are no longer read."""
    for path in written_copies(spark):
        drop_path(spark, path)


def hold(df: DataFrame) -> DataFrame:
    """Persist rows that many passes of a fit will read, in partitions worth a task.

    A frame with fewer partitions than cores is spread once it is held, and one
    with far too many for its rows is merged without a shuffle. A large frame
    stays as it is.
    """
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    rows = held.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = held.rdd.getNumPartitions()
    enough = max(cores, -(-rows // ROWS_PER_TASK))
    if cores <= parts <= 2 * enough:
        return held
    even = held.repartition(cores) if parts < cores else held.coalesce(enough)
    even = even.persist(StorageLevel.MEMORY_AND_DISK)
    even.count()
    held.unpersist()
    return even


def _bytes(df: DataFrame) -> Column:
    """Bytes of a row: eight for each plain value, the length of texts, and of other values as text."""
    plain = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    total = F.lit(16 + 8 * len(df.columns)).cast("bigint")
    for field in df.schema:
        if not isinstance(field.dataType, plain):
            value = F.col(f"`{field.name}`")
            text = value if isinstance(field.dataType, (T.StringType, T.BinaryType)) else F.to_json(F.struct(value))
            total = total + F.coalesce(F.octet_length(text), F.lit(0))
    return total


def broadcast_if_small(
    df: DataFrame, limit: int = BROADCAST_ROW_LIMIT, byte_limit: int = BROADCAST_BYTE_LIMIT
) -> DataFrame:
    """Hint a broadcast when a bounded count proves the frame small, in rows and in bytes.

    The count stops at ``limit + 1`` rows. A larger frame is returned without a
    hint, so the join shuffles and adaptive execution splits its hot partitions.
    """
    rows, size = df.limit(limit + 1).agg(F.count("*"), F.sum(_bytes(df))).first()
    return F.broadcast(df) if rows <= limit and (size or 0) <= byte_limit else df


def with_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame to every row, as a scalar subquery."""
    value = one_row.select(F.struct(*one_row.columns).alias("row")).scalar()
    return df.withColumns({c: value[c] for c in one_row.columns})
