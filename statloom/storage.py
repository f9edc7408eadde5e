"""Hand-over tables between stages, and joins whose small side is size-checked."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only when it has at most this many rows and bytes (as written).
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 16 << 20
#: Share of all rows from which a key is hot; counters of the sketch that finds hot keys.
HOT_SHARE, COUNTERS = 1 / 512, 1 << 14


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors reach: the one the session names in ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="statloom-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/statloom/{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def written_bytes(spark: SparkSession, path: str) -> int:
    files, place = _file_system(spark, path)
    return int(files.getContentSummary(place).getLength())


def clear_scratch(spark: SparkSession) -> int:
    """Deletes the hand-over tables that this process has written; how many there were.

    To be called when no result that reads them is needed any more.
    """
    for name in _tables.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    paths, gone = _written.pop(spark.sparkContext.applicationId, []), 0
    for path in paths:
        files, place = _file_system(spark, path)
        gone += bool(files.delete(place, True))
    return gone


def discard(spark: SparkSession, path: str) -> None:
    """Deletes one hand-over table that no later step reads."""
    files, place = _file_system(spark, path)
    files.delete(place, True)
    left = _written.get(spark.sparkContext.applicationId, [])
    if path in left:
        left.remove(path)


#: Folders of hand-over tables of each application, and names of those that the session's catalog knows.
_written: dict[str, list[str]] = {}
_tables: dict[str, list[str]] = {}


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet and continue from the files.

    The next steps then neither repeat the work nor depend on executors that held it, and
    ``count()`` on the result is answered from the file footers.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_by(df: DataFrame, label: str, key: str, buckets: int | None = None) -> DataFrame:
    """``materialize`` into buckets by ``key``, one sorted file each.

    Joins and groupings by the key of tables with as many buckets (default: shuffle partitions) then
    move no rows. One shuffle now, for tables that are merged or grouped by the key more than once.
    """
    n = buckets or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return write_buckets(df.repartition(n, f"`{key}`"), label, key, n)


def write_buckets(df: DataFrame, label: str, key: str, buckets: int) -> DataFrame:
    """The writing of ``materialize_by`` alone, for rows that a grouping has dealt by the key already."""
    spark = df.sparkSession
    path, name = scratch_path(spark, label), f"statloom_{uuid.uuid4().hex}"
    _tables.setdefault(spark.sparkContext.applicationId, []).append(name)
    df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return spark.table(name)


def join_bounded(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
    salts: int = 32,
    sketched: bool = False,
) -> DataFrame:
    """Equi-join ``big`` with a side that holds one row per key.

    ``small`` is written once and measured: up to ``max_rows`` rows and ``BROADCAST_BYTES`` bytes it
    is broadcast, so hot keys of ``big`` never move. Beyond that both sides are shuffled, ``big``
    salted by row number and ``small`` repeated per salt, so a hot key spreads over ``salts`` tasks.
    ``sketched`` reads the keys of ``big`` once more before, to salt and repeat hot keys alone: for a
    ``big`` that is stored or cheap to compute. Results do not depend on it.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    spark = big.sparkSession
    path = scratch_path(spark, "side")
    small.write.parquet(path)
    small = spark.read.schema(small.schema).parquet(path)
    renamed = small.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = None
    for k in keys:
        equal = big[k].eqNullSafe(renamed[f"__{k}"])
        on = equal if on is None else on & equal
    if small.count() <= max_rows and written_bytes(spark, path) <= BROADCAST_BYTES:
        return big.join(F.broadcast(renamed), on, how).drop(*[f"__{k}" for k in keys])
    hot = hot_keys(big, keys) if sketched and _hashable(big, small, keys) else None
    if hot == []:
        return big.join(renamed, on, how).drop(*[f"__{k}" for k in keys])
    salted = big.withColumn("__salt", _hot_or(big, keys, hot, F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"), F.lit(0)))
    repeated = _repeated(renamed, [f"__{k}" for k in keys], hot, salts)
    on = salted["__salt"] == repeated["__copy"]
    for k in keys:
        on = on & salted[k].eqNullSafe(repeated[f"__{k}"])
    return salted.join(repeated, on, how).drop("__salt", "__copy", *[f"__{k}" for k in keys])


def hot_keys(df: DataFrame, keys: list[str], share: float = HOT_SHARE) -> list[int]:
    """Hashes of the keys that hold at least ``share`` of all rows, by a sketch of frequent items.

    One pass with a state of fixed size. The sketch never counts too little, and its error (3.5 rows
    in ``COUNTERS``) is a fraction of the share: no hot key is missed, some may be added that hold a
    little less.
    """
    hashed = df.select(F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias("h"))
    most = min(COUNTERS, 2 * int(1 / share))
    row = hashed.agg(F.expr(f"approx_top_k(h, {most}, {COUNTERS})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return sorted(x["item"] for x in row["top"] or [] if x["count"] >= max(share * row["n"], 2))


def _hashable(big: DataFrame, small: DataFrame, keys: list[str]) -> bool:
    """Whether equal keys have equal hashes: not so for numbers of different types, or -0.0."""
    plain = {"string", "binary", "boolean", "tinyint", "smallint", "int", "bigint", "date", "timestamp"}
    kinds = [(big.schema[k].dataType.simpleString(), small.schema[k].dataType.simpleString()) for k in keys]
    return all(a == b and a in plain for a, b in kinds)


def _hot_or(df: DataFrame, keys: list[str], hot: list[int] | None, then: Column, otherwise: Column) -> Column:
    """``then`` for rows with a hot key (None: for all rows)."""
    return then if hot is None else F.when(F.xxhash64(*[df[f"`{k}`"] for k in keys]).isin(hot), then).otherwise(otherwise)


def _repeated(small: DataFrame, keys: list[str], hot: list[int] | None, salts: int) -> DataFrame:
    """A row per salt for hot keys, one for all others."""
    copies = _hot_or(small, keys, hot, F.sequence(F.lit(0), F.lit(salts - 1)), F.array(F.lit(0)))
    return small.withColumn("__copy", F.explode(copies))
