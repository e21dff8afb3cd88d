"""Stored tables: typed reads (S4), published versions with a lookup layout (K1–K3), keyed upsert (K4).

The reference keeps its tables in a document store. Here they are Parquet folders on the shared file
system. A table that is replaced is written beside the old one as a new version, and a pointer file,
renamed into place, makes it the current one: a reader finds the old table or the new, never half of
one or none, and a write that fails leaves the old one as it was.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import list_subdirs, path_exists, shared_path, shuffles_dropped


#: Buckets of a lookup table where the caller names no other number.
LOOKUP_BUCKETS = 64


def read_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a stored table and pin it to the declared record schema (``.as[T]``)."""
    df = read_table(spark, path)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def stored(df: DataFrame, name: str) -> DataFrame:
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` (and its path) written once as Parquet under the shared folder and read back: the lineage is cut and a lost
    executor costs a re-read, and the shuffles that led here are deleted."""
    path = shared_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


# --- versions and the pointer to the current one ----------------------------------------------

_POINTER = "_CURRENT"
_VERSION = re.compile(r"v(\d{8})-[0-9a-f]{8}")


def _fs(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, path: str) -> str | None:
    """Name of the version the table's pointer names; None if nothing was published."""
    hpath, fs = _fs(spark, f"{path.rstrip('/')}/{_POINTER}")
    if not fs.exists(hpath):
        return None
    stream = fs.open(hpath)
    try:
        name = bytearray(stream.readNBytes(64)).decode().strip()
    finally:
        stream.close()
    if not _VERSION.fullmatch(name):
        raise ValueError(f"{path}: the pointer names no version: {name!r}")
    return name


def _number(version: str | None) -> int:
    return int(_VERSION.fullmatch(version).group(1)) if version else 0


def new_version(spark: SparkSession, path: str) -> str:
    """A folder name for the next version; nobody reads it before ``publish_version``."""
    return f"v{_number(current_version(spark, path)) + 1:08d}-{uuid.uuid4().hex[:8]}"


def publish_version(spark: SparkSession, path: str, version: str) -> None:
    """Make a completely written version the current one, and delete what is older than the one before.

    The pointer is written beside its place and renamed over it, which HDFS and local file systems do
    in one step. A reader that planned its scan on the version before still finds its files."""
    root = path.rstrip("/")
    draft, fs = _fs(spark, f"{root}/{_POINTER}.{version}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(version.encode()))
    finally:
        out.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    target, _ = _fs(spark, f"{root}/{_POINTER}")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(draft), context.makeQualified(target), options)
    for name in list_subdirs(spark, root):
        if _VERSION.fullmatch(name) and _number(name) < _number(version) - 1:
            drop_table(spark, f"{root}/{name}")


def table_path(spark: SparkSession, path: str) -> str:
    """The folder of the current version; ``path`` itself for a folder that was not published."""
    version = current_version(spark, path)
    return f"{path.rstrip('/')}/{version}" if version else path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(table_path(spark, path))


def drop_table(spark: SparkSession, path: str) -> None:
    """K2: remove a stored table with all its versions if it exists."""
    if path_exists(spark, path):
        hpath, fs = _fs(spark, path)
        fs.delete(hpath, True)


def overwrite_table(df: DataFrame, path: str, key: Sequence[str] | str | None = None) -> None:
    """K1 + K3: replace the table at ``path`` by a new version.

    With ``key`` the rows are rebalanced on the key and sorted within each file (the Parquet
    counterpart of the reference's lookup indexes): row groups cover narrow key ranges, so a
    filter on the key skips them through their min/max statistics. ``rebalance`` is one hash
    shuffle on the key in which AQE splits oversized partitions and merges small ones, so a key
    holding a third of all rows is written by several tasks into several files, without an extra
    pass over the input (range partitioning would first sample the whole input).
    """
    out = df
    if key:
        keys = [key] if isinstance(key, str) else list(key)
        out = df.hint("rebalance", *keys).sortWithinPartitions(*keys)
    version = new_version(df.sparkSession, path)
    out.write.parquet(f"{path.rstrip('/')}/{version}")
    publish_version(df.sparkSession, path, version)


def bucket_name(key: str, buckets: int) -> str:
    """Name of the bucket column of ``key``; it carries the bucket count (``mid_b64``)."""
    return f"{key}_b{int(buckets)}"


def bucket_of(col: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(col).cast("int")), F.lit(int(buckets))).cast("int")


def find_bucket(df: DataFrame, key: str) -> tuple[str, int] | None:
    """(column name, bucket count) when ``df`` is a lookup table bucketed on ``key``."""
    for c in df.columns:
        m = re.fullmatch(re.escape(key) + r"_b(\d+)", c)
        if m:
            return c, int(m.group(1))
    return None


def parts_of(table: DataFrame, part: str, values: DataFrame, value) -> DataFrame:
    """``table``, partitioned by the column ``part``, limited at run time to the partitions among the ``value``s of
    ``values``.

    The values are a scalar subquery (one array, no longer than the table has partitions) in the scan's
    partition filter: Spark evaluates it before the scan and lists only those directories, whatever join
    strategy it takes afterwards. (Dynamic pruning of a join is dropped where the small side is not
    broadcast.)"""
    return table.where(F.array_contains(values.agg(F.collect_set(value)).scalar(), F.col(part)))


def buckets_of(table: DataFrame, key: str, values: DataFrame, col: str) -> DataFrame:
    """``table`` without its bucket column, limited to the buckets of ``key`` that ``values[col]`` falls into; a
    table that is not bucketed on ``key`` comes back as it is."""
    info = find_bucket(table, key)
    if info is None:
        return table
    name, n = info
    return parts_of(table, name, values, bucket_of(col, n)).drop(name)


def write_lookup_table(df: DataFrame, path: str, key: str, buckets: int = LOOKUP_BUCKETS) -> None:
    """A lookup table partitioned into bucket directories by a hash of ``key`` and sorted by key
    within each file. ``buckets_of`` reads only the buckets some keys fall into: a micro-batch then
    scans a slice of the table, not all of it. ``rebalance`` on the bucket gives about one file per
    bucket; AQE splits a bucket that holds a hot key. The caller sets ``buckets`` for its
    table; nothing else depends on the size."""
    name = bucket_name(key, buckets)
    version = new_version(df.sparkSession, path)
    rows = df.withColumn(name, bucket_of(key, buckets)).hint("rebalance", name).sortWithinPartitions(name, key)
    with shuffles_dropped(df.sparkSession):
        rows.write.partitionBy(name).parquet(f"{path.rstrip('/')}/{version}")
    publish_version(df.sparkSession, path, version)


def write_catalog_table(df: DataFrame, name: str, key: Sequence[str], buckets: int = LOOKUP_BUCKETS) -> DataFrame:
    """K3 as a catalog table: hashed into ``buckets`` by the whole ``key`` and sorted by it within each.

    A join or aggregate on exactly that key reads the buckets as they lie, without a shuffle of this
    side; the other side is shuffled to the bucket count. Give at least as many buckets as
    ``spark.sql.shuffle.partitions``, or Spark prefers to shuffle both. The data lie under the shared
    folder; the name, made unique, lives in the session's catalog."""
    spark = df.sparkSession
    unique = f"{name}_{uuid.uuid4().hex[:12]}"
    parts = df.repartition(int(buckets), *key)  # one file a bucket
    parts.write.bucketBy(int(buckets), *key).sortBy(*key).option("path", shared_path(spark, f"catalog-{name}")).saveAsTable(unique)
    return spark.table(unique)


#: Rows of the StreamRecs store; ``event_id`` may be of another type (a struct for Kafka).
RECS_SCHEMA = "uid int, recs array<struct<mid:int,score:double>>, ts long, event_id long"


class KeyedStore:
    """K4: keyed upsert of recommendation lists (StreamRecs) on Parquet.

    Every micro-batch writes its rows into a folder ``batch_id=<id>``; writing the same batch again (a
    replay after a failure) replaces that folder, so the sink is idempotent, and a folder counts once
    its write committed. The current table is the newest row per key by event time (ts, event_id, then
    batch id), so an older event that arrives late cannot replace the list of a newer one. ``compact``
    folds the batches into a snapshot and removes what it holds, so reads and listings stay
    proportional to the number of keys and of batches since. Batches and snapshots lie in buckets by a
    hash of the key: looking up some keys reads their buckets only.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "uid",
                 order: Sequence[str] = ("ts", "event_id", "batch_id"), schema: str | T.StructType = RECS_SCHEMA,
                 buckets: int = 16):
        self.spark, self.path, self.key, self.order = spark, path.rstrip("/"), key, list(order)
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.buckets = int(buckets)

    @property
    def _batches(self) -> str:
        return f"{self.path}/batches"

    def _write(self, df: DataFrame, path: str) -> None:
        name = bucket_name(self.key, self.buckets)
        rows = df.withColumn(name, bucket_of(self.key, self.buckets)).hint("rebalance", name)
        with shuffles_dropped(self.spark):
            rows.write.mode("overwrite").partitionBy(name).parquet(path)

    def _read(self, root: str, folders: list[str], part: str) -> DataFrame:
        """The rows of committed ``folders`` of ``root``, which are named ``part=<number>``."""
        schema = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])
        if part != "batch_id":
            schema = schema.add(part, T.LongType())
        schema = schema.add(bucket_name(self.key, self.buckets), T.IntegerType())
        return self.spark.read.schema(schema).option("basePath", root).parquet(*folders)

    def upsert(self, df: DataFrame, batch_id: int) -> None:
        self._write(df.select(*self.schema.names), f"{self._batches}/batch_id={int(batch_id)}")

    def _committed(self, root: str, part: str) -> list[int]:
        """Numbers of the folders ``part=<number>`` whose write committed ``_SUCCESS``, by one listing."""
        hpath, fs = _fs(self.spark, f"{root}/{part}=*/_SUCCESS")
        found = fs.globStatus(hpath) or []
        return sorted(int(f.getPath().getParent().getName().split("=", 1)[1]) for f in found)

    def _snapshots(self) -> list[int]:
        return self._committed(self.path, "snapshot")

    def current(self, upto_batch: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        """The newest row per key (over all batches, or over batches <= ``upto_batch``); with ``keys`` (a frame
        with the key column) of those keys only, read from their buckets."""
        snaps = [i for i in self._snapshots() if upto_batch is None or i < upto_batch]
        floor = snaps[-1] if snaps else None
        since = [i for i in self._committed(self._batches, "batch_id")
                 if (floor is None or i > floor) and (upto_batch is None or i <= upto_batch)]
        parts = []
        if floor is not None:
            parts.append(self._read(self.path, [f"{self.path}/snapshot={floor}"], "snapshot").drop("snapshot"))
        if since:
            parts.append(self._read(self._batches, [f"{self._batches}/batch_id={i}" for i in since], "batch_id"))
        if not parts:
            return self.spark.createDataFrame([], T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())]))
        if keys is not None:
            parts = [buckets_of(p, self.key, keys, self.key) for p in parts]
        rows = parts[0].select(*self.schema.names, "batch_id")
        for p in parts[1:]:
            rows = rows.unionByName(p.select(*rows.columns))
        if keys is not None:
            rows = rows.join(keys.select(self.key).distinct(), self.key, "left_semi")
        payload = [c for c in rows.columns if c != self.key]
        # newest row per key; max_by is a partial aggregate, a hot key is combined map-side
        newest = rows.groupBy(self.key).agg(
            F.max_by(F.struct(*payload), F.struct(*self.order)).alias("_row"))
        return newest.select(self.key, "_row.*")

    def compact(self, upto_batch: int) -> None:
        """Fold batches <= ``upto_batch`` (and the previous snapshot) into ``snapshot=<upto_batch>``.

        Idempotent: a replayed batch finds the committed snapshot and writes nothing; a snapshot
        whose write did not commit is ignored by readers and rewritten here from the previous
        snapshot, never from itself. Folded batches and all but the newest two snapshots are
        deleted only after the commit (a reader that has planned its scan on the last snapshot
        still finds it).
        """
        upto = int(upto_batch)
        if upto not in self._snapshots():
            self._write(self.current(upto_batch=upto), f"{self.path}/snapshot={upto}")
        for i in self._committed(self._batches, "batch_id"):
            if i <= upto:
                drop_table(self.spark, f"{self._batches}/batch_id={i}")
        for i in self._snapshots()[:-2]:
            drop_table(self.spark, f"{self.path}/snapshot={i}")
