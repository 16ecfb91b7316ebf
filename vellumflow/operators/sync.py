"""Keeping an embedded table in step with its source table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow.operators.embed import EmbedderFactory, embed
from vellumflow.session import few, settled, stored


def _signed(table: DataFrame, key: str, columns: list[str]) -> DataFrame:
    return table.select(F.col(key), F.md5(F.to_json(F.struct(*columns)).cast("binary")).alias("_sig"))


def change_set(old: DataFrame, new: DataFrame, key: str = "id", columns: list[str] | None = None) -> DataFrame:
    """``(key, change)`` with change one of insert, update, delete.

    Only the key and a digest of each row are shuffled, never the row itself.
    """
    compared = columns or [c for c in new.columns if c != key]
    before = _signed(old, key, compared).withColumnRenamed("_sig", "_before")
    after = _signed(new, key, compared).withColumnRenamed("_sig", "_after")
    change = (
        F.when(F.col("_before").isNull(), F.lit("insert"))
        .when(F.col("_after").isNull(), F.lit("delete"))
        .when(~F.col("_before").eqNullSafe(F.col("_after")), F.lit("update"))
    )
    return before.join(after, key, "full_outer").select(key, change.alias("change")).where("change is not null")


def changed_rows(new: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """The rows of ``new`` to insert or update."""
    return new.join(changes.where(F.col("change") != "delete").select(key), key, "left_semi")


def upsert(old: DataFrame, changes: DataFrame, rows: DataFrame, key: str = "id") -> DataFrame:
    """``old`` without what changed, and ``rows`` in its place."""
    return old.join(changes.select(key), key, "left_anti").unionByName(rows)


# --- versions of a table in one folder --------------------------------------------------

# Rows lie in so many buckets by a hash of their key. A change rewrites the buckets it touches; a
# small manifest for each version says in which version's folder each bucket was last written.
BUCKETS = 64


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _listed(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    path, fs = _path(spark, folder)
    if not fs.exists(path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(path)]
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix) and n.removeprefix(prefix).isdigit())


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Complete versions of the table below ``folder``, oldest first."""
    found = _listed(spark, folder, "manifest=")
    return [n for n in found if _path(spark, folder)[1].exists(_path(spark, f"{folder}/manifest={n}/_SUCCESS")[0])]


def table_exists(spark: SparkSession, folder: str) -> bool:
    return bool(versions(spark, folder))


def _live(spark: SparkSession, folder: str, version: int) -> tuple[int, dict[int, int]]:
    """Number of buckets, and the version each bucket was last written in. As many rows as buckets."""
    rows = spark.read.parquet(f"{folder}/manifest={version}").collect()
    return rows[0]["buckets"], {r["bucket"]: r["written"] for r in rows if r["bucket"] is not None}


def _read(spark: SparkSession, folder: str, version: int, live: dict[int, int]) -> DataFrame:
    if not live:
        schema = spark.read.parquet(f"{folder}/schema").schema
        return spark.createDataFrame([], schema)
    schema = spark.read.parquet(f"{folder}/schema").schema
    return spark.read.schema(schema).parquet(*(f"{folder}/version={v}/bucket={b}" for b, v in sorted(live.items())))


def read_latest(spark: SparkSession, folder: str, buckets: list[int] | None = None) -> DataFrame:
    """The table as it is, or only some of its buckets."""
    version = versions(spark, folder)[-1]
    live = _live(spark, folder, version)[1]
    return _read(spark, folder, version, live if buckets is None else {b: v for b, v in live.items() if b in buckets})


def _bucket(key: str, n: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(n)).cast("int")


def touched(spark: SparkSession, folder: str, keys: DataFrame, key: str = "id") -> list[int]:
    """Buckets of the table in which these keys lie: at most as many numbers as buckets."""
    n = _live(spark, folder, versions(spark, folder)[-1])[0]
    return [r[0] for r in keys.select(_bucket(key, n)).distinct().collect()]


def _commit(table: DataFrame, folder: str, key: str, n: int, kept: dict[int, int]) -> None:
    """Write rows to buckets of a new version, and the manifest last: readers see it once it is complete."""
    spark = table.sparkSession
    done = versions(spark, folder)
    number = done[-1] + 1 if done else 1
    if not done:
        table.limit(0).write.mode("overwrite").parquet(f"{folder}/schema")
    dealt = table.withColumn("bucket", _bucket(key, n)).repartition("bucket")
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/version={number}")
    live = kept | {b: number for b in _listed(spark, f"{folder}/version={number}", "bucket=")}
    rows = [(n, b, v) for b, v in sorted(live.items())] or [(n, None, None)]
    manifest = spark.createDataFrame(rows, "buckets int, bucket int, written int")
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest={number}")


def write_version(table: DataFrame, folder: str, key: str = "id", buckets: int = BUCKETS) -> None:
    """Write the whole table anew; older versions stay readable."""
    _commit(table, folder, key, buckets, {})


def apply_changes(spark: SparkSession, folder: str, changes: DataFrame, rows: DataFrame, key: str = "id") -> None:
    """A version with ``changes`` applied: only the buckets they touch are read and written again."""
    n, live = _live(spark, folder, versions(spark, folder)[-1])
    mine = set(touched(spark, folder, changes, key))
    old = read_latest(spark, folder, list(mine))
    _commit(upsert(old, changes, rows, key), folder, key, n, {b: v for b, v in live.items() if b not in mine})


def forget_versions(spark: SparkSession, folder: str, keep: int = 2) -> list[int]:
    """Delete manifests of all but the last ``keep`` versions, and folders that no manifest left names."""
    done = versions(spark, folder)
    stay, go = done[-keep:], done[:-keep]
    named = {v for n in stay for v in _live(spark, folder, n)[1].values()} | set(stay)
    for kind, numbers in (("manifest", go), ("version", [n for n in _listed(spark, folder, "version=") if n not in named and n <= done[-1]])):
        for n in numbers:
            path, fs = _path(spark, f"{folder}/{kind}={n}")
            fs.delete(path, True)
    return go


def sync(chunks: DataFrame, folder: str, embedder: EmbedderFactory, columns: list[str], key: str = "id") -> DataFrame:
    """Bring the embedded table in step: only new and changed rows are embedded, only their buckets rewritten.

    The source is stored once for the call: a lazy one with model calls in its
    plan would else be asked twice, and could answer differently. A first call
    embeds everything. Returns the table as it now is.
    """
    spark = chunks.sparkSession
    wanted = stored(chunks.select(*columns), "wanted")
    if not table_exists(spark, folder):
        write_version(embed(wanted, embedder), folder, key)
        return read_latest(spark, folder)
    old = read_latest(spark, folder)
    changes = few(settled(change_set(old, wanted, key, [c for c in columns if c != key])))
    if not changes.isEmpty():
        apply_changes(spark, folder, changes, embed(changed_rows(wanted, changes, key), embedder), key)
    return read_latest(spark, folder)
