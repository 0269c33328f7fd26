"""Table, export and snapshot writers."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subtlake.fixed_values import RELEASE_SIZE, SHARD_SIZE
from subtlake.functions.ids import bucket_of
from subtlake.operators.languages import with_languages
from subtlake.operators.recon import release_semi


def write_quarantine(rejected: DataFrame, path: str) -> None:
    """Rejected rows by reason."""
    rejected.write.mode("append").partitionBy("reason").parquet(path)


def export_id_time(meta: DataFrame, num: str, epoch: str, path: str, bucket: int = RELEASE_SIZE) -> None:
    """JSON lines ``[id, epoch]`` in id order, one folder per id bucket.

    Rows are range-partitioned by id, so that a bucket's lines lie in few, ordered files.
    """
    rows = meta.select(
        bucket_of(F.col(num), bucket).alias("bucket"), F.col(num).cast("long").alias("n"),
        F.to_json(F.array(F.col(num).cast("long"), F.col(epoch).cast("long"))).alias("value"),
    )
    ordered = rows.repartitionByRange("bucket", "n").sortWithinPartitions("bucket", "n")
    ordered.select("bucket", "value").write.mode("overwrite").partitionBy("bucket").text(path)


def export_schema(df: DataFrame, derivations: dict[str, str] | None = None) -> str:
    """JSON sidecar: name, type and derivation of each column."""
    return json.dumps(
        [{"name": f.name, "type": f.dataType.simpleString(), "sql": (derivations or {}).get(f.name, f.name)}
         for f in df.schema.fields]
    )


def split_by_lang(blobs: DataFrame, meta: DataFrame, path: str) -> None:
    """One folder per three-letter language; the metadata's language counts, none is ``und``.

    Rows are brought together by language in parts of even size: a language with most rows has as many writers as
    its size asks for. ``invalid_languages`` tells codes that are none.
    """
    coded = with_languages(meta.select("num", "ISO639"), "ISO639").select("num", F.col("lang3").alias("lang"))
    rows = blobs.join(coded, "num", "left").withColumn("lang", F.coalesce("lang", F.lit("und")))
    rows.hint("rebalance", "lang").write.mode("overwrite").partitionBy("lang").parquet(path)


def read_language(spark: SparkSession, path: str, lang: str) -> DataFrame:
    """One language of a split table; only its folder is read."""
    return spark.read.option("basePath", path).parquet(path).where(F.col("lang") == lang)


def write_shards(blobs: DataFrame, complete: DataFrame, path: str, existing: DataFrame | None = None,
                 shard_size: int = SHARD_SIZE, release_size: int = RELEASE_SIZE) -> None:
    """Append the blobs of complete shards that are not there yet; one folder per release.

    A task writes a run of whole shards in id order, so files stay large and a read of one shard skips the rest
    by its row-group bounds; a folder per shard would be millions of small files. The commit of the file output
    makes a shard appear whole.
    """
    todo = complete.select(F.col("shard").alias("shard_id"))
    if existing is not None:
        todo = todo.join(existing.select("shard_id"), "shard_id", "left_anti")
    rows = blobs.withColumn("shard_id", bucket_of(F.col("num"), shard_size)).join(todo, "shard_id", "left_semi")
    placed = rows.withColumn("release_id", bucket_of(F.col("num"), release_size))
    ordered = placed.repartitionByRange("release_id", "shard_id").sortWithinPartitions("release_id", "shard_id", "num")
    ordered.write.mode("append").partitionBy("release_id").parquet(path)


def write_release(shards: DataFrame, releases: DataFrame, meta: DataFrame, path: str) -> None:
    """Union of the shards of complete releases, restricted to ids the metadata still lists.

    ``release_id`` is a sorted column: a read of one release skips the rest by its row-group bounds. The number of files follows the
    size of the rows, not the number of releases.
    """
    rows = shards.join(releases.select("release_id"), "release_id", "left_semi")
    kept = release_semi(rows, meta)
    ordered = kept.repartitionByRange("release_id", "num").sortWithinPartitions("release_id", "num")
    ordered.write.mode("append").parquet(path)


def write_id_lists(flags: DataFrame, path: str) -> None:
    """Sorted id lists per state, one folder each: not_found, takedown."""
    states = F.array(*[F.when(F.col(s), F.lit(s)) for s in ("not_found", "takedown")])
    rows = flags.select("num", F.explode(F.array_compact(states)).alias("state"))
    ordered = rows.repartitionByRange("state", "num").sortWithinPartitions("state", "num")
    ordered.select("state", F.col("num").cast("string").alias("value")).write.mode("overwrite").partitionBy(
        "state"
    ).text(path)


def append_candidates(samples: DataFrame, path: str, out: str) -> None:
    """Merge new ad samples with the table at ``path`` into a new table ``out``, each row once."""
    old = samples.sparkSession.read.schema(samples.schema).parquet(path)
    old.unionByName(samples).distinct().write.mode("overwrite").parquet(out)


def snapshot_is_due(spark: SparkSession, root: str, now: datetime, max_age: timedelta = timedelta(days=10)) -> bool:
    """True when there is no snapshot or the newest is older than ``max_age``."""
    newest = latest_snapshot(spark, root)
    return newest is None or now - datetime.strptime(newest, "%Y%m%dT%H%M%S") > max_age


def latest_snapshot(spark: SparkSession, root: str) -> str | None:
    """Name of the newest published snapshot, from the pointer table."""
    try:
        return spark.read.schema("snapshot string").json(f"{root}/pointer").agg(F.max("snapshot")).first()[0]
    except Exception as error:  # no pointer table yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None


def publish_snapshot(df: DataFrame, root: str, now: datetime) -> str:
    """Write a new version beside the old ones, then point readers to it; old versions stay readable."""
    name = now.strftime("%Y%m%dT%H%M%S")
    df.write.mode("errorifexists").parquet(f"{root}/snapshot={name}")
    pointer = df.sparkSession.createDataFrame([(name,)], "snapshot string")
    pointer.write.mode("append").json(f"{root}/pointer")
    return name


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/snapshot={latest_snapshot(spark, root)}")
