"""The registry of local archives (a small configuration file)."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_registry(spark: SparkSession, path: str) -> list[dict]:
    """Enabled providers in order, from the JSON registry."""
    config = json.loads(spark.read.text(path, wholetext=True).first()[0])
    return [p for p in config["providers"] if p.get("enabled") is not False]


def expand_provider(provider: dict, paths: list[str]) -> list[dict]:
    """One entry per shard or language table of a multi-part provider, from its table paths."""
    shape = provider["db_path_format"].rsplit("/", 1)[-1]
    out = []
    for path in sorted(paths):
        name = path.rsplit("/", 1)[-1]
        shard = re.fullmatch(r"([0-9]+)xxx(?:\.\w+)?", name)
        if "{shard_id}" in shape and shard:
            first = int(shard[1]) * provider["shard_size"]
            out.append({**provider, "id": f"{provider['id']}/shard-{int(shard[1])}", "db_path": path,
                        "num_range_from": first, "num_range_to": first + provider["shard_size"] - 1})
        elif "{lang}" in shape:
            lang = name.split(".", 1)[0]
            out.append({**provider, "id": f"{provider['id']}/lang-{lang}", "db_path": path, "lang": lang})
    return out


def open_providers(spark: SparkSession, root: str) -> DataFrame:
    """All released shards below a root as one logical table; the release folder becomes a column."""
    return spark.read.option("basePath", root).parquet(root).withColumn("file", F.col("_metadata.file_path"))
