"""Inputs that queries write from the tables before they read them back."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtlake.session import spread
from subtlake.sources.listing import opened

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def write_marks(names: DataFrame, root: str, folders: int | None = None) -> list[str]:
    """A file of ``size`` bytes for each ``name``, dealt to folders below ``root``; returns the folders.

    A file is heavy work for a short row, so the names are spread over all cores, and there are some folders for each core to list.
    """
    folders = folders or max(8, 2 * names.sparkSession.sparkContext.defaultParallelism)
    places = [f"{root}/{i}" for i in range(folders)]

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, _ = opened(root)
        paths = [opened(place)[1] for place in places]
        for path in paths:
            system.create_dir(path, recursive=True)
        for frame in frames:
            for name, size, place in zip(frame["name"], frame["size"], frame["place"]):
                with system.open_output_stream(f"{paths[place]}/{name}", compression=None) as out:
                    out.write(b"x" * size)
            yield pd.DataFrame({"n": [len(frame)]})

    dealt = spread(names).select("name", "size", F.pmod(F.xxhash64("name"), F.lit(folders)).cast("int").alias("place"))
    dealt.mapInPandas(write, "n long").write.format("noop").mode("overwrite").save()
    return places
