"""Near-duplicate vectors over a robust-pruned flat graph.

Equal vectors are one node. The nodes of a label are cut into overlapping clusters until a cluster fits a task; each cluster gets a
graph, and the lists a node has in its clusters are united. Every node is then searched from the medoid of each of its clusters, on
from there by range, and each link is decided by its exact cosine. A sample of nodes is held against all nodes to measure the recall;
if that is too low, everything is done again with more overlap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtlake.llm import graph
from subtlake.llm.common import components, stored
from subtlake.llm.tokens import bounded_batches

_VECTOR = "array<double>"


def usable(vector: Column) -> Column:
    """Not null, without null, NaN or infinite components, not empty, not zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _nodes(rows: DataFrame) -> DataFrame:
    """``node``, ``label``, ``vector``, ``copies``, ``low`` (smallest id), ``x`` (of length 1), ``home``: one row for equal vectors of a label."""
    some = rows.groupBy("label", "vector").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("low"))

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column("vector"):
                v = v.values.to_numpy()
                v = v / np.abs(v).max()
                out.append(v / np.sqrt(v @ v))
            yield batch.append_column("x", pa.array(out, pa.list_(pa.float64())))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in some.schema) + f", x {_VECTOR}"
    home = F.concat_ws("/", F.col("label").cast("string"), F.size("vector").cast("string"))
    return stored(some.mapInArrow(unit, schema).withColumns({"node": F.monotonically_increasing_id(), "home": home}), "nodes")


def _shards(nodes: DataFrame, size: int, overlap: int, margin: float, sampled: int, fan: int, rounds: int) -> DataFrame:
    """``node``, ``shard``, ``n`` (nodes of the shard), ``x``: clusters of at most ``size`` nodes, but for those that are one lump.

    A cluster that is too large is cut by centres from a sample of its nodes that are unlike each other. A node goes to its nearest
    centre and to further ones, ``overlap`` in all, that are nearly as near. A lump has few such centres and stays whole.
    """
    members, done = nodes.select("node", F.col("home").alias("shard"), "x"), []
    for number in range(rounds + 1):
        sizes = stored(members.groupBy("shard").agg(F.count(F.lit(1)).alias("n")), "sizes")
        members = members.join(sizes, "shard")
        if number == rounds or sizes.where(F.col("n") > size).isEmpty():
            done.append(members)
            break
        picked = members.where((F.col("n") > size) & (F.pmod(F.xxhash64("node", F.lit(number)), F.expr("n")) < sampled))

        def choose(key: tuple, table: pa.Table) -> pa.Table:
            x = _matrix(table.sort_by("node").column("x"))
            wanted = int(min(fan, max(8, -(-4 * table.column("n")[0].as_py() // size))))
            chosen = [0]
            for i in range(1, len(x)):
                if len(chosen) == wanted:
                    break
                if (x[chosen] @ x[i]).max() < 0.8:
                    chosen.append(i)
            if len(chosen) < max(4, 2 * overlap):
                chosen = []  # one lump
            return pa.table({"shard": pa.array([key[0].as_py()], pa.string()), "centres": pa.array([x[chosen].ravel()], pa.list_(pa.float64())),
                             "chosen": pa.array([len(chosen)], pa.int32()), "n": table.column("n").slice(0, 1)})

        centres = stored(picked.groupBy("shard").applyInArrow(choose, f"shard string, centres {_VECTOR}, chosen int, n long").where("chosen > 0"), "centres")
        members = stored(members, "members")
        done.append(members.join(centres.select("shard"), "shard", "left_anti"))
        # a large cluster is dealt to several tasks, each with its centres
        parts = F.ceil(F.expr("n") / F.lit(4 * size)).cast("int")
        cut = members.join(centres.select("shard"), "shard", "left_semi").withColumn("salt", F.pmod(F.xxhash64("node"), parts).cast("int"))
        salted = centres.withColumn("salt", F.explode(F.sequence(F.lit(0), parts - 1)))

        def assign(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            if not len(left) or not len(right):
                return pa.table({"node": pa.array([], pa.int64()), "shard": pa.array([], pa.string()), "x": pa.array([], pa.list_(pa.float64()))})
            x = _matrix(left.column("x"))
            near = x @ np.array(right.column("centres")[0].as_py()).reshape(-1, x.shape[1]).T
            order = np.argsort(-near, axis=1, kind="stable")[:, :overlap]
            best = np.take_along_axis(near, order, 1)
            row, place = np.nonzero(best >= best[:, :1] - margin)
            shard = [f"{key[0].as_py()}/{c}" for c in order[row, place].tolist()]
            return pa.table({"node": left.column("node").take(pa.array(row)), "shard": pa.array(shard, pa.string()), "x": left.column("x").take(pa.array(row))})

        members = stored(cut.groupBy("shard", "salt").cogroup(salted.groupBy("shard", "salt")).applyInArrow(assign, f"node long, shard string, x {_VECTOR}"), "shards")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("node", "shard", "n", "x")


def _links(nodes: DataFrame, least: float, size: int, overlap: int, margin: float, degree: int, beam: int, alpha: float, slack: float, sampled: int,
           fan: int, rounds: int) -> DataFrame:
    """``node``, ``links`` (rows of other nodes it is linked with), ``root`` (a node it is linked with by a chain): one row or more per node with links."""
    members = _shards(nodes, size, overlap, margin, sampled, fan, rounds)
    # a lump is dealt into parts; each two parts meet in a task
    parts = F.when(F.col("n") > size, F.ceil(F.col("n") * 2 / size)).otherwise(1).cast("int")
    members = stored(members.select("node", "shard", "x", parts.alias("parts"), F.pmod(F.xxhash64("node"), parts).cast("int").alias("part")), "members")

    def make(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        offsets, near = graph.both_ways(graph.build(_matrix(table.column("x")), degree, beam, alpha))
        ids = table.column("node").to_numpy()
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids[near]))
        return pa.table({"node": ids, "near": lists})

    lists = members.groupBy("shard", "part").applyInArrow(make, "node long, near array<long>")
    united = lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    homes = members.groupBy("node").agg(F.collect_set("shard").alias("shards"))
    known = stored(united.join(homes, "node").join(nodes.select("node", "copies"), "node"), "graph")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = members.withColumn("other", other).select("node", "shard", "x", "part", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"))
    dealt = dealt.join(known, "node")

    def search(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        shard, a, b = (k.as_py() for k in key)
        part = table.column("part").to_numpy()
        ask, held = np.flatnonzero(part == a), np.flatnonzero(part == b)
        if not len(ask) or not len(held):
            return pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        x, ids, copies = _matrix(table.column("x")), table.column("node").to_numpy(), table.column("copies").to_numpy()
        # the united lists, as far as they lie in this shard
        lists = table.column("near").take(pa.array(held)).combine_chunks()
        of = np.repeat(np.arange(len(held)), np.asarray(lists.value_lengths()))
        to = lists.flatten().to_numpy()
        place = np.minimum(np.searchsorted(ids[held], to), len(held) - 1)
        ok = ids[held][place] == to
        of, place = of[ok], place[ok]
        at = np.arange(len(of)) - np.searchsorted(of, of)
        near = np.full((len(held), int(at.max(initial=0)) + 1), -1)
        near[of, at] = place
        walk = graph.Walk(x[held], near, x[ask], graph.medoid(x[held]), beam)
        walk.expand(least - slack)
        rows, found, sims = walk.found()
        hit = sims >= least
        met = np.zeros((len(ids), len(ids)), bool)
        met[ask[rows[hit]], held[found[hit]]] = True
        met |= met.T
        np.fill_diagonal(met, False)
        # two nodes that meet in an earlier shard, too, count there
        shards = table.column("shards").to_pylist()
        earlier = sorted({s for some in shards for s in some if s < shard})
        if earlier and met.any():
            which = {s: i for i, s in enumerate(earlier)}
            inside = np.zeros((len(ids), len(earlier)), np.float32)
            for i, some in enumerate(shards):
                inside[i, [which[s] for s in some if s in which]] = 1
            counted = met & (inside @ inside.T == 0)
        else:
            counted = met
        links = counted @ copies
        root = np.arange(len(ids))
        while True:
            low = np.minimum(root, np.where(met, root[None, :], len(ids)).min(axis=1))
            low = low[low]
            if (low == root).all():
                break
            root = low
        some = np.flatnonzero(met.any(axis=1))
        return pa.table({"node": ids[some], "links": links[some].astype(np.int64), "root": ids[root[some]]})

    return stored(dealt.groupBy("shard", "a", "b").applyInArrow(search, "node long, links long, root long"), "links")


def audit(nodes: DataFrame, links: DataFrame, least: float, audited: int) -> tuple[int, int]:
    """(links found, links there are) of the ``audited`` nodes with the smallest hashes, which are held against all nodes."""
    some = nodes.orderBy(F.xxhash64("x"), "node").select("node", "home", "x").limit(audited).toArrow()
    asked: dict[str, tuple[list, list]] = {}
    for node, home, x in zip(some["node"].to_pylist(), some["home"].to_pylist(), some["x"].to_pylist()):
        own = asked.setdefault(home, ([], []))
        own[0].append(node)
        own[1].append(x)
    asked = {home: (np.array(a), np.array(x)) for home, (a, x) in asked.items()}
    sent = nodes.sparkSession.sparkContext.broadcast(asked)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            homes = batch.column("home").to_pylist()
            for home in set(homes) & set(sent.value):
                ids, x = sent.value[home]
                own = batch.filter(pa.array([h == home for h in homes]))
                hit = x @ _matrix(own.column("x")).T >= least
                hit &= ids[:, None] != own.column("node").to_numpy()[None, :]
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(hit @ own.column("copies").to_numpy())], ["node", "links"])

    true = nodes.select("node", "home", "x", "copies").mapInArrow(count, "node long, links long")
    true = true.groupBy("node").agg(F.sum("links").alias("all_links")).where("all_links > 0")
    got = links.groupBy("node").agg(F.sum("links").alias("found"))
    r = true.join(got, "node", "left").agg(F.sum(F.coalesce("found", F.lit(0))).alias("f"), F.sum("all_links").alias("t")).first()
    return r["f"] or 0, r["t"] or 0


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.93, size: int = 512,
                 overlap: int = 2, margin: float = 0.1, degree: int = 16, beam: int = 24, alpha: float = 1.2, slack: float = 0.1, sampled: int = 256,
                 fan: int = 64, rounds: int = 8, audited: int = 1024, recall: float = 0.97) -> DataFrame:
    """``key``, ``n_links`` (other rows linked directly), ``component_id`` (smallest key reachable), ``kept`` (the key is that): a row per row.

    Rows of equal, non-null label link at a cosine of ``least`` or more, in double precision; every link given has it, and of all links
    a few may be missed: the share found is measured on ``audited`` nodes against all nodes, and below ``recall`` the overlap is
    doubled, in the end with clusters that are not cut at all. Vectors that are null, empty, zero or hold a null or non-finite
    component link with nothing, nor do vectors of different length. Equal vectors always link. Rows that repeat a key are rows of
    their own; a null key is never the smallest if there is another. No rows give no rows. Other columns are not read.
    """
    bounded_batches(vectors.sparkSession)
    rows = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).cast(_VECTOR).alias("vector"))
    nodes = _nodes(rows.where(F.col("label").isNotNull() & usable(F.col("vector"))))
    while True:
        links = _links(nodes, least, size, overlap, margin, degree, beam, alpha, slack, sampled, fan, rounds)
        found, true = audit(nodes, links, least, audited)
        if found >= recall * true or not rounds:
            break
        overlap, margin, beam, rounds = 2 * overlap, 2 * margin, 2 * beam, rounds if overlap < 8 else 0
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    chains = components(links.select("node", "root"), "node", "root")
    named = nodes.select("node", "label", "vector", "copies", "low").join(counts, "node", "left").join(chains, "node", "left")
    named = stored(named.withColumn("component", F.coalesce("component", "node")), "named")
    lowest = named.groupBy("component").agg(F.min("low").alias("lowest"))
    named = named.join(lowest, "component").select("label", "vector", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), "lowest")
    out = rows.join(stored(named, "results"), ["label", "vector"], "left")
    lowest = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("lowest"))
    return out.select(F.col("id").alias(key), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), lowest.alias("component_id"),
                      F.col("id").eqNullSafe(lowest).alias("kept"))
