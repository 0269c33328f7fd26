"""A Merkle manifest of a table: a digest per row, a root per group, one root over all groups, and proofs.

Leaves of a group stand in key order. Aligned blocks of 512 nodes keep each of their levels as one string of 64 hex digits a node:
fixed-width substrings of 8 nodes are hashed into the next level, and the substrings on both sides of a node are its siblings. What
a block ends in is a node of the next round of blocks, until each group has one node; the groups' roots are the leaves of a last tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtlake.llm.common import stored
from subtlake.operators.numbering import number_rows

FAN = 8
LEVELS = 3  # of a block
BLOCK = FAN ** LEVELS
WIDTH = 64  # hex digits of a digest


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts joined."""
    return F.sha2(F.concat(*[p.cast("binary") for p in parts]), 256)


def field(value: Column) -> Column:
    """A value as it goes into a leaf: ``-`` if null, else its bytes' number, a colon and itself."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _part(level: str, first: Column, nodes: Column) -> Column:
    """``nodes`` nodes from number ``first`` (from 0) of a level; those beyond its end are left out."""
    return F.substring(F.col(level), (first * WIDTH + 1).cast("int"), (nodes * WIDTH).cast("int"))


def _levels(nodes: DataFrame) -> DataFrame:
    """Blocks of ``nodes`` (g, at, of, hash, load): g, block, of, depth, loads, the levels s0 to s3, top."""
    block = F.floor(F.col("at") / BLOCK).cast("long").alias("block")
    rows = nodes.groupBy("g", block).agg(F.max("of").alias("of"), F.array_sort(F.collect_list(F.struct("at", "hash", "load"))).alias("nodes"))
    depth = sum((F.when(F.col("of") > FAN ** i, 1).otherwise(0) for i in range(LEVELS)), F.lit(0))
    rows = rows.select("g", "block", "of", depth.alias("depth"), F.transform("nodes", lambda x: x["load"]).alias("loads"),
                       F.array_join(F.transform("nodes", lambda x: x["hash"]), "").cast("binary").alias("s0"))
    for i in range(LEVELS):
        runs = F.sequence(F.lit(0), F.floor((F.octet_length(f"s{i}") - 1) / (FAN * WIDTH)).cast("int"))
        level = f"s{i}"
        above = F.array_join(F.transform(runs, lambda r: F.sha2(_part(level, r * FAN, F.lit(FAN)), 256)), "")
        rows = rows.withColumn(f"s{i + 1}", F.when(F.col("depth") > i, above.cast("binary")))
    return rows.withColumn("top", F.coalesce(*[F.col(f"s{i}") for i in reversed(range(LEVELS + 1))]).cast("string"))


def _rounds(nodes: DataFrame, most: int) -> list[DataFrame]:
    """Blocks over ``nodes``, blocks over their tops and so on until every group has one; no group has over ``most`` nodes."""
    rounds = []
    while True:
        rounds.append(stored(_levels(nodes), "blocks"))
        if most <= BLOCK:
            return rounds
        most = -(-most // BLOCK)
        nodes = rounds[-1].select("g", F.col("block").alias("at"), F.ceil(F.col("of") / BLOCK).alias("of"), F.col("top").alias("hash"), F.lit(0).alias("load"))


def _paths(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """Each node of the first round with its ``path``: the siblings (``l``, ``r``) of each level up to the group's root, and on by the
    group's own ``path`` in ``above`` (g, path, and columns that are handed down)."""
    given = [c for c in above.columns if c not in ("g", "path")]
    path = above.withColumn("block", F.lit(0).cast("long"))
    for number, level in reversed(list(enumerate(rounds))):
        def siblings(at: Column) -> Column:
            out = []
            for i in range(LEVELS):
                own = F.shiftright(at, 3 * i)
                first = F.shiftleft(F.shiftright(own, 3), 3)
                out.append(F.struct(_part(f"s{i}", first, own - first).cast("string").alias("l"),
                                    _part(f"s{i}", own + 1, first + (FAN - 1) - own).cast("string").alias("r")))
            return F.concat(F.slice(F.array(*out), F.lit(1), F.col("depth")), F.col("path"))

        places = F.sequence(F.lit(0), F.size("loads") - 1)
        each = F.transform(places, lambda at: F.struct((F.col("block") * BLOCK + at).alias("at"), F.get("loads", at).alias("load"),
                                                       _part("s0", at, F.lit(1)).cast("string").alias("hash"), siblings(at).alias("path")))
        path = level.join(path, ["g", "block"]).select("g", *given, F.inline(each))
        if number:
            path = path.select("g", *given, F.col("at").alias("block"), "path")
    return path


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "lang", columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
             tampered: dict[str, Column] | None = None) -> DataFrame:
    """``key``, ``leaf``, ``subroot`` (of the group), ``root``, ``proof`` (siblings from leaf to root, joined), ``folded_root``, ``verified``.

    A leaf is the digest of the ``columns``, each as ``field``. ``tampered`` names columns with other values (null: as they are); the
    folded root is what the leaf of those values and the original siblings give, and a row is verified if that is the root.

    Rows ascend by key within the group (null keys first, equal keys by leaf); a null group is a group and stands first. A level with
    several nodes is hashed by runs of 8, the last run may be shorter; a group of one row has that row's leaf as its root. No rows
    give no rows. Other columns of ``docs`` are not read.
    """
    def leaf(values: dict[str, Column]) -> Column:
        return digest(*[field(values.get(c, F.col(c))) for c in columns])

    changed = F.lit(None).cast("string")
    if tampered:
        changed = F.when(F.coalesce(*[value.isNotNull() for value in tampered.values()], F.lit(False)),
                         leaf({c: F.coalesce(value, F.col(c)) for c, value in tampered.items()}))
    rows = docs.select(F.struct(F.col(group).alias("k")).alias("g"), F.col(key).alias("id"), leaf({}).alias("hash"), changed.alias("changed"))
    rows = stored(rows, "leaves")
    sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("of"))
    most = sizes.agg(F.max("of")).first()[0] or 0
    numbered = number_rows(rows, ["g"], [F.col("id"), F.col("hash")], "n").join(sizes, "g")
    nodes = numbered.select("g", (F.col("n") - 1).alias("at"), "of", "hash", F.struct("id", "changed").alias("load"))
    rounds = _rounds(nodes, most)
    # the tree over the groups: its leaves are their roots
    roots = stored(rounds[-1].select("g", F.col("top").alias("hash")), "roots")
    groups = roots.count()
    tops = number_rows(roots, [], [F.col("g")], "n", buckets=8).select(
        F.lit(0).alias("g"), (F.col("n") - 1).alias("at"), F.lit(groups).cast("long").alias("of"), "hash", F.struct(F.col("g").alias("group")).alias("load"))
    top = _rounds(tops, groups)
    start = top[-1].select("g", F.col("top").alias("root"), F.array().cast("array<struct<l:string,r:string>>").alias("path"))
    above = _paths(top, start).select(F.col("load.group").alias("g"), "root", F.col("hash").alias("subroot"), "path")
    found = _paths(rounds, stored(above, "paths"))
    folded = F.aggregate("path", F.coalesce("load.changed", "hash"), lambda node, s: digest(s["l"], node, s["r"]))
    proof = F.array_join(F.transform("path", lambda s: F.concat(s["l"], s["r"])), "")
    found = found.select(F.col("load.id").alias(key), F.col("hash").alias("leaf"), "subroot", "root", proof.alias("proof"), folded.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
