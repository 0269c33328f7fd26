"""Title search over a token table, routing of ids to archives, and the batch lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from subtlake.functions.ids import pad_num
from subtlake.functions.names import extension, fix_download_extension, render_path
from subtlake.functions.text import fts_tokens
from subtlake.operators.archive import first_members
from subtlake.operators.languages import three_letter, two_letter
from subtlake.operators.skew import salted_join
from subtlake.session import checkpointed, stored


def write_token_table(tokens: DataFrame, path: str) -> None:
    """The token table by field and in the order of tokens, so that a search for some words skips most row groups."""
    tokens.repartitionByRange("field", "token", "num").sortWithinPartitions("field", "token").write.partitionBy("field").parquet(path)


def read_tokens(spark: SparkSession, path: str, field: str, num: str) -> DataFrame:
    """(token, id) of one field."""
    return spark.read.parquet(path).where(F.col("field") == field).select("token", F.col("num").alias(num))


def token_table(titles: DataFrame, num: str, fields: list[str]) -> DataFrame:
    """(field, token, num): each word of each field once per id."""
    per_field = F.array(*[
        F.struct(F.lit(f).alias("field"), F.array_distinct(fts_tokens(F.col(f))).alias("tokens")) for f in fields
    ])
    rows = titles.select(num, F.explode(per_field).alias("f"))
    return rows.select(F.col("f.field").alias("field"), F.explode("f.tokens").alias("token"), F.col(num).alias("num"))


def _word_sets(queries: DataFrame, text: str) -> DataFrame:
    """Queries with their words as a sorted set (``asked``); queries without a word can have no hit."""
    words = F.array_sort(F.array_distinct(fts_tokens(F.col(text))))
    return queries.withColumn("asked", words).where(F.size("asked") > 0)


def _set_hits(titles: DataFrame, num: str, title: str, asked: DataFrame, keep: list[str], tokens: DataFrame | None) -> DataFrame:
    """(asked, num, keep…, words) of titles that hold all words of a set. Equal sets are searched once.

    ``tokens`` is the written token table of this title (token, num); without it the titles are cut into words here. Only
    words that are asked for are taken from it, and only the rarest word of a set is joined, so frequent words (in a
    third of all titles) stay out of the join; the other words are tested on the title. Rows of a word that is in very
    many titles and still the rarest of a set are spread by the counts at hand.
    """
    if tokens is None:
        tokens = titles.select(num, F.explode(F.array_distinct(fts_tokens(F.col(title)))).alias("token"))
    sets = asked.select("asked").distinct()
    each = sets.select("asked", F.explode("asked").alias("token"))
    near = tokens.select("token", num).join(each.select("token").distinct(), "token", "left_semi")
    frequency = near.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = (
        each.join(frequency, "token", "left").groupBy("asked")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("f"), F.col("token").alias("t"))).alias("r"))
        .select("asked", F.col("r.t").alias("token"))
    )
    found = salted_join(near, rarest, "token", counts=frequency).select("asked", num)
    rows = titles.select(num, *keep, fts_tokens(F.col(title)).alias("words"))
    return found.join(rows, num).where(F.size(F.array_except("asked", "words")) == 0)


def fts_and(titles: DataFrame, num: str, title: str, queries: DataFrame, text: str = "title",
            tokens: DataFrame | None = None) -> DataFrame:
    """Titles that hold every word of a query, in any order. ``queries`` has ``query_id``."""
    asked = _word_sets(queries, text)
    return _set_hits(titles, num, title, asked, [], tokens).join(asked, "asked").drop("asked", "words")


def limit_per_query(hits: DataFrame, num: str, n: int = 500) -> DataFrame:
    """The lowest ``n`` ids of each query (the lookup's guard); the limit is applied before the shuffle too."""
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(num))
    return hits.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def route_to_provider(ids: DataFrame, providers: list[dict], num: str = "num", lang: str | None = None) -> DataFrame:
    """Adds ``provider``: the first provider whose id range and language cover the row; null when none does.

    ``providers`` are in order of preference, disabled ones left out; a range end that is missing or 0 makes
    the range open. The ends of all ranges cut the ids into segments, at most two more per provider. A row
    finds its segment by them, and the providers of the segment by a join with that table, which is as small
    as the registry. A null id has no provider.
    """
    entries = []
    for i, p in enumerate(providers):
        low, high = int(p.get("num_range_from") or 0), int(p.get("num_range_to") or 0)
        if p.get("enabled") is not False:
            entries.append((i, p["id"], p.get("lang", "*"), *((low, high) if low and high else (None, None))))
    cuts = sorted({low for *_, low, _ in entries if low is not None} | {high + 1 for *_, high in entries if high is not None})
    covers = lambda e, at: e[3] is None or (at is not None and e[3] <= at <= e[4])
    segments = [
        (i, [(e[0], e[1], e[2]) for e in entries if covers(e, cuts[i - 1] if i else None)]) for i in range(len(cuts) + 1)
    ]
    table = ids.sparkSession.createDataFrame(segments, "_segment int, _near array<struct<ord:int,id:string,lang:string>>")
    below = F.filter(F.lit(cuts), lambda c: c <= F.col(num)) if cuts else F.array()
    rows = ids.withColumn("_segment", F.when(F.col(num).isNotNull(), F.size(below)))
    near = F.col("_near") if lang is None else F.filter("_near", lambda p: (p["lang"] == "*") | (p["lang"] == F.col(lang)))
    joined = rows.join(F.broadcast(table), "_segment", "left")
    return joined.withColumn("provider", F.array_min(near)["id"]).drop("_segment", "_near")


def fetch_content(hits: DataFrame, blobs: DataFrame, num: str = "num") -> DataFrame:
    """Archive bytes of the hit ids, by join; many queries may hit one archive."""
    return salted_join(hits, blobs, num)


def lookup_hits(meta: DataFrame, queries: DataFrame, limit: int | None = None, tokens: DataFrame | None = None) -> DataFrame:
    """Hits of a table of queries (query_id, type, title, year, season, episode, langs array).

    Movies match on words, language and the year where the query has one; episodes on words, season,
    episode and language. Only single-part rows of the query's kind count. ``limit`` keeps that many per query:
    hits are cut to as many per word set, language and wish before they meet the queries, so a title that many ask
    for is not multiplied by all its rows. ``tokens`` is the written token table of the titles (token, IDSubtitle).
    """
    single = meta.where(F.col("SubSumCD") == 1)
    fields = ["MovieYear", "ISO639", "MovieKind", "SeriesSeason", "SeriesEpisode"]
    asked = _word_sets(queries, "title")
    hits = _set_hits(single, "IDSubtitle", "MovieName", asked, fields, tokens)
    # what a row can be asked for and what a query asks for, as one key each: an equi-join, no filter after it
    movie = F.array(F.lit("movie"), F.concat_ws(":", F.lit("movie"), "MovieYear"))
    episode = F.array(F.concat_ws(":", F.lit("episode"), "SeriesSeason", "SeriesEpisode"))
    offers = F.when(F.col("MovieKind") == "movie", movie).when(F.col("MovieKind") == "tv", episode)
    wants = F.when(F.col("type") == "movie", F.concat_ws(":", "type", "year")).when(
        F.col("season").isNotNull() & F.col("episode").isNotNull(), F.concat_ws(":", "type", "season", "episode")
    )
    langs = F.explode(F.array_distinct(F.transform("langs", two_letter)))
    offered = hits.select("asked", "IDSubtitle", "ISO639", F.explode(offers).alias("want"))
    if limit is not None:
        rank = F.row_number().over(W.partitionBy("asked", "ISO639", "want").orderBy("IDSubtitle"))
        offered = offered.withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_rank")
    wanted = asked.select("query_id", "asked", wants.alias("want"), langs.alias("ISO639"))
    found = offered.join(wanted, ["asked", "ISO639", "want"])
    found = found.select("query_id", "IDSubtitle", "ISO639")
    return found if limit is None else limit_per_query(found, "IDSubtitle", limit)


def lookup(meta: DataFrame, blobs: DataFrame, queries: DataFrame, providers: list[dict],
           template: str = "$video_base.$num0.$lang.$ext", limit: int | None = None, tokens: DataFrame | None = None) -> DataFrame:
    """Queries to subtitle files: (query_id, num, provider, path, content).

    The first member of each archive that is no ``.nfo`` is the answer, and the only one inflated. Content is joined last, to
    rows that are otherwise done; that of an id with very many queries is repeated for parts of them. ``queries`` also has
    ``video_base``.
    """
    hits = lookup_hits(meta, queries, limit, tokens).select(
        "query_id", F.col("IDSubtitle").alias("num"), F.col("ISO639").alias("lang")
    )
    routed = route_to_provider(hits.withColumn("lang3", three_letter(F.col("lang"))), providers, "num", "lang3")
    # used twice below: kept by a checkpoint instead of searched twice
    wanted = checkpointed(routed.where(F.col("provider").isNotNull()))
    archives = blobs.join(wanted.select("num").distinct(), "num", "left_semi")
    # written once: an archive is opened once, and names are read without the content
    first = stored(first_members(archives).dropDuplicates(["num"]).select("num", F.col("path").alias("member"), "content"), "members")
    answered = wanted.join(first.select("num", F.col("member").alias("path")), "num").join(queries.select("query_id", "video_base"), "query_id")
    fixed = fix_download_extension(F.col("path"))
    ext = F.regexp_replace(extension(fixed), r"^\.", "")
    path = render_path(
        template,
        {
            "video_base": F.col("video_base"), "num": F.col("num"), "num0": pad_num(F.col("num")),
            "lang": F.col("lang3"), "ext": ext, "path": F.col("path"),
            "base": F.regexp_replace(F.col("path"), r"(?s)\.[^./]*$", ""),
        },
    )
    answered = answered.select("query_id", "num", "provider", path.alias("path"))
    return fetch_content(answered, first.select("num", "content")).select("query_id", "num", "provider", "path", "content")
