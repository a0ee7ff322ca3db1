"""CMP-1 / CMP-2: corpus acquisition from landed pages and API answers.

The reference crawls a web API; here the network part is out of scope and the
landed data are tables: pages ``(page_id, url, html)`` and JSON answers as
string columns.  Everything else is Spark work:

* ``extract_corpus``: page -> element text (STR-7) -> bracket runs removed
  (STR-5) -> empty lines dropped (STR-6) -> pages without text dropped
  (FLT-3) -> ``(artist, title, text)`` with a file-safe title (PRJ-4);
* ``flatten_listing``: paged song listings -> one row per song of the
  requested artist (SRC-6, STR-15, FLT-2); all pages are rows, so the page
  loop disappears;
* ``resolve_entities``: seed names -> the first search hit whose artist name
  equals the seed case-insensitively (JN-13, WIN-6, FLT-1, FLT-4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.html import extract_element_text
from tessera.functions.text import drop_blank_lines, safe_title, strip_brackets

LISTING_SCHEMA = T.StructType([
    T.StructField("response", T.StructType([
        T.StructField("songs", T.ArrayType(T.StructType([
            T.StructField("title", T.StringType()),
            T.StructField("url", T.StringType()),
            T.StructField("primary_artist", T.StructType([T.StructField("id", T.LongType())])),
        ]))),
        T.StructField("next_page", T.LongType()),
    ])),
])

SEARCH_SCHEMA = T.StructType([
    T.StructField("response", T.StructType([
        T.StructField("hits", T.ArrayType(T.StructType([
            T.StructField("result", T.StructType([
                T.StructField("primary_artist", T.StructType([
                    T.StructField("id", T.LongType()),
                    T.StructField("name", T.StringType()),
                ])),
            ])),
        ]))),
    ])),
])


def clean_text(text) -> F.Column:
    """STR-5 then STR-6, as applied to scraped text."""
    return drop_blank_lines(strip_brackets(text))


def extract_corpus(pages: DataFrame, tag: str = "div", css_class: str | None = "lyrics",
                   artist_col: str = "artist", title_col: str = "title") -> DataFrame:
    """CMP-1: pages(artist, title, html) -> corpus rows (artist, title, text)."""
    with_text = extract_element_text(pages, "html", tag, css_class, "raw")
    out = with_text.select(artist_col, safe_title(F.col(title_col)).alias("title"),
                           clean_text(F.col("raw")).alias("text"), F.col("raw").isNull().alias("_none"))
    return out.where(~F.col("_none") & (F.col("text") != "")).drop("_none")


def write_corpus(corpus: DataFrame, path: str) -> None:
    """SNK-7: one folder per artist (``artist=<name>/``), Parquet files with
    (title, text); the layout a corpus scan reads back by partition."""
    # Range keys (artist, title) keep each task to few artists (few files)
    # while splitting a prolific artist over several tasks.
    (corpus.repartitionByRange("artist", "title").write.mode("overwrite")
     .partitionBy("artist").parquet(path))


def flatten_listing(listings: DataFrame, json_col: str = "json") -> DataFrame:
    """SRC-6 / STR-15 / FLT-2: listings(artist_id, page, json) -> one row per
    song (artist_id, page, pos, title, url) whose primary artist is the
    requested one."""
    parsed = listings.withColumn("_j", F.from_json(F.col(json_col), LISTING_SCHEMA))
    songs = parsed.select("artist_id", "page", F.posexplode("_j.response.songs").alias("pos", "song"))
    return (songs.where(F.col("song.primary_artist.id") == F.col("artist_id"))
            .select("artist_id", "page", F.col("pos").cast("bigint").alias("pos"),
                    F.col("song.title").alias("title"), F.col("song.url").alias("url")))


def search_hits(answers: DataFrame, json_col: str = "json") -> DataFrame:
    """STR-15: answers(seed, json) -> hits(seed, hit_pos, artist_id, artist_name)."""
    parsed = answers.withColumn("_j", F.from_json(F.col(json_col), SEARCH_SCHEMA))
    hits = parsed.select("seed", F.posexplode("_j.response.hits").alias("hit_pos", "hit"))
    return hits.select("seed", F.col("hit_pos").cast("bigint").alias("hit_pos"),
                       F.col("hit.result.primary_artist.id").alias("artist_id"),
                       F.col("hit.result.primary_artist.name").alias("artist_name"))


def resolve_entities(seeds: DataFrame, hits: DataFrame, dedupe: bool = False) -> DataFrame:
    """JN-13 / WIN-6 / FLT-1: seeds(seed) x hits(seed, hit_pos, artist_id,
    artist_name) -> (seed, artist_id) of the first exactly matching hit.

    The first match is a ``min_by`` aggregate (partial + final), not a window,
    so a seed with a huge hit list never sits in one task.  ``dedupe`` keeps
    one seed per resolved id (case variants of a name, Q22)."""
    m = hits.where(F.lower("artist_name") == F.lower("seed"))
    first = m.groupBy("seed").agg(F.min_by("artist_id", "hit_pos").alias("artist_id"),
                                  F.min("hit_pos").alias("hit_pos"))
    out = seeds.select("seed").distinct().join(first, "seed")
    if dedupe:
        out = out.groupBy("artist_id").agg(F.min("seed").alias("seed"), F.min("hit_pos").alias("hit_pos"))
    return out.select("seed", "artist_id", "hit_pos")


def unresolved_entities(seeds: DataFrame, resolved: DataFrame) -> DataFrame:
    """FLT-4: seeds with no matching hit (reported and skipped)."""
    return seeds.select("seed").distinct().join(resolved.select("seed"), "seed", "left_anti")
