"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are runs of ``WINDOW`` words.  A window occurs in a text
only if its rarest word does: with containment required whole, the necessary
prefix in order of rarity is one token.  Words of the documents are joined
with the rarest words of the windows, positional and length bounds drop what
cannot hold the window, and the item-sized run of words is compared exactly.
DataFrame functions only; documents are not shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.scratch import Scratch, fresh

WINDOW = 13
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Windows that are broadcast at once (a few hundred bytes each); more are joined block by block.
BLOCK_WINDOWS = 200_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text_col: str) -> Column:
    """ASCII-lower-cased words; a null text has none."""
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(text, NOT_WORD, -1), "")


def item_windows(items: DataFrame, window: int, item_col: str, text_col: str) -> DataFrame:
    """Distinct ``(item, len, words)``: runs of ``window`` words, or the whole of a shorter item."""
    w = items.where(F.col(item_col).isNotNull()).select(F.col(item_col).alias("item"), words(text_col).alias("w"))
    w = w.where(F.size("w") > 0).withColumn("len", F.least(F.size("w"), F.lit(window)))
    starts = F.explode(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1)).alias("at")
    return w.select("item", "len", "w", starts).select(
        "item", "len", F.slice("w", F.col("at"), F.col("len")).alias("words")
    ).distinct()


def contamination(
    docs: DataFrame,
    items: DataFrame,
    scratch: Scratch,
    *,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``(doc, text_key, hits, items)`` of the documents in which a window occurs.

    ``hits`` holds the distinct positions of the words inside any occurrence,
    ``items`` the distinct items whose windows occur.  Items without words or
    with a null id have no windows; empty tables give an empty result.
    A document is its id and the hash ``text_key`` of its text, so rows that
    repeat an id with other texts have results of their own.
    """
    windows = scratch.table(item_windows(items, window, item_col, item_text_col), "windows")
    n = windows.count()
    if n == 0:
        kind = items.schema[item_col].dataType.simpleString()
        return docs.limit(0).select(
            F.col(id_col).alias("doc"),
            F.xxhash64(text_col).alias("text_key"),
            F.array().cast("array<int>").alias("hits"),
            F.array().cast(f"array<{kind}>").alias("items"),
        )
    blocks = max(1, -(-n // BLOCK_WINDOWS))
    windows = windows.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(blocks)))
    text = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("text_key"), words(text_col).alias("w"))
    each = text.select(F.explode("w").alias("token"))
    found = []
    for block in range(blocks):
        own = windows.where(F.col("block") == block) if blocks > 1 else windows
        tokens = own.select(F.explode("words").alias("token")).distinct()
        # how often each word of the windows occurs in the corpus; a window with a word that never does cannot occur
        rarity = scratch.table(
            each.join(F.broadcast(tokens), "token").groupBy("token").agg(F.count("*").alias("freq")),
            f"rarity-{block}",
        )
        placed = own.select("item", "len", "words", F.posexplode("words").alias("offset", "token"))
        anchors = (
            placed.join(rarity, "token", "left")
            .groupBy("item", "len", "words")
            .agg(F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "token", "offset")).alias("x"))
            .where("x.freq > 0")
            .select("item", "len", F.array_join("words", " ").alias("run"), "x.token", "x.offset")
        )
        anchors = scratch.table(anchors, f"anchors-{block}")  # BLOCK_WINDOWS rows at most, about
        at = F.col("pos") - F.col("offset")
        found.append(
            text.select("doc", "text_key", "w", F.posexplode("w").alias("pos", "token"))
            .join(F.broadcast(anchors), "token")
            .where((at >= 0) & (at + F.col("len") <= F.size("w")))
            .where(F.array_join(F.slice("w", at + 1, F.col("len")), " ") == F.col("run"))
            .select("doc", "text_key", "item", at.alias("at"), "len")
        )
    occurrences = reduce(DataFrame.union, found)
    runs = F.transform(
        F.collect_set(F.struct("at", "len")), lambda x: F.sequence(x["at"], x["at"] + x["len"] - 1)
    )
    return occurrences.groupBy("doc", "text_key").agg(
        F.array_distinct(F.flatten(runs)).alias("hits"), F.collect_set("item").alias("items")
    )


def contamination_digest(docs: DataFrame, items: DataFrame, scratch: Scratch) -> DataFrame:
    """Per document: words, hit words, items found, their digest, and the verdict.

    Contaminated: a hit, and at least one word in twenty hit.  A null text has
    no words and no hits.  Rows that repeat an id get the result of their own text.
    """
    found = contamination(docs, items, scratch)
    counted = docs.select("doc_id", F.xxhash64("text").alias("key"), F.size(words("text")).cast("long").alias("n_words"))
    names = F.sort_array(F.transform("items", lambda x: x.cast("string")))
    listed = found.select(
        "doc",
        "text_key",
        F.size("hits").cast("long").alias("h"),
        F.size("items").cast("long").alias("k"),
        F.array_join(names, ",").alias("names"),
    )
    n_hit = F.coalesce("h", F.lit(0).cast("long"))
    same = F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("key") == F.col("text_key"))
    return counted.join(listed, same, "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("k", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce("names", F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    found = scratch.table(contamination(docs, items, scratch, **options), "found")
    doc, key, hits = (fresh(docs, name) for name in ("_doc", "_key", "_hits"))
    listed = found.select(F.col("doc").alias(doc), F.col("text_key").alias(key), F.size("hits").alias(hits))
    return docs.join(
        listed,
        F.col(id_col).eqNullSafe(F.col(doc))
        & (F.xxhash64(text_col) == F.col(key))
        & (F.col(hits) * 20 >= F.size(words(text_col))),
        "left_anti",
    )
