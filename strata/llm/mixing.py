"""Mixing sources to target weights by hash thresholds.

Every document has a fixed 60-bit hash.  Word counts are summed by source and
hash bucket; the bucket in which a source's budget runs out is refined level
by level until a single hash is left, and a plain filter on the hash takes the
documents.  Thresholds are nested: a larger budget takes a superset.  No sort,
no Python; what is gathered is a histogram of at most 4,096 buckets a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.scratch import Scratch, fresh

HASH_BITS = 60
LEVEL_BITS = 12
WORD = r"[^\x20\x09-\x0D]+"


def document_hash(id_col: str) -> Column:
    """Upper 60 bits of the MD5 of the id as text; a null id hashes as the text ``null``."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def word_count(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], budget: float, most: float) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row a source.

    Sources in code point order, null last, take ``weights`` in turn and share
    ``budget`` times all sizes.  A target stops at ``most`` times its source's
    size; the excess is shared by weight among the rest until none is above.
    In the order of cap over weight the capped sources come first, so running
    sums over the sources find the level at which the rest settles.
    """
    everywhere = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(everywhere) - 1, F.lit(len(weights))) + 1
    weighed = sizes.select(
        "source",
        "source_size",
        F.element_at(F.array(*map(F.lit, weights)), turn).alias("w"),
        (F.col("source_size") * F.lit(most)).alias("cap"),
    )
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = weighed.select(
        "*",
        F.sum(F.col("source_size") * F.lit(budget)).over(whole).alias("all"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("capped"),
        F.sum("w").over(onward).alias("left"),
        F.row_number().over(order).alias("k"),
    ).select("*", (F.col("cap") * F.col("left") > (F.col("all") - F.col("capped")) * F.col("w")).alias("free"))
    first = F.min(F.when(F.col("free"), F.struct("k", "capped", "left"))).over(whole)
    return levels.select("*", first.alias("first")).select(
        "source",
        "source_size",
        F.when(F.col("first").isNull() | (F.col("k") < F.col("first.k")), F.col("cap"))
        .otherwise((F.col("all") - F.col("first.capped")) * F.col("w") / F.col("first.left"))
        .alias("target"),
    )


def mixing_cuts(
    docs: DataFrame,
    scratch: Scratch,
    *,
    weights: tuple[int, ...] = (3, 1, 2),
    budget: float = 1.5,
    most: float = 2.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Per source: ``source, source_size, target, whole, cut``.

    All its documents are taken ``whole`` times, those with a hash below
    ``cut`` once more.  The document at the threshold is taken when that comes
    nearer to the target, so the words taken miss it by half that document at most.
    """
    rows = scratch.table(
        docs.select(
            F.col(source_col).alias("source"), word_count(text_col).alias("size"), document_hash(id_col).alias("h")
        ),
        "sizes",
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, budget, most)
    n = F.col("source_size")
    goals = scratch.table(
        targets.select("*", F.when(n > 0, F.floor(F.col("target") / n)).otherwise(0).cast("int").alias("whole")).select(
            "*", (F.col("target") - F.col("whole") * n).alias("rest")
        ),
        "goals",
    )
    bounds = goals.select("source", "rest", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("base"))
    for level in range(HASH_BITS // LEVEL_BITS):
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        b = bounds.select(F.col("source").alias("of"), "rest", "prefix", "base")
        inside = rows.join(
            b, F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("h", shift + LEVEL_BITS) == F.col("prefix"))
        )
        if level == 1:  # from here on only the boundary buckets matter
            rows = scratch.table(inside.select("source", "size", "h"), "boundary")
            inside = rows.join(b, F.col("source").eqNullSafe(F.col("of")))
        sums = inside.groupBy("source", "rest", "base", F.shiftright("h", shift).alias("bucket")).agg(
            F.sum("size").alias("s")
        )
        running = F.sum("s").over(Window.partitionBy("source").orderBy("bucket"))
        reached = sums.select("*", (F.col("base") + running).alias("upto")).where("upto > rest")
        bounds = scratch.table(
            reached.groupBy("source")
            .agg(F.min(F.struct("bucket", "upto", "s", "rest")).alias("x"))
            .select(
                "source",
                "x.rest",
                F.col("x.bucket").alias("prefix"),
                (F.col("x.upto") - F.col("x.s")).alias("base"),
                F.col("x.s").alias("s"),
            ),
            f"bounds-{level}",
        )
    nearer = (F.col("rest") - F.col("base")) * 2 >= F.col("s")
    cuts = bounds.select(
        F.col("source").alias("of"), (F.col("prefix") + F.when(nearer, 1).otherwise(0)).alias("cut")
    )
    return scratch.table(
        goals.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left").select(
            "source", "source_size", "target", "whole", F.coalesce("cut", F.lit(0).cast("long")).alias("cut")
        ),
        "cuts",
    )


def copies(docs: DataFrame, cuts: DataFrame, *, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``docs`` and a last column: source_size, target and the number of copies that the mix takes of the row.

    The column is ``_mix``, or a longer name where ``docs`` has that.
    """
    name = fresh(docs, "_cut")
    c, cut = cuts.select(F.struct(*cuts.columns).alias(name)), F.col(name)
    taken = cut["whole"] + F.when(document_hash(id_col) < cut["cut"], 1).otherwise(0)
    return docs.join(c, F.col(source_col).eqNullSafe(cut["source"])).select(
        *[docs[x] for x in docs.columns],
        F.struct(cut["source_size"].alias("source_size"), cut["target"].alias("target"), taken.cast("long").alias("copies")).alias(
            fresh(docs, "_mix")
        ),
    )


def mix(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """The mixed documents: every row repeated as often as the mix takes it, with its own columns."""
    kept = copies(docs, mixing_cuts(docs, scratch, **options))
    times, copy = F.col(kept.columns[-1])["copies"], fresh(docs, "_copy")
    return kept.select(
        *[kept[x] for x in docs.columns],
        F.explode(F.array_repeat(F.lit(1), times.cast("int"))).alias(copy),
    ).drop(copy)


def mixing_digest(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Per document its size, its source's size and target, and the words that the mix takes of it.

    Null text: size 0, nothing taken.  A null source is a source of its own,
    last in order.  Rows that repeat an id share its hash and are taken
    together.  A source without words has target 0.  Empty table: empty result.
    """
    size = word_count("text")
    kept = copies(docs.select("doc_id", "source", size.alias("size")), mixing_cuts(docs, scratch))
    return kept.select(
        "doc_id", "size", "_mix.source_size", "_mix.target", (F.col("size") * F.col("_mix.copies")).alias("taken")
    )
