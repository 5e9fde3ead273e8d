"""Ids that repeat with other texts or vectors, and columns whose names the operators use themselves."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from strata.llm import decontam, embed_dedup, jaccard_join, line_dedup, mixing

DOC = "doc_id long, text string"


def test_a_repeated_id_has_a_result_per_vector(spark, room):
    """Unlike vectors 2 and 3 are joined by no vector; id 1 is two vectors, one near each."""
    rows = [(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [1.0, 0.05, 0.0]), (3, [0.05, 1.0, 0.0]), (4, [0.0, 0.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, label string")
    got = sorted(tuple(r) for r in embed_dedup.embedding_links(df, room).collect())
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (4, 0, 4, True)]
    parts = {
        i: {r["component_id"] for r in embed_dedup.embedding_links(df.where(f"vec_id <> {i}"), room).collect()} for i in (2, 3)
    }
    assert parts == {2: {1, 4}, 3: {1, 4}}


def test_unusable_and_repeated_rows_stay_rows(spark, room):
    rows = [(1, [1.0, 0.0], "x"), (1, [1.0, 0.0], "x"), (1, None, "x"), (2, [0.0, 0.0], "x"), (None, [1.0, 0.0], "x"), (3, [1.0, 0.0], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = sorted((tuple(r) for r in embed_dedup.embedding_links(df, room).collect()), key=str)
    assert got == sorted([(1, 1, 1, True), (1, 1, 1, True), (1, 0, 1, True), (2, 0, 2, True), (None, 0, None, None), (3, 0, 3, True)], key=str)


def test_no_line_is_lost_at_another_text_s_position(spark, room):
    rows = [
        (1, "a shared line of text\nown line of one"),
        (2, "a shared line of text\nunique line of two"),
        (2, "precious first line of two\nsecond line of two"),
        (2, "a shared line of text\nunique line of two"),
    ]
    got = sorted(tuple(r) for r in line_dedup.line_dedup_digest(spark.createDataFrame(rows, DOC).repartition(3), room).collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [(1, 2, 0, sha(rows[0][1])), (2, 2, 0, sha(rows[2][1]))] + 2 * [(2, 2, 1, sha("unique line of two"))]
    assert got == sorted(want)


def test_a_clean_text_beside_a_contaminated_one_of_its_id(spark, room):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    docs = spark.createDataFrame([(1, "clean words"), (2, "clean"), (2, f"x {item} y"), (2, None), (None, item)], DOC)
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {(r["doc_id"], r["n_words"]): (r["n_hit"], r["contaminated"]) for r in decontam.contamination_digest(docs, items, room).collect()}
    assert got == {(1, 2): (0, False), (2, 1): (0, False), (2, 15): (13, True), (2, 0): (0, False), (None, 13): (13, True)}
    kept = sorted((tuple(r) for r in decontam.clean(docs, items, room).collect()), key=str)
    assert kept == [(1, "clean words"), (2, "clean"), (2, None)]


def test_one_row_of_each_group_by_rows(spark, room):
    base = "one two three four five six seven eight nine ten"
    rows = [(1, base), (1, base), (2, base + " "), (2, "a text of its own that nobody else has written"),
            (3, base.upper()), (3, None), (3, None), (4, ""), (None, base)]
    df = spark.createDataFrame(rows, DOC).repartition(4)
    got = sorted((tuple(r) for r in jaccard_join.one_of_each_group(df, room).collect()), key=str)
    assert got == sorted([(1, base), rows[3], (3, None), (3, None), (4, "")], key=str)


def test_columns_named_like_our_own(spark, room):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    names = "_hits, _doc, _key, _copy, _mix, _cut, _gone, _rank, row, doc, grp, block, w".split(", ")
    rows = [(k, t, f"s{k % 2}", *range(len(names))) for k, t in enumerate(["clean words only here", item, "more clean words for all", None])]
    df = spark.createDataFrame(rows, f"{DOC}, source string, " + ", ".join(f"{n} int" for n in names))
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    clean = decontam.clean(df, items, room)
    assert clean.columns == df.columns and {r["doc_id"] for r in clean.collect()} == {0, 2, 3}
    mixed = mixing.mix(df, room)
    assert mixed.columns == df.columns and mixed.count() > 0 and mixed.first()["_copy"] == 3
    one = jaccard_join.one_of_each_group(df, room)
    assert one.columns == df.columns and one.count() == 4


def test_texts_that_stay_meet_no_shuffle(spark, room):
    """Only rows that are removed or come again are shuffled with their texts, however large the tables are."""
    texts = [" ".join(f"w{k}x{j}" for j in range(9)) for k in range(300)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(1000 + k, texts[k]) for k in range(20)] + [(5, texts[5])] * 2 + [(None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    name = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        one = jaccard_join.one_of_each_group(df, room)
        plan = one._jdf.queryExecution().sparkPlan()
        got = sorted((tuple(r) for r in one.collect()), key=str)
    finally:
        spark.conf.set(name, was)
    assert got == sorted([(k, t) for k, t in enumerate(texts)] + [(None, None)], key=str)
    free = plan.children().apply(0).toString()
    assert "BroadcastHashJoin" in free and "SortMergeJoin" not in free and "text" in free


def test_marked_rows_are_all_in_the_rest(spark, room):
    df = spark.range(5000).selectExpr("id", "id * 7919 as _AT", "cast(null as binary) as _bits")
    name = F.xxhash64("id")
    rows = df.where("id % 50 = 3").select(name.alias("row"))
    free, held = jaccard_join._marked(df, name, rows, room)
    found = {r["id"] for r in held.collect()}
    assert {k for k in range(5000) if k % 50 == 3} <= found and len(found) < 1000
    assert found.isdisjoint(r["id"] for r in free.collect()) and free.count() == 5000 - len(found)
    assert free.columns == held.columns == df.columns
    free, held = jaccard_join._marked(df, name, rows.limit(0), room)
    assert free.count() == 5000 and held.count() == 0
