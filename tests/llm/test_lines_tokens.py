from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest

from strata.llm import line_dedup, token_count

STRIP = " \t\n\x0b\x0c\r"


def _key(line: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(STRIP))


def _brute_lines(rows):
    owner: dict[str, int] = {}
    for i, t, *_ in rows:
        if i is not None:
            for key in map(_key, (t or "").split("\n")):
                if len(key) >= 10:
                    owner[key] = min(owner.get(key, i), i)
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or owner.get(_key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def test_line_dedup_against_brute_force(docs, doc_list, room):
    got = [tuple(r) for r in line_dedup.line_dedup_digest(docs, room).collect()]
    assert sorted(got, key=str) == sorted(_brute_lines(doc_list), key=str)


def test_a_line_in_every_document_spans_partitions(spark, room):
    rows = [(i, f"the one common line\nown line of {i:05d}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = line_dedup.line_dedup_digest(df, room).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert {r["doc_id"]: r["n_dropped"] for r in got} == {i: int(i > 0) for i, _ in rows}


def test_bitmaps_and_kept_text(docs, doc_list, room):
    maps = {r["doc"]: r for r in line_dedup.duplicate_line_bitmaps(docs, room).collect()}
    assert maps[12]["n_dropped"] == 1 and maps[12]["n_lines"] == 4
    assert line_dedup.keep_bitmap(maps[12]["keep_bitmap"], 4).tolist() == [True, False, True, True]
    assert line_dedup.keep_bitmap(None, 2).all()
    assert 13 not in {k for k, r in maps.items() if r["n_dropped"] == 0}
    assert len(zlib.decompress(maps[12]["keep_bitmap"])) == 1
    texts = {r["doc_id"]: r["text"] for r in line_dedup.kept_text(docs, room).collect()}
    assert texts[11].startswith("a shared line of text\n") and texts[15] == "é ünïcode line ¾ — 漢字 line"


def test_no_documents(no_docs, room):
    assert line_dedup.line_dedup_digest(no_docs, room).collect() == []
    assert token_count.token_counts(no_docs).collect() == []


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_count.tokenizer_path())


def test_token_counts_against_the_library(docs, doc_list, tokenizer):
    got = sorted(map(tuple, token_count.token_counts(docs).collect()), key=str)
    want = []
    for i, t, *_ in doc_list:
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 512))
    assert got == sorted(want, key=str)


def test_whole_tokens_are_single_tokens(tokenizer):
    whole = token_count.whole_tokens(token_count.tokenizer_path())
    assert len(whole) > 40_000
    for text in whole[::997]:
        assert len(tokenizer.encode(text, add_special_tokens=False).ids) == 1


def test_special_strings_odd_spaces_and_new_characters(tokenizer):
    counter = token_count.Counter(token_count.tokenizer_path(), token_count.whole_tokens(token_count.tokenizer_path()))
    rng = np.random.default_rng(1)
    pool = ["<|endoftext|>", "  ", "\n\n", " the", "'ll", "'", "\u0085", "　", "½", "١٢", "՘", "౜", "\U0003fc3f", "漢字", "é", "\U0001f600", "​", "x9", "!!", "<|endof"]
    for _ in range(300):
        text = "".join(rng.choice(pool, rng.integers(1, 12)))
        assert counter.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids), text
    long = "abcdefgh" * 5000
    assert counter.count(long) == len(tokenizer.encode(long, add_special_tokens=False).ids)
