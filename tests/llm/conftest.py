from __future__ import annotations

import random

import pytest

from strata.llm.scratch import Scratch

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kind int, h1 long, slice string"


def doc_rows() -> list[tuple]:
    """Nulls in any column, empty and long texts, ties, copies, and columns that clash with internal names."""
    rng = random.Random(7)
    words = ["".join(chr(97 + int(c)) for c in str(k)) + "ly" for k in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = prose(120)
    near = base.split()
    near[60] = "changed"
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (3, " ".join(near), "en", "b"),
        (4, base.upper(), None, "b"),
        (5, None, None, None),
        (6, "", "en", "a"),
        (7, "  \t\n\x0b ", "de", None),
        (8, "one two three", "de", "c"),
        (9, "One  two\tthree", "de", "c"),
        (10, prose(6000), "fr", "c"),
        (11, "a shared line of text\n" + prose(30), "fr", "d"),
        (12, prose(20) + "\n  A SHARED line of text\t\nshort\nshort", "fr", "d"),
        (13, "a shared line of text\na shared line of text\nown line number 13", "fr", "d"),
        (14, "É ünïcode line ¾ — 漢字 line\nÉ ünïcode line ¾ — 漢字 line", "de", "é"),
        (15, "é ünïcode line ¾ — 漢字 line", "de", "é"),
        (None, "no id but a shared line of text", "en", "a"),
        (16, "x", "en", "a"),
        (17, "x", "en", "a"),
        (17, "x", "en", "a"),
    ]
    rows += [(100 + k, prose(rng.randint(1, 80)), "en", f"s{k % 3}") for k in range(40)]
    rows += [(200 + k, base, "en", "hot") for k in range(60)]
    return [(i, t, lang, src, len(t or ""), 3, 9, "s") for i, t, lang, src in rows]


@pytest.fixture(scope="session")
def doc_list():
    return doc_rows()


@pytest.fixture(scope="session")
def docs(spark, doc_list):
    return spark.createDataFrame(doc_list, DOC_SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture()
def room(spark):
    return Scratch(spark, "test")
