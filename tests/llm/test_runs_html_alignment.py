from __future__ import annotations

import hashlib
import html
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm import html_text, periodic_runs, token_alignment
from strata.llm.token_count import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# periodic runs


def _runs(words: list, least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """Every stretch of equal words ``q`` apart, for every ``q``."""
    least_period: dict[tuple[int, int], int] = {}
    n = len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(least, times * q):
                least_period.setdefault((start, i + q - start), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in least_period.items()), key=lambda r: (r[0], r[2]))


def _planted(doc_id: int | None, words: list[str]) -> list[str]:
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def _runs_row(doc_id, text) -> tuple:
    words = _planted(doc_id, WORD.findall(text or ""))
    runs = _runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    top = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(runs), *best, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(kept), len(words))


def test_runs_against_every_period(docs, doc_list):
    got = periodic_runs.runs_digest(periodic_runs.with_planted_periods(docs)).collect()
    assert got[0].__fields__[:8] == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]
    want = [_runs_row(i, t) for i, t, *_ in doc_list]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(r["n_runs"] > 0 for r in got) > 5


@pytest.mark.parametrize(("least", "times"), [(24, 3), (6, 2), (9, 4)])
def test_runs_of_few_different_words(least, times):
    rng = random.Random(least)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 4)):
            words: list[int] = []
            for _ in range(rng.randint(0, 5)):
                unit = [rng.randint(0, 2) for _ in range(rng.randint(1, 9))]
                words += (unit * rng.randint(1, 20))[: rng.randint(1, 90)]
                words += [rng.randint(0, 9) for _ in range(rng.randint(0, 8))]
            texts.append(words)
        assert periodic_runs.runs_of(texts, least, times) == [_runs(w, least, times) for w in texts]


def test_runs_of_long_texts_and_text_of_the_first_periods(spark):
    assert periodic_runs.runs_of([[5] * 60_000]) == [[(0, 60_000, 1)]]
    passage = [w for k in range(1500) for w in [*range(50), 1000 + k]]
    assert periodic_runs.runs_of([passage]) == [[]]
    rows = [(1, "start " + "a b c " * 9 + "end"), (2, ""), (3, None), (4, "x " * 23), (5, "x\ty\n" * 12)]
    got = {r["doc_id"]: r for r in periodic_runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["collapsed"] == "start a b c end" and [tuple(r) for r in got[1]["runs"]] == [(1, 27, 3)]
    assert got[2]["runs"] == got[3]["runs"] == got[4]["runs"] == [] and got[3]["collapsed"] == ""
    assert got[5]["collapsed"] == "x y"


# main text of pages


def test_minimum_cut_against_all_labellings():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(1, 9)
        scores = [rng.randint(-9, 9) for _ in range(n)]
        edges = [(a, b, rng.randint(0, 6)) for a in range(n) for b in range(a) if rng.random() < 0.5]

        def cost(labels, scores=scores, edges=edges):
            wrong = sum(abs(s) for s, content in zip(scores, labels) if (s > 0) != content)
            return wrong + sum(c for a, b, c in edges if labels[a] != labels[b])

        least = min(cost([bool(m >> k & 1) for k in range(n)]) for m in range(1 << n))
        assert cost(html_text.minimum_cut(scores, edges)) == least


SITE = """<!DOCTYPE html><html><head><title>No &lt;p&gt;</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="has-sidebar menu-open"><a class="skip" href="#x">Skip to content</a>
<div id="cookie-banner">We use cookies to make this site better. <button>Accept</button></div>
<div class="top-menu"><ul><li><a href="/">Home<li><a href="/n">News</a></ul></div>
%s
<div class="related-posts"><h3>Read next</h3><p><a href="/1">Another story that people liked a lot.</a></p></div>
<section id="comments"><h3>2 comments</h3><article class="comment"><p>I do not agree with a single word of this text, sorry.</p></article></section>
<div class="sidebar widget"><p>Subscribe to our newsletter and get all the news by mail.</p></div>
<form action=/s><input name=q><label>Search this site for more news.</label></form>
<footer><p>&copy; 2020 Some Site. All rights reserved.</p></footer></body></html>"""
STORY = """<h1>A title &amp; more</h1><p class=meta>By A. Writer
<p>The first   paragraph has a <a href="/x">link</a> and<br>a line&nbsp;break, as texts often have.<p>Short.</p>
<div class="ad">Buy our pills now, they are cheap and good.</div>
<ul><li>One item of the list<li>and another one</ul><blockquote><p>“Somebody said something here that matters.”</p></blockquote>
<p><b>An unclosed bold text that ends the story, with 1 &lt; 2 and &amp no semicolon.</p>"""
WANT = [
    "A title & more", "By A. Writer", "The first paragraph has a link and a line break, as texts often have.", "Short.",
    "One item of the list", "and another one", "“Somebody said something here that matters.”",
    "An unclosed bold text that ends the story, with 1 < 2 and & no semicolon.",
]


@pytest.mark.parametrize("frame", ["<article>%s</article>", "<div class='post-content'>%s</div>", "<main><div>%s</div></main>", "<div><div>%s</div></div>"])
def test_article_of_a_page(frame):
    blocks = html_text.label(SITE % (frame % STORY))
    assert [b.text for b in blocks if b.content] == WANT


def test_pages_of_the_test_data(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r for r in html_text.page_texts(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows) and set(got[0].__fields__[:4]) == {"page_id", "url", "text", "n_chars"}
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S).group(1)
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>?", " ", p)).split()) for p in re.split(r"</?(?:p|h1)\b[^>]*>", inner)]
        assert got[r["page_id"]]["text"] == "\n".join(p for p in parts if p)
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"]) and got[r["page_id"]]["url"] == r["url"]


def test_broken_and_empty_pages(spark):
    odd = ["", None, "<", "a < b and c > d, as plain text says.", "<p", "<!-- <p>x", "<script>var x = '<p>hidden</p>'", "<a \"" * 9,
           "</p></div>" * 9, "<p hidden>You should not see this sentence at all.</p>", "<div>" * 5000 + "deep"]
    df = spark.createDataFrame([(None if k == 3 else k, None, h, 1) for k, h in enumerate(odd)], "page_id long, url string, html string, n_blocks int")
    got = {r["page_id"]: r["text"] for r in html_text.page_texts(df.repartition(3)).collect()}
    assert len(got) == len(odd) and got[None] == "a < b and c > d, as plain text says."
    assert {got[k] for k in (0, 1, 4, 5, 6, 7, 8, 9)} == {""}
    assert html_text.page_texts(df.limit(0)).collect() == []


# two tokenizers


def test_overlaps_against_all_pairs():
    rng = random.Random(1)
    for _ in range(400):
        n = rng.randint(1, 60)
        a, b = (sorted(rng.sample(range(1, n), rng.randint(0, n - 1))) + [n] for _ in range(2))
        both = sorted({*a} & {*b})
        want = [
            (i, j, sum(c <= max(sa, sb) for c in both))
            for i, (sa, ea) in enumerate(zip([0, *a], a))
            for j, (sb, eb) in enumerate(zip([0, *b], b))
            if sa < eb and sb < ea
        ]
        for step in (1, 3, 256):
            got = token_alignment.overlaps(np.array(a), np.array(b), step)
            assert list(zip(*(x.tolist() for x in got))) == want


def test_pieces_take_equal_work():
    rng = np.random.default_rng(3)
    a, b = np.cumsum(rng.integers(1, 9, 5000)), np.cumsum(rng.integers(1, 3, 12000))
    diagonals = np.arange(0, 17_000, 256)
    i = token_alignment.crossings(a, b, diagonals)
    merged = np.sort(np.concatenate([a * 2, b * 2 + 1]))  # equal ends: A first
    assert i.tolist() == [int((merged[:d] % 2 == 0).sum()) for d in diagonals]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))


def _alignments(rows, libraries):
    """Per row (doc, A ids, B ids, groups, links) by comparing every byte's token pair."""
    a_lib, b_lib = libraries
    units = token_alignment._unit_bytes()
    out = []
    for doc_id, text in rows:
        data = (" " + (text or "")).encode()
        a = a_lib.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        a_bytes = [bytes(units[c] for c in a_lib.id_to_token(k)) for k in a]
        b_bytes = [
            bytes([int(b_lib.id_to_piece(k)[3:-1], 16)]) if b_lib.is_byte(k) else b_lib.id_to_piece(k).replace("▁", " ").encode()
            for k in b
        ]
        if b"".join(a_bytes) != data or b"".join(b_bytes) != data:
            a, b, a_bytes, b_bytes = [], [], [], []
        at = lambda tokens: [k for k, t in enumerate(tokens) for _ in t]
        links = sorted({*zip(at(a_bytes), at(b_bytes))})
        ends = lambda tokens: set(np.cumsum([len(t) for t in tokens]).tolist())
        cuts = sorted(ends(a_bytes) & ends(b_bytes))
        groups, lo = [], 0
        for hi in cuts:
            of = lambda ids, tokens, lo=lo, hi=hi: ",".join(str(k) for k, e in zip(ids, np.cumsum([len(t) for t in tokens])) if lo < e <= hi)
            groups.append(f"{of(a, a_bytes)}|{of(b, b_bytes)}")
            lo = hi
        out.append((doc_id, a, b, groups, [(a[i], b[j]) for i, j in links]))
    return out


ODD = ["a▁b", "a<s>b</s><|endoftext|>c<unk>", "\x00a", "  lead", "trail  ", "᠎ x", "ＡＢ ﬁ é é", " ", "\n", "a\r\nb",
       "x" + " " * 5000 + "y", "漢字かな交じり文", "🙂🙃 emoji", "\U0003fc3f unassigned", "١٢ ½ ౜"]


def test_alignment_against_every_byte(spark, doc_list, room, libraries):
    rows = [(r[0], r[1]) for r in doc_list if not r[1] or len(r[1]) < 5000]
    rows += [(500 + k, t) for k, t in enumerate(ODD)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_a int").repartition(4)
    want = []
    done = _alignments(rows, libraries)
    counts = Counter(pair for *_, links in done for pair in links)
    most: dict[int, int] = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    for doc_id, a, b, groups, links in done:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        best = sum(counts[p] == most[p[1]] for p in links)
        want.append((doc_id, len(a), len(b), len(groups), len(links), best, sum(counts[p] for p in links), digest))
    old = token_alignment.HOT_PAIRS
    try:
        for hot in (old, 40):  # with few hot pairs the others go through the shuffled join
            token_alignment.HOT_PAIRS = hot
            got = [tuple(r) for r in token_alignment.alignment_digest(df, room).collect()]
            assert sorted(got, key=str) == sorted(want, key=str)
    finally:
        token_alignment.HOT_PAIRS = old


def test_alignment_with_one_library_and_without_documents(spark, no_docs, room):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(ODD)], "doc_id long, text string")
    both = [
        sorted(token_alignment.align_tokens(df, path_ranks=path).collect()) for path in ("", None)
    ]
    assert both[0] == both[1] and len(both[0]) == len(ODD)
    assert token_alignment.alignment_digest(no_docs, room).collect() == []
    assert periodic_runs.runs_digest(periodic_runs.with_planted_periods(no_docs)).collect() == []
