from __future__ import annotations

import random
import re
import time
import tracemalloc

import numpy as np
import pyarrow as pa

from strata.llm import components as cc
from strata.llm import embed_dedup, jaccard_join


def _find(up, x):
    while up[x] != x:
        up[x] = up[up[x]]
        x = up[x]
    return x


def _brute_components(nodes, pairs):
    up = {x: x for x in nodes}
    for a, b in pairs:
        a, b = _find(up, a), _find(up, b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {x: _find(up, x) for x in nodes}


def test_components_chains_stars_and_cliques(spark, room):
    rng = np.random.default_rng(3)
    pairs = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(500, 499), (499, 500), (7, 7)]
    pairs += [(int(a) + 1000, int(b) + 1000) for a, b in rng.integers(0, 200, (150, 2))]
    df = spark.createDataFrame([*pairs, (None, 3), (900, None)], "a long, b long")
    got = {r["node"]: r["component"] for r in cc.components(df, room).collect()}
    real = [(a, b) for a, b in pairs if a != b]
    assert got == _brute_components({x for p in real for x in p}, real)
    assert cc.components(df.limit(0), room, "none").collect() == []


def _shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def _brute_jaccard(rows):
    sets = [(i, _shingles(t)) for i, t in rows]
    pairs = []
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                pairs.append((i, j))
    comp = _brute_components({i for i, _ in rows}, pairs)
    return sorted((i, len(s), comp[i]) for i, s in sets)


def test_jaccard_against_brute_force(docs, doc_list, room):
    rows = [(i, t) for i, t, *_ in doc_list if i is not None]
    got = jaccard_join.jaccard_components(docs.where("doc_id is not null"), room).collect()
    assert sorted(map(tuple, got)) == _brute_jaccard(rows)


def test_jaccard_families_shared_passages_and_borders(spark, room, monkeypatch):
    """Chains of edits, passages shared by unlike texts, pairs just at and below the threshold, cut groups."""
    rng = np.random.default_rng(11)
    vocabulary = [f"v{k}" for k in range(3000)]
    prose = lambda n: list(rng.choice(vocabulary, n))
    passage = prose(60)
    rows = []
    for f in range(25):
        words = prose(int(rng.integers(5, 90)))
        for _ in range(int(rng.integers(1, 9))):
            rows.append(list(words))
            k = int(rng.integers(0, len(words)))
            words = words[:k] + prose(int(rng.integers(0, 3))) + words[k + int(rng.integers(0, 2)) :]
    rows += [prose(int(rng.integers(0, 30))) + passage + prose(int(rng.integers(0, 30))) for _ in range(40)]
    for n in range(5, 40):
        words = prose(n)
        cut = max(1, n // 9)
        rows += [words, words[:-cut], words + prose(cut), words[cut:]]
    rows = [(k, " ".join(w)) for k, w in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = _brute_jaccard(rows)
    got = sorted(map(tuple, jaccard_join.jaccard_components(df, room).collect()))
    assert got == want
    # small blocks: families are cut, and most links have to come through the token-group matrix
    monkeypatch.setattr(jaccard_join, "BLOCK", 2)
    again = sorted(map(tuple, jaccard_join.jaccard_components(df, type(room)(spark, "test")).collect()))
    assert again == want


def test_jaccard_stage_keeps_one_of_each(docs, room, no_docs):
    kept = jaccard_join.one_of_each_group(docs, room)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert {1, 5, 6, 7, 8, 10, 16} <= set(ids) and not {2, 3, 4, 9, 17} & set(ids) and not any(i and i >= 200 for i in ids)
    assert jaccard_join.jaccard_components(no_docs, room).collect() == []


def _vectors():
    rng = np.random.default_rng(5)
    rows = []
    for label in (0, 1, None):
        for _ in range(30):
            centre = rng.standard_normal(16)
            for _ in range(int(rng.integers(1, 8))):
                v = centre + rng.standard_normal(16) * rng.choice([0.05, 0.2, 0.3])
                rows.append((v.astype(np.float32).tolist(), label))
    same = rng.standard_normal(16).astype(np.float32).tolist()
    rows += [(same, 1)] * 20 + [(same, 0), ([2 * x for x in same], 1), ([-x for x in same], 1)]
    rows += [(None, 1), ([0.0] * 16, 1), ([float("nan")] * 16, 1), ([None] * 16, 1), ([], 1), ([1.0] * 3, 1), ([2.0] * 3, 1)]
    dense = rng.standard_normal(16)
    rows += [((dense + rng.standard_normal(16) * 0.01).astype(np.float32).tolist(), 2) for _ in range(150)]
    return [(k, v, label) for k, (v, label) in enumerate(rows)]


def test_embeddings_against_brute_force(spark, room):
    rows = _vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    got = embed_dedup.embedding_links(df, room, leaf=20, max_leaf=40).collect()
    usable = {}
    for i, v, label in rows:
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            u = np.array(v, float)
            usable[i] = (label, u / np.linalg.norm(u))
    pairs = [
        (i, j)
        for i, (a, x) in usable.items()
        for j, (b, y) in usable.items()
        if i < j and a == b and len(x) == len(y) and x @ y >= 0.93
    ]
    comp = _brute_components({r[0] for r in rows}, pairs)
    links = {i: 0 for i, *_ in rows}
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
    found = {r["vec_id"]: r for r in got}
    assert len(got) == len(rows)
    met = sum(r["n_links"] for r in got) / sum(links.values())
    assert 0.98 <= met <= 1.0  # the forest is approximate; no link is invented
    assert all(r["n_links"] <= links[r["vec_id"]] for r in got)
    if met == 1.0:
        assert {i: r["component_id"] for i, r in found.items()} == comp
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    assert embed_dedup.embedding_links(df.limit(0), room).collect() == []


def test_groups_open_only_where_a_query_reaches_the_bound(spark, room):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(9))
    rows, doc = [], 0
    for _ in range(12):
        passage = [word() for _ in range(24)]  # in one text of each of two families: rare, but far from 80 %
        for _ in range(2):
            base = [word() for _ in range(200)]
            for k in range(5):
                text = list(base)
                text[rng.randrange(200)] = word()
                if k == 0:
                    text[100:124] = passage
                rows.append((doc := doc + 1, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, jaccard_join.jaccard_components(df, room).collect()))
    assert got == _brute_jaccard(rows)
    table = lambda name: spark.read.parquet(f"{room.root}/{name}")
    met, opened = table("directed").select("other").distinct().count(), table("opened").count()
    assert opened < met
    grouped = {r["sig"]: r for r in table("grouped").collect()}
    unions = {r["other"]: set(r["toks"]) for r in table("unions").collect()}
    asked = {(r["grp"], r["other"]) for r in table("directed").collect()}
    qualified = {(r["sig"], r["other"]) for r in table("qualified").collect()}
    for sig, r in grouped.items():
        for grp, other in asked:
            if grp == r["grp"]:
                bound = len(set(r["toks"]) & unions[other]) * 100 >= r["n"] * 80
                assert ((sig, other) in qualified) == bound


def test_sender_round_trip_and_cost_at_many_slices():
    rng = np.random.default_rng(3)
    texts = [" ".join(map(str, rng.integers(0, 50_000, 400))) for _ in range(1500)] + ["", "one two", None]
    batch = pa.RecordBatch.from_pylist([{"doc": k, "text": t} for k, t in enumerate(texts)])
    hashes, took = jaccard_join.WordHashes(), {}
    want = {tuple(jaccard_join.shingle_set(t.encode(), hashes)) for t in texts if t}
    for slices in (64, 2_500, 80_000):
        start = time.perf_counter()
        out = pa.Table.from_batches(list(jaccard_join._send(slices, 5)(iter([batch])))).to_pylist()
        took[slices] = time.perf_counter() - start
        sets = {}
        for r in out:
            if r["docs"] is not None:
                assert [d for d, _, _ in np.frombuffer(r["docs"], np.int64).reshape(-1, 3)] == list(range(len(texts)))
                continue
            tokens, idx = jaccard_join._unplaned(r["toks"], np.uint64), jaccard_join._unplaned(r["idx"], np.uint16)
            assert set(jaccard_join._slice_of(tokens, slices)) == {r["slice"]}
            for t, g in zip(tokens, np.frombuffer(r["sigs"], np.int64)[idx]):
                sets.setdefault(g, set()).add(t)
        assert {tuple(sorted(x)) for x in sets.values()} == want
    assert took[80_000] < 3 * took[2_500] + 0.2
    assert [len(list(jaccard_join._send(64, 5)(iter([batch.slice(1500, 1)]))))] == [1]  # no tokens: the document row only


def test_the_senders_batch_is_small_beside_an_executor():
    texts = [" ".join(f"w{k}-{i % 40}x{(i * 7919 + k) % 5003}" for i in range(1_000)) for k in range(50)]
    texts = [f"{t} {n}" for n in range(46) for t in texts]  # 2.3 million shingles, equal ones held once a text
    batches = [
        pa.record_batch([pa.array(range(lo, lo + 100)), pa.array(texts[lo : lo + 100])], names=["doc", "text"])
        for lo in range(0, len(texts), 100)
    ]
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in jaccard_join._send(64, 5)(iter(batches)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows > 64
    assert peak < 140_000_000, peak
