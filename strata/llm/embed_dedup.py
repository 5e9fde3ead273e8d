"""Near-duplicate embeddings by a random-projection tree forest with spill overlap.

Equal vectors of one label are one class.  Each tree splits the classes of a
label recursively at the median along random directions; classes within the
spill margin of a split go to both sides.  Splits are fitted on a bounded
sample and routed over every class.  Classes are compared in the leaves with
exact double-precision cosines.  A pair that meets in several leaves counts in
the first one only, so that leaves return link counts and spanning edges, a
row a member, and no pairs.  A leaf of more than ``MAX_LEAF`` classes is
compared block against block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.components import components
from strata.llm.scratch import Scratch, received, sent

THRESHOLD = 0.93
TREES = 4
#: Spill margin: standard deviations of the projected difference of two vectors at the threshold.
SPILL = 0.45
#: Classes a leaf should hold, and the most that are compared in one task.
LEAF = 600
MAX_LEAF = 2_000
#: Bound of the sample that the splits are fitted on (of all labels together).
SAMPLE = 20_000
MIN_SAMPLE_NODE = 8

_CLASS = "vec_id long, label string, key binary, unit binary, dim int"


def _unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a row; usable vectors with their unit vector and a ``key``, the hash of the exact components."""
    for batch in batches:
        ids, labels, keys, units, dims = [], [], [], [], []
        for i, vec, label in zip(*(batch.column(k).to_pylist() for k in range(3))):
            ids.append(i)
            labels.append(label)
            usable = not (i is None or label is None or not vec or any(x is None for x in vec))
            v = np.array(vec if usable else [0.0], np.float64)
            top = np.abs(v).max()
            if not np.isfinite(top) or top == 0:
                keys.append(None)
                units.append(None)
                dims.append(None)
                continue
            v = v + 0.0  # no negative zeros
            scaled = v / top
            unit = scaled / np.sqrt(scaled @ scaled)
            keys.append(xxhash.xxh3_128_digest(v.tobytes()))
            units.append(unit.tobytes())
            dims.append(len(v))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array(keys, pa.binary()), pa.array(units, pa.binary()), pa.array(dims, pa.int32())],
            ["vec_id", "label", "key", "unit", "dim"],
        )


class Tree:
    """Splits of one tree: per label and dimension a nested ``(direction seed, threshold, low, high)`` or a leaf number."""

    def __init__(self, seed: int, reach: float):
        """``reach``: the spill margin times the square root of the dimension."""
        self.seed, self.reach, self.roots, self.leaves = seed, reach, {}, 0

    def direction(self, node_seed: int, dim: int) -> np.ndarray:
        d = np.random.default_rng([self.seed, node_seed]).standard_normal(dim)
        return d / np.sqrt(d @ d)

    def fit(self, root, vectors: np.ndarray, expected: float, leaf: int) -> None:
        self.roots[root] = self._split(vectors, expected, leaf, 1)

    def _split(self, vectors: np.ndarray, expected: float, leaf: int, node_seed: int):
        if expected > leaf and len(vectors) >= MIN_SAMPLE_NODE:
            along = vectors @ self.direction(node_seed, vectors.shape[1])
            middle, margin = float(np.median(along)), self.reach / np.sqrt(vectors.shape[1])
            low, high = along <= middle + margin, along > middle - margin
            # a dense node, nearly all of it within the margin, stays whole
            if max(low.sum(), high.sum()) < 0.9 * len(vectors):
                return (
                    node_seed,
                    middle,
                    self._split(vectors[low], expected * low.mean(), leaf, 2 * node_seed),
                    self._split(vectors[high], expected * high.mean(), leaf, 2 * node_seed + 1),
                )
        self.leaves += 1
        return self.leaves - 1

    def route(self, root, vectors: np.ndarray) -> list[list[int]]:
        """The leaves of every vector, in ascending order."""
        out: list[list[int]] = [[] for _ in vectors]
        stack = [(self.roots.get(root, -1), np.arange(len(vectors)))]
        while stack:
            node, rows = stack.pop()
            if not len(rows):
                continue
            if not isinstance(node, tuple):
                for r in rows.tolist():
                    out[r].append(node)
                continue
            node_seed, middle, low, high = node
            along = vectors[rows] @ self.direction(node_seed, vectors.shape[1])
            margin = self.reach / np.sqrt(vectors.shape[1])
            stack.append((low, rows[along <= middle + margin]))
            stack.append((high, rows[along > middle - margin]))
        return [sorted(x) for x in out]


def _fit(sample: list, counts: dict, trees: int, leaf: int, threshold: float, spill: float) -> list[Tree]:
    reach = spill * float(np.sqrt(2 - 2 * threshold))
    by_root: dict = {}
    for label, dim, unit in sample:
        by_root.setdefault((label, dim), []).append(np.frombuffer(unit))
    forest = []
    for t in range(trees):
        tree = Tree(t, reach)
        for root in sorted(by_root):
            tree.fit(root, np.stack(by_root[root]), counts[root], leaf)
        forest.append(tree)
    return forest


def _leaf_rows(forest):
    """One row per class and leaf: leaf key, and the class's leaves in every tree up to this one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = received(forest)
        for batch in batches:
            ids, copies, labels, units, dims = (batch.column(k).to_pylist() for k in range(5))
            rows: dict[str, list] = {c: [] for c in ("root", "tree", "leaf", "id", "copies", "unit", "seen")}
            by_root: dict = {}
            for r, root in enumerate(zip(labels, dims)):
                by_root.setdefault(root, []).append(r)
            for root, members in by_root.items():
                vectors = np.stack([np.frombuffer(units[r]) for r in members])
                routed = [tree.route(root, vectors) for tree in trees]
                for j, r in enumerate(members):
                    seen: list[int] = []
                    for t, leaves in enumerate(x[j] for x in routed):
                        for leaf in leaves:
                            seen.append(t << 40 | (leaf + 1))
                            rows["root"].append(f"{root[1]}:{root[0]}")
                            rows["tree"].append(t)
                            rows["leaf"].append(leaf)
                            rows["id"].append(ids[r])
                            rows["copies"].append(copies[r])
                            rows["unit"].append(units[r])
                            rows["seen"].append(list(seen))
            yield pa.RecordBatch.from_pydict(
                rows,
                schema=pa.schema(
                    [("root", pa.string()), ("tree", pa.int32()), ("leaf", pa.int64()), ("id", pa.int64()), ("copies", pa.int64()), ("unit", pa.binary()), ("seen", pa.list_(pa.int64()))]
                ),
            )

    return run


def _met_before(seen_a: np.ndarray, seen_b: np.ndarray) -> np.ndarray:
    """Whether row k of both (padded with different negative values) share an earlier leaf."""
    met = np.zeros(len(seen_a), bool)
    for col in range(seen_b.shape[1]):
        met |= (seen_a == seen_b[:, col : col + 1]).any(axis=1)
    return met


def _padded(lists: list[list[int]], fill: int) -> np.ndarray:
    width = max(map(len, lists), default=0) or 1
    out = np.full((len(lists), width), fill, np.int64)
    for k, x in enumerate(lists):
        out[k, : len(x)] = x
    return out


def _compare(threshold: float, chunk: int = 256):
    """Links inside a group, or between its two blocks: per member its link count and a spanning edge."""

    def run(rows: pa.Table) -> pa.Table:
        ids = rows["id"].to_numpy()
        copies = rows["copies"].to_numpy()
        side = rows["side"].to_numpy()
        order = np.lexsort((ids, side))
        ids, copies, side = ids[order], copies[order], side[order]
        vectors = np.stack([np.frombuffer(x) for x in rows["unit"].to_pylist()])[order]
        seen = rows["seen"].to_pylist()
        before = [seen[k][:-1] for k in order]  # the last is this leaf
        seen_a, seen_b = _padded(before, -1), _padded(before, -2)
        n, split = len(ids), int((side == 0).sum())
        across = split < n
        links = np.zeros(n, np.int64)
        up = np.arange(n)

        def root(x: int) -> int:
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for a in range(0, split, chunk):
            b = min(a + chunk, split)
            first = split if across else a
            close = vectors[a:b] @ vectors[first:].T >= threshold
            i, j = np.nonzero(close)
            i, j = i + a, j + first
            if not across:
                i, j = i[i < j], j[i < j]
            for s in range(0, len(i), 200_000):
                x, y = i[s : s + 200_000], j[s : s + 200_000]
                new = ~_met_before(seen_a[x], seen_b[y])
                x, y = x[new], y[new]
                np.add.at(links, x, copies[y])
                np.add.at(links, y, copies[x])
                # one edge per row and chunk joins a row to its first partner; the rest join through the others
                for p, q in zip(x.tolist(), y.tolist()):
                    if up[p] != up[q]:
                        p, q = root(p), root(q)
                        if p != q:
                            up[max(p, q)] = min(p, q)
        roots = np.array([root(k) for k in range(n)], np.int64) if n else np.empty(0, np.int64)
        touched = (links > 0) | (roots != np.arange(n))
        return pa.table(
            {"id": pa.array(ids[touched]), "links": pa.array(links[touched]), "root": pa.array(ids[roots[touched]])},
            schema=pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())]),
        )

    return run


def embedding_links(
    vectors: DataFrame,
    scratch: Scratch,
    *,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    leaf: int = LEAF,
    max_leaf: int = MAX_LEAF,
    spill: float = SPILL,
    sample: int = SAMPLE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row.

    Two vectors of equal label and length link when their cosine is
    ``threshold`` or more.  Vectors that are null, empty or zero, or hold null
    or non-finite components, and rows with a null label link with nothing; so
    do rows with a null id, whose component is null.  Rows that repeat an id
    are vectors each: equal ones link as copies, others by their own cosines,
    and each row has its own result.  The sample
    that fits the splits is bounded by ``sample`` rows; every row is indexed.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"), F.col(label_col).cast("string").alias("l")
    )
    units = rows.mapInArrow(_unit_rows, _CLASS)
    group = ["label", "key", "dim"]
    plain = scratch.table(units, "units")
    # a class of equal vectors is a node of its own, numbered as it is written: ids may repeat in several classes
    classes = scratch.table(
        plain.where("key IS NOT NULL")
        .groupBy(*group)
        .agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"), F.min("unit").alias("unit"))
        .withColumn("id", F.monotonically_increasing_id()),
        "classes",
    )
    spark = vectors.sparkSession
    # labels are the roots of the trees; only those of more than a leaf are split, so only they are counted and sampled
    counted = classes.groupBy("label", "dim").agg(F.count("*").alias("n")).where(F.col("n") > leaf)
    total = classes.count()
    share = min(1.0, sample / max(1, total))
    large = scratch.table(counted, "large")
    counts = {(r["label"], r["dim"]): r["n"] for r in large.orderBy(F.desc("n")).limit(sample // MIN_SAMPLE_NODE).collect()}
    picked = (
        classes.join(large.select("label", "dim"), ["label", "dim"], "left_semi")
        .where(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
        .select("label", "dim", "unit")
        .limit(2 * sample)
        .collect()
    )
    known = [r for r in picked if (r["label"], r["dim"]) in counts]
    forest = sent(spark, _fit(known, counts, trees, leaf, threshold, spill))
    placed = scratch.table(
        classes.select("id", "copies", "label", "unit", "dim").mapInArrow(
            _leaf_rows(forest), "root string, tree int, leaf long, id long, copies long, unit binary, seen array<long>"
        ),
        "placed",
    )
    key = ["root", "tree", "leaf"]
    held = placed.groupBy(*key).agg(F.count("*").alias("held"))
    blocks = F.ceil(F.col("held") / F.lit(max_leaf / 2)).cast("int")
    held = scratch.table(
        held.where("held > 1").select(*key, F.when(F.col("held") > max_leaf, blocks).otherwise(1).alias("blocks")), "held"
    )
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    # block x meets every block: row (lo, hi) with lo <= hi; a row is on side 1 when its own block is the higher of two
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (
        placed.join(held, key)
        .withColumn("own", block)
        .withColumn("other", other)
        .select(
            *key,
            F.least("own", "other").alias("lo"),
            F.greatest("own", "other").alias("hi"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
            "id",
            "copies",
            "unit",
            "seen",
        )
    )
    parts = scratch.table(
        dealt.groupBy(*key, "lo", "hi").applyInArrow(_compare(threshold), "id long, links long, root long"), "parts"
    )
    links = parts.groupBy("id").agg(F.sum("links").alias("links"))
    comps = components(parts.select(F.col("id").alias("a"), F.col("root").alias("b")), scratch)
    joined = scratch.table(
        classes.join(links, "id", "left")
        .join(comps, classes["id"] == comps["node"], "left")
        .select(
            *group,
            "least_id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("root"),
        ),
        "joined",
    )
    least = joined.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = scratch.table(joined.join(least, "root").select(*group, "n_links", "component_id"), "named")
    linked = plain.where("key IS NOT NULL").join(named, group).select("vec_id", "n_links", "component_id")
    alone = plain.where("key IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
