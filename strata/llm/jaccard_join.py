"""Exact Jaccard self-join on word shingles with a token-group matrix.

1. Every text becomes a set of shingle hashes; equal sets are one class.  The
   hashes travel as sorted, byte-planed blobs, one per hash range, and each
   range returns, per class, its tokens that some other class holds too.
2. A class can have a partner only if 80 % of its tokens are held elsewhere.
   The others are out, and no text is read again.
3. Similar classes are grouped: an equal min-hash, in blocks of bounded size.
   A group's classes are compared with each other as one matrix product of
   their token incidences, which returns spanning edges and no pairs.
4. The token-group matrix tells which groups hold a token among the rarest of
   a class, as many as any partner must share one of.  Groups that meet there
   are paired, unless no sizes fit or all that met are connected already.  The
   classes of the smaller group of a pair query the other: they meet its stored
   token union, whose overlap bounds that with any member.  Only groups that a
   query reaches the bound of are opened: their members are sent and compared
   exactly with the queries that qualify.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.components import components
from strata.llm.scratch import Scratch, fresh
from strata.llm.shingles import SHINGLE, WordHashes, shingle_set

PERCENT = 80
#: Classes of a group, or queries of one, that are compared in one task.
BLOCK = 512
#: Rows and token columns of one matrix product.
CHUNK = 128
COLUMNS = 8_192
#: Bytes of text behind one hash range (its tokens are sorted in one task's memory).
RANGE_BYTES = 12_000_000
#: Tokens and documents gathered before a task sends blobs.
FLUSH_TOKENS = 1_000_000
FLUSH_DOCS = 60_000
#: Bits of one bitmap of ``bitmap_construct_agg``, bits for every row marked, and the most bitmaps (8 MB).
BITMAP = 32_768
BITS_A_ROW = 16
MOST_BITMAPS = 2_048

_BLOBS = "slice int, toks binary, idx binary, sigs binary, ns binary, docs binary, nulls binary"
_INDEX = "kind byte, doc long, sig long, n int, toks array<long>, dfs array<int>"


def _planed(values: np.ndarray, start: np.ndarray) -> pa.BinaryArray:
    """One blob a part of ``values`` (parts begin at ``start``): bytes of equal weight together, as the upper ones of sorted values compress well."""
    size, length = values.itemsize, np.diff(np.append(start, len(values)))
    first, long = np.repeat(start, length), np.repeat(length, length)
    at = np.arange(len(values)) - first + size * first
    out, planes = np.empty(size * len(values), np.uint8), values.view(np.uint8).reshape(-1, size)
    for k in range(size):
        out[at + k * long] = planes[:, k]
    return _blobs(out, size * np.append(start, len(values)))


def _blobs(data: np.ndarray, cuts: np.ndarray) -> pa.BinaryArray:
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data)])


def _unplaned(blob: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(blob, np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def _slice_of(tokens: np.ndarray, slices: int) -> np.ndarray:
    return ((tokens >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int32)


def _send(slices: int, size: int):
    def flush(sets: dict[int, np.ndarray], docs: list, turn: int) -> pa.RecordBatch:
        sigs = np.fromiter(sets, np.int64, len(sets))
        ns = np.fromiter(map(len, sets.values()), np.int32, len(sets))
        tokens = np.concatenate([*sets.values(), np.empty(0, np.uint64)])
        owner = np.repeat(np.arange(len(sets), dtype=np.uint16), ns)
        order = np.argsort(tokens)
        tokens, owner = tokens[order], owner[order]
        where = _slice_of(tokens, slices)
        # array steps over all parts at once: the cost follows the tokens, not the number of slices
        start = np.flatnonzero(np.diff(where, prepend=-1))
        part = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(where))))
        held, local = np.unique(part * 65_536 + owner, return_inverse=True)
        cuts = np.searchsorted(held, np.arange(len(start) + 1) * 65_536)
        here, idx = held % 65_536, (local - cuts[part]).astype(np.uint16)
        ids = np.array([d if d is not None else 0 for d, _, _ in docs], np.int64)
        nulls = np.array([d is None for d, _, _ in docs], bool)
        rest = np.array([(g, n) for _, g, n in docs], np.int64).reshape(-1, 2)
        none = pa.nulls(1, pa.binary())
        columns = [
            (where[start], [turn % slices]),
            (_planed(tokens, start), none),
            (_planed(idx, start), none),
            (_blobs(sigs[here].view(np.uint8), cuts * 8), none),
            (_blobs(ns[here].view(np.uint8), cuts * 4), none),
            (pa.nulls(len(start), pa.binary()), [np.column_stack([ids, rest]).tobytes()]),
            (pa.nulls(len(start), pa.binary()), [nulls.tobytes()]),
        ]
        schema = pa.schema([("slice", pa.int32()), *((c, pa.binary()) for c in ("toks", "idx", "sigs", "ns", "docs", "nulls"))])
        arrays = [pa.concat_arrays([pa.array(x, f.type), pa.array(y, f.type)]) for (x, y), f in zip(columns, schema)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sets, docs, held, turn = WordHashes(), {}, [], 0, None
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                tokens = shingle_set(text, hashes, size)
                sig = xxhash.xxh3_64_intdigest(tokens.tobytes()) - 2**63 if len(tokens) else 0
                turn = (sig & 0xFFFF) if turn is None else turn
                docs.append((doc, sig, len(tokens)))
                if len(tokens) and sig not in sets:
                    sets[sig] = tokens
                    held += len(tokens)
                if held >= FLUSH_TOKENS or len(docs) >= FLUSH_DOCS:
                    yield flush(sets, docs, turn)
                    sets, docs, held, turn = {}, [], 0, turn + 1
        if docs:
            yield flush(sets, docs, turn)

    return run


_INDEX_ARROW = pa.schema(
    [
        ("kind", pa.int8()),
        ("doc", pa.int64()),
        ("sig", pa.int64()),
        ("n", pa.int32()),
        ("toks", pa.list_(pa.int64())),
        ("dfs", pa.list_(pa.int32())),
    ]
)


def _shared_tokens(rows: pa.Table) -> pa.Table:
    """One hash range: per class the tokens that another class holds too, with their class counts; document rows pass."""
    toks, sigs, ns, docs, nulls = [], [], [], [], []
    for r in rows.to_pylist():
        if r["docs"] is not None:
            docs.append(np.frombuffer(r["docs"], np.int64).reshape(-1, 3))
            nulls.append(np.frombuffer(r["nulls"], bool))
        else:
            idx = _unplaned(r["idx"], np.uint16)
            toks.append(_unplaned(r["toks"], np.uint64))
            sigs.append(np.frombuffer(r["sigs"], np.int64)[idx])
            ns.append(np.frombuffer(r["ns"], np.int32)[idx])
    parts = []
    if docs:
        d, null = np.concatenate(docs), np.concatenate(nulls)
        empty = pa.nulls(len(d), pa.list_(pa.int64())), pa.nulls(len(d), pa.list_(pa.int32()))
        parts.append(
            pa.Table.from_arrays(
                [
                    pa.array(np.zeros(len(d), np.int8)),
                    pa.array(d[:, 0], mask=null),
                    pa.array(d[:, 1]),
                    pa.array(d[:, 2].astype(np.int32)),
                    *empty,
                ],
                schema=_INDEX_ARROW,
            )
        )
    if toks:
        t, g, n = np.concatenate(toks), np.concatenate(sigs), np.concatenate(ns)
        order = np.lexsort((g, t))
        t, g, n = t[order], g[order], n[order]
        first = np.ones(len(t), bool)
        first[1:] = (t[1:] != t[:-1]) | (g[1:] != g[:-1])  # equal sets from several tasks count once
        t, g, n = t[first], g[first], n[first]
        start = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        count = np.diff(np.append(start, len(t)))
        df = np.repeat(count, count)
        shared = df > 1
        t, g, n, df = t[shared], g[shared], n[shared], df[shared]
        order = np.argsort(g, kind="stable")
        t, g, n, df = t[order], g[order], n[order], df[order]
        start = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.empty(0, np.int64)
        offsets = pa.array(np.append(start, len(g)).astype(np.int32))
        parts.append(
            pa.Table.from_arrays(
                [
                    pa.array(np.ones(len(start), np.int8)),
                    pa.nulls(len(start), pa.int64()),
                    pa.array(g[start]),
                    pa.array(n[start]),
                    pa.ListArray.from_arrays(offsets, pa.array(t.view(np.int64))),
                    pa.ListArray.from_arrays(offsets, pa.array(df.astype(np.int32))),
                ],
                schema=_INDEX_ARROW,
            )
        )
    return pa.concat_tables(parts)


def _overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of ``a`` with every set of ``b`` (sorted distinct tokens)."""
    out = np.zeros((len(a), len(b)), np.float32)
    ta, tb = np.concatenate(a), np.concatenate(b)
    ra, rb = np.repeat(np.arange(len(a)), [len(x) for x in a]), np.repeat(np.arange(len(b)), [len(x) for x in b])
    both = np.intersect1d(ta, tb)  # other tokens cannot meet
    ia, ib = np.searchsorted(both, ta), np.searchsorted(both, tb)
    ka = both[np.minimum(ia, len(both) - 1)] == ta if len(both) else np.zeros(len(ta), bool)
    kb = both[np.minimum(ib, len(both) - 1)] == tb if len(both) else np.zeros(len(tb), bool)
    ia, ra, ib, rb = ia[ka], ra[ka], ib[kb], rb[kb]
    oa, ob = np.argsort(ia, kind="stable"), np.argsort(ib, kind="stable")
    ia, ra, ib, rb = ia[oa], ra[oa], ib[ob], rb[ob]
    for lo in range(0, len(both), COLUMNS):
        hi = min(lo + COLUMNS, len(both))
        x, y = np.zeros((len(a), hi - lo), np.float32), np.zeros((len(b), hi - lo), np.float32)
        sa, sb = slice(*np.searchsorted(ia, (lo, hi))), slice(*np.searchsorted(ib, (lo, hi)))
        x[ra[sa], ia[sa] - lo] = 1
        y[rb[sb], ib[sb] - lo] = 1
        out += x @ y.T
    return out.astype(np.int64)


def _compare(percent: int):
    """Exact links of the queries of a group (side 0) with its members (side 1), or of its members with each other.

    Returns spanning edges, a row a class at most.
    """

    def run(rows: pa.Table) -> pa.Table:
        side = rows["side"].to_numpy()
        order = np.lexsort((rows["sig"].to_numpy(), side))
        side, sigs, ns = side[order], rows["sig"].to_numpy()[order], rows["n"].to_numpy().astype(np.int64)[order]
        lists = rows["toks"].combine_chunks()
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        sets = [np.sort(values[offsets[k] : offsets[k + 1]]) for k in order]
        split = int((side == 0).sum())
        up = list(range(len(sigs)))

        def root(x: int) -> int:
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        members = np.arange(split, len(sigs))
        queries = np.arange(split) if split else members
        for lo in range(0, len(queries), CHUNK):
            q = queries[lo : lo + CHUNK]
            if not len(members):
                break
            both = _overlaps([sets[k] for k in q], [sets[k] for k in members])
            linked = both * 100 >= (ns[q][:, None] + ns[members][None, :] - both) * percent
            for i, j in zip(*np.nonzero(linked)):
                x, y = int(q[i]), int(members[j])
                if up[x] != up[y]:
                    x, y = root(x), root(y)
                    if x != y:
                        up[max(x, y)] = min(x, y)
        ends = [(sigs[k], sigs[root(k)]) for k in range(len(sigs)) if root(k) != k]
        return pa.table(
            {"a": pa.array([a for a, _ in ends], pa.int64()), "b": pa.array([b for _, b in ends], pa.int64())}
        )

    return run


def _qualifying(percent: int):
    """The queries (side 0) that share enough tokens with the token union of the group that they ask (side 1, one row).

    A query that shares fewer with the union links with no member.
    """

    def run(rows: pa.Table) -> pa.Table:
        lists = rows["toks"].combine_chunks()
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        side, n = rows["side"].to_numpy(), rows["n"].to_numpy().astype(np.int64)
        at = int(np.flatnonzero(side == 1)[0])
        union = np.sort(values[offsets[at] : offsets[at + 1]])
        place = np.minimum(np.searchsorted(union, values), len(union) - 1)
        upto = np.concatenate([[0], np.cumsum(union[place] == values)])
        shared = upto[offsets[1:]] - upto[offsets[:-1]]
        found = np.flatnonzero((side == 0) & (shared * 100 >= n * percent))
        return rows.select(["other", "part", "sig"]).take(found)

    return run


def _grouped(cand: DataFrame, scratch: Scratch) -> DataFrame:
    """``cand`` with ``grp``: classes of an equal min-hash, in blocks of about ``BLOCK`` classes."""
    keyed = scratch.table(
        cand.withColumn("key", F.array_min(F.transform("toks", lambda t: F.xxhash64(t)))), "keyed"
    )
    large = scratch.table(
        keyed.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > BLOCK), "large"
    )
    block = F.pmod(F.xxhash64("sig"), F.ceil(F.col("c") / BLOCK).cast("int"))
    return scratch.table(
        keyed.join(large, "key", "left").select(
            "sig", "n", "toks", "dfs", F.xxhash64("key", F.coalesce(block, F.lit(0))).alias("grp")
        ),
        "grouped",
    )


def _cross_links(grouped: DataFrame, inner: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """Links between classes of different groups; ``inner`` names the components (node, component) so far."""
    named = grouped.join(inner, grouped["sig"] == inner["node"], "left")
    least = F.floor((F.col("n") * percent + 99) / 100).cast("int")  # tokens that a partner must share
    must = F.col("n") - least + 1 - (F.col("n") - F.size("toks"))  # of the rarest, less those that nobody shares
    by_rarity = F.array_sort(F.arrays_zip("dfs", "toks"))
    probes = scratch.table(
        named.where(must > 0)
        .select(
            "sig", "n", "grp", F.coalesce("component", "sig").alias("comp"), F.explode(F.slice(by_rarity, F.lit(1), must)).alias("t")
        )
        .select("sig", "n", "grp", "comp", F.col("t.toks").alias("tok")),
        "probes",
    )
    # the token-group matrix over the tokens that a link must go through
    matrix = probes.groupBy("tok", "grp").agg(
        F.min("n").alias("n_lo"), F.max("n").alias("n_hi"), F.min("comp").alias("c_lo"), F.max("comp").alias("c_hi")
    )
    matrix = scratch.table(matrix, "matrix")
    # groups that hold a token in common, each pair once; what one of them has met is summed up, not its classes
    left = matrix.select("tok", "grp", *[F.col(c).alias(f"{c}_q") for c in ("n_lo", "n_hi", "c_lo", "c_hi")])
    right = matrix.withColumnRenamed("grp", "other")
    sizes = (F.col("n_hi") * 100 >= F.col("n_lo_q") * percent) & (F.col("n_hi_q") * 100 >= F.col("n_lo") * percent)
    connected = (F.least("c_lo", "c_lo_q") == F.greatest("c_hi", "c_hi_q"))
    pairs = scratch.table(
        left.join(right, "tok").where((F.col("grp") < F.col("other")) & sizes & ~connected).select("grp", "other").distinct(),
        "pairs",
    )
    scratch.drop("probes", "matrix")
    held = scratch.table(grouped.groupBy("grp").agg(F.count("*").alias("q")), "held")
    both = pairs.join(held, "grp").join(held.select(F.col("grp").alias("other"), F.col("q").alias("q_other")), "other")
    fewer = F.col("q") <= F.col("q_other")  # the smaller group queries the larger one
    pairs = scratch.table(
        both.select(
            F.when(fewer, F.col("grp")).otherwise(F.col("other")).alias("grp"),
            F.when(fewer, F.col("other")).otherwise(F.col("grp")).alias("other"),
            F.least("q", "q_other").alias("q"),
        ),
        "directed",
    )
    asked = pairs.groupBy("other").agg(F.sum("q").alias("q"))
    asked = scratch.table(asked.select("other", F.ceil(F.col("q") / BLOCK).cast("int").alias("parts")), "asked")
    unions = scratch.table(
        grouped.withColumnRenamed("grp", "other")
        .join(asked, "other")
        .groupBy("other", "parts")
        .agg(F.array_distinct(F.flatten(F.collect_list("toks"))).alias("toks")),  # of BLOCK similar classes
        "unions",
    )
    part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    queries = (
        pairs.select("grp", "other")
        .join(asked, "other")
        .join(grouped.select("grp", "sig", "n", "toks"), "grp")
        .withColumn("part", F.pmod(F.xxhash64("sig"), F.col("parts")).cast("int"))
        .select("other", "part", F.lit(0).alias("side"), "sig", "n", "toks")
    )
    bounds = unions.select("other", part, F.lit(1).alias("side"), F.lit(0).cast("long").alias("sig"), F.lit(0).alias("n"), "toks")
    found = queries.union(bounds).groupBy("other", "part").applyInArrow(_qualifying(percent), "other long, part int, sig long")
    qualified = scratch.table(found, "qualified")
    opened = scratch.table(qualified.select("other", "part").distinct(), "opened")
    queries = qualified.join(grouped.select("sig", "n", "toks"), "sig").select("other", "part", F.lit(0).alias("side"), "sig", "n", "toks")
    members = (
        grouped.withColumnRenamed("grp", "other").join(opened, "other").select("other", "part", F.lit(1).alias("side"), "sig", "n", "toks")
    )
    return queries.union(members).groupBy("other", "part").applyInArrow(_compare(percent), "a long, b long")


def jaccard_components(
    docs: DataFrame,
    scratch: Scratch,
    *,
    percent: int = PERCENT,
    shingle: int = SHINGLE,
    range_bytes: int = RANGE_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row.

    Texts link when the Jaccard similarity of their sets of ``shingle``-word
    shingles is ``percent`` % or more; ``component_id`` is the smallest id
    reachable by links.  Null, empty and wordless texts have no shingles and
    link with nothing (their component is their own id).  Rows that repeat an
    id are members each; a null id never names a component unless no other id
    is there.  Empty table: empty result.
    """
    text = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    total = text.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(64, -(-total // range_bytes))
    index = scratch.table(
        text.mapInArrow(_send(slices, shingle), _BLOBS).groupBy("slice").applyInArrow(_shared_tokens, _INDEX), "index"
    )
    # a partner must share `percent` % of the tokens
    cand = scratch.table(
        index.where("kind = 1")
        .groupBy("sig", "n")
        .agg(F.flatten(F.collect_list("toks")).alias("toks"), F.flatten(F.collect_list("dfs")).alias("dfs"))
        .where(F.size("toks") * 100 >= F.col("n") * percent),
        "candidates",
    )
    grouped = _grouped(cand, scratch)
    scratch.drop("candidates", "keyed")
    own = grouped.select("grp", F.lit(1).alias("side"), "sig", "n", "toks")
    inner = scratch.table(own.groupBy("grp").applyInArrow(_compare(percent), "a long, b long"), "inner")
    groups = components(inner, scratch, "groups")
    cross = scratch.table(_cross_links(grouped, groups, scratch, percent), "cross")
    label = grouped.join(groups, grouped["sig"] == groups["node"], "left").select(
        "sig", F.coalesce("component", "sig").alias("grp")
    )
    ends = cross.join(label.select(F.col("sig").alias("a"), F.col("grp").alias("ga")), "a").join(
        label.select(F.col("sig").alias("b"), F.col("grp").alias("gb")), "b"
    )
    joined = components(ends.select(F.col("ga").alias("a"), F.col("gb").alias("b")), scratch, "joined")
    named = label.join(joined, label["grp"] == joined["node"], "left").select(
        F.col("sig").alias("of"), F.coalesce("component", "grp").alias("root")
    )
    members = index.where("kind = 0").select("doc", "sig", "n")
    # sets with no candidate are their own root; every class has one row from here on
    classes = members.where("n > 0").groupBy("sig").agg(F.min("doc").alias("doc"))
    rooted = scratch.table(
        classes.join(named, classes["sig"] == named["of"], "left").select("sig", "doc", F.coalesce("root", "sig").alias("root")),
        "rooted",
    )
    least = scratch.table(rooted.groupBy("root").agg(F.min("doc").alias("component_id")), "least")
    by_class = scratch.table(rooted.join(least, "root").select(F.col("sig").alias("of"), "component_id"), "by-class")
    return members.join(by_class, (members["sig"] == by_class["of"]) & (members["n"] > 0), "left").select(
        F.col("doc").alias("doc_id"),
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc")).alias("component_id"),
    )


def _marked(docs: DataFrame, name: Column, rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``docs`` cut in two: those whose ``name`` is surely not in ``rows (row)``, and the rest.

    The rest holds all that is in ``rows``, and what shares a bit of a bitmap of
    bounded size with it: the more rows, the more of ``docs`` is in the rest.
    """
    rows = scratch.table(rows, "marked")
    maps = min(MOST_BITMAPS, 2 ** (rows.count() * BITS_A_ROW // BITMAP).bit_length())
    place = lambda c: F.pmod(c, F.lit(maps * BITMAP).cast("long"))
    at, bits = fresh(docs, "_at"), fresh(docs, "_bits")
    marks = rows.select(place(F.col("row")).alias("place")).groupBy(F.floor(F.col("place") / BITMAP).alias(at))
    marks = scratch.table(marks.agg(F.bitmap_construct_agg(F.col("place") % BITMAP).alias(bits)), "marks")
    here = place(name) % BITMAP
    byte = F.substr(F.col(bits), F.floor(here / 8).cast("int") + 1, F.lit(1))
    hit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (here % 8).cast("int"))
    looked = docs.join(F.broadcast(marks), F.floor(place(name) / BITMAP) == F.col(at), "left")
    found = F.coalesce(hit, F.lit(0)) == 1
    return looked.where(~found).drop(at, bits), looked.where(found).drop(at, bits)


def one_of_each_group(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """One row of every group of linked texts, that of the smallest id, with its own columns.

    Rows, not ids, are grouped: a row is named by a hash of its id and text, so
    a text of its own stays although its id repeats elsewhere, and of rows that
    repeat a group's smallest id one stays (the least hash).  Rows equal in id
    and text are one group like other copies.  Should two different rows share
    a hash, neither is removed.  Texts without shingles are linked with
    nothing and stay, repeated ones too.
    """
    id_col, text_col = options.pop("id_col", "doc_id"), options.pop("text_col", "text")
    name = F.xxhash64(F.lit("row"), F.col(id_col).isNull(), F.col(id_col), text_col)
    check = F.xxhash64(F.lit("check"), F.col(id_col).isNull(), F.col(id_col), text_col)
    rows = docs.select(name.alias("row"), F.col(id_col).cast("long").alias("doc"), check.alias("check"), F.col(text_col).alias("text"))
    found = jaccard_components(rows, scratch, id_col="row", text_col="text", **options)
    groups = found.where("n_shingles > 0").select(F.col("doc_id").alias("row"), F.col("component_id").alias("grp"))
    named = rows.groupBy("row").agg(
        F.min("doc").alias("doc"), (F.min("check") == F.max("check")).alias("sure"), F.count("*").alias("times")
    )
    members = scratch.table(groups.distinct().join(named, "row"), "members")
    order = F.struct(F.col("doc").isNull().alias("unnamed"), "doc", "row")
    best = members.groupBy("grp").agg(F.min(order)["row"].alias("best"))
    chosen = scratch.table(
        members.join(best, "grp").select("row", "sure", "times", (F.col("row") == F.col("best")).alias("stays")), "chosen"
    )
    # only what is removed or comes again meets a shuffle; the other texts are told apart by a bitmap
    removed = chosen.where(F.col("sure") & ~F.col("stays"))
    comes_again = chosen.where(F.col("sure") & F.col("stays") & (F.col("times") > 1))
    free, held = _marked(docs, name, removed.select("row").union(comes_again.select("row")), scratch)
    gone = fresh(docs, "_gone")
    left = held.join(removed.select(F.col("row").alias(gone)), name == F.col(gone), "left_anti")
    # rows that repeat a chosen row wholly: one of them stays
    again = comes_again.select(F.col("row").alias(gone))
    single = left.join(again, name == F.col(gone), "left_anti")
    rank = fresh(docs, "_rank")
    first = Window.partitionBy(name).orderBy(name)
    repeated = left.join(again, name == F.col(gone), "left_semi").withColumn(rank, F.row_number().over(first))
    return free.unionByName(single).unionByName(repeated.where(F.col(rank) == 1).drop(rank))
