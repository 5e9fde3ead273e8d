"""Shards of equal row counts that keep equal texts together.

Documents with equal texts are linked.  Every document starts with the shard
of a hash as its label.  Balanced label propagation then moves linked documents:
each round joins them to the present labels of their neighbours and asks for
the shard that holds most of them; a shard admits as many rows as its quota
leaves free and its own leavers of the same round make free, so full shards
swap.  Which shards are full is found anew every round, and quotas are a
``SLACK``-th wider until the last.  Groups that are then apart or above a quota
go in a line into the room left in any shard, so only a group at the end of a
shard is cut; unlinked documents fill every shard to its quota
exactly.  Groups of more than a ``LARGE``-th of a shard are planned before, one
by one.  Copies with one label (and, in a large group, one salt) are one cell,
since nothing tells them apart; joins and sums are over cells, so a group that
holds a third of all rows is many cells.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.scratch import Scratch

SHARDS = 16
#: Most rounds; they end when no group is apart.  What is apart after the last goes in the line.
ROUNDS = 8
#: Groups of more than a shard's rows by this are planned one by one.
LARGE = 32
SALTS = 64
#: Turns in which the askers of a shard are admitted, in a round and at the end.
TURNS = 64
LAST_TURNS = 1024
#: During the rounds a shard may hold its quota and this part of it more; without it full shards could not swap.
SLACK = 16
RANK_ROWS = 500
#: Buckets whose counts are summed up in one task.
SPAN = 4_096


def _firsts(counts: DataFrame, by: list[str]) -> DataFrame:
    """``(by, _b, _first)``: the sum of ``_n`` over the lower buckets ``_b``, ``SPAN`` buckets a task and then their sums."""
    put = counts.withColumn("_s", F.floor(F.col("_b") / SPAN).cast("long"))
    spans = put.groupBy(*by, "_s").agg(F.sum("_n").alias("_sn"))
    before = spans.select(*by, "_s", (F.sum("_sn").over(Window.partitionBy(*by).orderBy("_s")) - F.col("_sn")).alias("_before"))
    inside = F.sum("_n").over(Window.partitionBy(*by, "_s").orderBy("_b")) - F.col("_n")
    return put.withColumn("_inside", inside).join(before, [*by, "_s"]).select(*by, "_b", (F.col("_before") + F.col("_inside")).alias("_first"))


def _ranked(df: DataFrame, by: list[str], n: int, alias: str) -> DataFrame:
    """``df`` with a gapless rank from 0 within ``by``, in an order given by the row hash ``r``.

    Rows are numbered within hash buckets of about ``RANK_ROWS`` rows; running
    sums of the bucket counts give each bucket's first rank.
    """
    buckets = max(1, -(-n // RANK_ROWS))
    put = df.withColumn("_b", F.pmod("r", F.lit(buckets)))
    counts = put.groupBy(*by, "_b").agg(F.count("*").alias("_n"))
    firsts = _firsts(counts, by)
    inner = Window.partitionBy(*by, "_b").orderBy("r", "doc_id")
    return (
        put.withColumn("_k", F.row_number().over(inner) - 1)
        .join(firsts, [*by, "_b"])
        .withColumn(alias, F.col("_first") + F.col("_k"))
        .drop("_b", "_k", "_first")
    )


def _lookup(values: list[int], key: Column) -> Column:
    """``values[key]`` for a short list, one value a shard."""
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), key.cast("int") + 1)


def _plan_groups(groups: list[tuple[str, int, list[int]]], room: list[int]) -> tuple[dict[str, int], list[tuple[str, list[tuple[int, int]]]]]:
    """Groups ``(gid, rows, copies per shard)`` put into shards, largest first; takes their rows off ``room``.

    A group goes to the shard with most of its copies among those that hold it
    whole.  Where none does, it fills the emptiest and the rest goes on.
    Returns the shards of whole groups, and the ``(rows, shard)`` pieces of the others.
    """
    whole: dict[str, int] = {}
    cut: list[tuple[str, list[tuple[int, int]]]] = []
    for gid, total, votes in sorted(groups, key=lambda g: (-g[1], g[0])):
        pieces, rest = [], total
        while rest:
            fits = [s for s, x in enumerate(room) if x >= rest]
            if fits:
                s = max(fits, key=lambda s: (votes[s], -s))
            else:
                s = max(range(len(room)), key=lambda s: (room[s], votes[s], -s))
            take = min(rest, room[s])
            room[s] -= take
            rest -= take
            pieces.append((take, s))
        if len(pieces) == 1:
            whole[gid] = pieces[0][1]
        else:
            cut.append((gid, pieces))
    return whole, cut


def _admitted(asked: dict[tuple[int, int, int], int], room: list[int], turns: int) -> list[int]:
    """For each shard the first turn that it does not admit; ``asked`` holds rows by (from, to, turn).

    A shard takes what its room and its own leavers of the same round allow.
    All are admitted at first; a shard with too many takes fewer turns, which
    keeps some leavers of others in place, until every shard can hold its rows.
    """
    shards = range(len(room))
    upto = {(a, b): [0] * (turns + 1) for a in shards for b in shards}  # rows from a to b before a turn
    for (a, b, t), n in asked.items():
        upto[a, b][t + 1] += n
    for sums in upto.values():
        for t in range(turns):
            sums[t + 1] += sums[t]
    ends = [turns] * len(room)
    while True:
        leave = [sum(upto[s, to][ends[to]] for to in shards) for s in shards]
        fewer = []
        for s in shards:
            e = ends[s]
            while e and sum(upto[a, s][e] for a in shards) > max(0, room[s] + leave[s]):
                e -= 1
            fewer.append(e)
        if fewer == ends:
            return ends
        ends = fewer


def _asked(apart: DataFrame, full: set[int], k: int) -> DataFrame:
    """Round ``k``: every cell ``(gid, n, shard)`` with the shard ``to`` that it asks for, its ``turn`` and the number of ``places`` of its group.

    Cells are joined to the labels of their neighbours.  Shards that turned
    askers down in the round before come last; then most neighbours, then a hash.
    """
    labels = apart.groupBy("gid", "shard").agg(F.sum("n").alias("v"))
    open_ = ~F.col("shard").isin(*full) if full else F.lit(True)
    tie = F.xxhash64("gid", "shard", F.lit(k))
    best = F.max(F.struct(open_.alias("open"), F.col("v"), tie.alias("tie"), F.col("shard").alias("to")))
    wish = labels.groupBy("gid").agg(best["to"].alias("to"), F.count("*").alias("places"))
    turn = F.pmod(F.xxhash64("gid", F.lit(k)), F.lit(TURNS)).cast("int")
    return apart.select("gid", "n", "shard").join(wish, "gid").withColumn("turn", turn)


def _propagate(cells: DataFrame, room: list[int], scratch: Scratch, rounds: int) -> DataFrame:
    """Groups ``(gid, total, shard)`` of the cells ``(gid, n, shard)``; the shard is null where a group is apart or found no room.

    ``room`` holds the rows that each shard may take of these groups; takes the rows of groups with a shard off it.
    """
    here = scratch.table(cells, "apart-0")
    held = {r["shard"]: r["n"] for r in here.groupBy("shard").agg(F.sum("n").alias("n")).collect()}  # a row a shard
    left = [x + x // SLACK - held.get(s, 0) for s, x in enumerate(room)]
    full = {s for s, x in enumerate(left) if x < 0}
    whole = []
    for k in range(rounds):
        state = scratch.table(_asked(here, full, k), f"asked-{k}")
        whole.append(state.where("places = 1").select("gid", "n", "shard"))
        apart = state.where("places > 1")
        moves = apart.where("shard <> to").groupBy("shard", "to", "turn").agg(F.sum("n").alias("n"))
        asked = {(r["shard"], r["to"], r["turn"]): r["n"] for r in moves.collect()}  # shards x shards x TURNS rows at most
        if not asked:
            here = apart.select("gid", "n", "shard")
            break
        ends = _admitted(asked, left, TURNS)
        full = {s for s, x in enumerate(left) if x < 0}
        for (a, b, t), n in asked.items():
            if t < ends[b]:
                left[a] += n
                left[b] -= n
            else:
                full.add(b)
        here = apart.select("gid", "n", F.when(F.col("turn") < _lookup(ends, F.col("to")), F.col("to")).otherwise(F.col("shard")).alias("shard"))
    for part in whole:
        here = here.unionByName(part)
    one = F.min("shard") == F.max("shard")
    groups = here.groupBy("gid").agg(F.sum("n").alias("total"), F.when(one, F.min("shard")).alias("shard"))
    groups = scratch.table(groups.withColumn("turn", F.pmod(F.xxhash64("gid"), F.lit(LAST_TURNS)).cast("int")), "propagated")
    # now the quotas hold strictly: of a shard with too many rows, the groups of the last turns go in the line
    sums = groups.where("shard is not null").groupBy("shard", "turn").agg(F.sum("total").alias("n"))
    ends = [LAST_TURNS] * len(room)
    for r in sorted(sums.collect(), key=lambda r: (r["shard"], r["turn"])):  # shards x LAST_TURNS rows at most
        s = r["shard"]
        if r["turn"] < ends[s]:
            if r["n"] <= room[s]:
                room[s] -= r["n"]
            else:
                ends[s] = r["turn"]
    stays = F.col("turn") < _lookup(ends, F.coalesce("shard", F.lit(0)))
    return groups.select("gid", "total", F.when(stays, F.col("shard")).alias("shard"))


def _offsets(groups: DataFrame, n: int) -> DataFrame:
    """``(gid, first)``: running sums of ``total`` over the groups, ``n`` rows in all."""
    put = groups.withColumn("_b", F.pmod(F.xxhash64("gid"), F.lit(max(1, -(-n // RANK_ROWS)))))
    sums = put.groupBy("_b").agg(F.sum("total").alias("_n"))
    firsts = _firsts(sums, [])
    upto = F.sum("total").over(Window.partitionBy("_b").orderBy("gid"))
    return (
        put.withColumn("_k", upto - F.col("total")).join(firsts, "_b").select("gid", (F.col("_first") + F.col("_k")).alias("first"))
    )


def _listed(scratch: Scratch, rows: list[dict], schema: str) -> DataFrame:
    """A short list as a table; ``gid`` is hex in the list."""
    listed = F.from_json(F.lit(json.dumps(rows)), f"array<struct<gid:string,{schema}>>")
    return scratch.spark.range(1).select(F.inline(listed)).withColumn("gid", F.unhex("gid"))


def balanced_shards(
    docs: DataFrame,
    scratch: Scratch,
    *,
    shards: int = SHARDS,
    rounds: int = ROUNDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` and the ``carry`` columns, for every row.

    Law ``rows``: the counts of the shards differ by one at most.  Rows of
    equal texts share a shard unless the group is larger than the room in a
    shard; then the rest goes on to the next.  Of the groups of a shard's rows
    by ``LARGE`` or less, fewer than ``shards`` are cut.  Size is the UTF-8 bytes of the
    text plus 1.  Null text equals the empty text.  Null ids and repeated rows
    are rows like others, told apart by their place in the input, so which of
    them has which slot follows from how the input is split.  Empty table: empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.md5(text)
    # written once with the rows, so all later steps see the same number
    nth = F.monotonically_increasing_id()
    rows = scratch.table(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(key).alias("gid"),
            F.pmod(F.xxhash64(F.lit(1), F.col(id_col), nth), F.lit(shards)).cast("int").alias("start"),
            F.pmod(F.xxhash64(F.lit(2), F.col(id_col), nth), F.lit(SALTS)).cast("int").alias("salt"),
            F.xxhash64(F.lit(3), F.col(id_col), key, nth).alias("r"),
            *carry,
        ),
        "rows",
    )
    n = rows.count()
    quotas = [n // shards + (s < n % shards) for s in range(shards)]
    cells = scratch.table(rows.groupBy("gid", "start", "salt").agg(F.count("*").alias("n")), "all-cells")
    copies = [F.sum(F.when(F.col("start") == s, F.col("n")).otherwise(0)) for s in range(shards)]
    groups = scratch.table(
        cells.groupBy("gid").agg(F.sum("n").alias("total"), F.array(*copies).alias("votes")).where("total > 1"), "groups"
    )
    room = list(quotas)
    large = F.col("total") * LARGE > min(quotas)  # 2 x LARGE x shards groups at most
    listed = groups.where(large).select(F.hex("gid").alias("gid"), "total", "votes").collect()
    whole, cut = _plan_groups([(r["gid"], r["total"], list(r["votes"])) for r in listed], room)
    of_small = cells.join(groups.where(~large).select("gid"), "gid").groupBy("gid", F.col("start").alias("shard")).agg(F.sum("n").alias("n"))
    small = _propagate(of_small, room, scratch, rounds)
    left = small.where("shard is null")
    n_left = left.agg(F.sum("total")).first()[0] or 0
    # groups that are cut, then small groups that no shard with copies took, in a line; (end, shard) pieces of it
    starts, pieces, at = [], [], 0
    for gid, parts in cut:
        starts.append({"gid": gid, "first": at})
        for take, s in parts:
            at += take
            pieces.append((at, s))
    line = _offsets(left, n_left).withColumn("first", F.col("first") + at)
    for s, x in enumerate(room):
        take = min(x, n_left)
        if take:
            at, n_left, room[s] = at + take, n_left - take, x - take
            pieces.append((at, s))

    def piece(of: Column) -> Column:
        return sum((F.when(of >= F.lit(e), 1).otherwise(0) for e, _ in pieces), F.lit(0))

    def piece_shard(of: Column) -> Column:
        return _lookup([s for _, s in pieces] or [0], piece(of)).cast("int")

    places = scratch.table(
        small.where("shard is not null")
        .select("gid", "shard", F.lit(None).cast("long").alias("first"))
        .unionByName(_listed(scratch, [{"gid": g, "shard": s} for g, s in whole.items()], "shard:int").withColumn("first", F.lit(None).cast("long")))
        .unionByName(line.unionByName(_listed(scratch, starts, "first:bigint")).withColumn("shard", F.lit(None).cast("int"))),
        "places",
    )
    settled = cells.join(places.where("shard is not null").drop("first"), "gid").withColumn("first", F.lit(None).cast("long"))
    upto = F.sum("n").over(Window.partitionBy("gid").orderBy("start", "salt"))
    in_line = cells.join(places.where("shard is null").drop("shard"), "gid").withColumn("first", F.col("first") + upto - F.col("n"))
    one = piece(F.col("first")) == piece(F.col("first") + F.col("n") - 1)
    in_line = in_line.withColumn("shard", F.when(one, piece_shard(F.col("first"))))
    state = settled.unionByName(in_line).select("gid", "start", "salt", "shard", "first")
    placed = scratch.table(rows.join(state, ["gid", "start", "salt"], "left"), "placed")
    # cells across the end of a piece, a few: row by row
    nth = F.row_number().over(Window.partitionBy("gid", "start", "salt").orderBy("r", "doc_id")) - 1
    across = placed.where("shard is null and first is not null").withColumn("shard", piece_shard(F.col("first") + nth))
    kept = [q - x for q, x in zip(quotas, room)]
    linked = placed.where("shard is not null").unionByName(across).drop("gid", "start", "salt", "first")
    own = _ranked(scratch.table(linked, "linked"), ["shard"], max(kept), "slot")
    unlinked = placed.where("shard is null and first is null").drop("gid", "start", "salt", "first", "shard")
    free = _ranked(unlinked, [], n, "_f")
    ends, total = [], 0
    for q, x in zip(quotas, kept):
        total += q - x
        ends.append(total)
    firsts = [0, *ends[:-1]]
    # the shard whose interval of free ranks holds the row
    shard = sum((F.when(F.col("_f") >= F.lit(e), 1).otherwise(0) for e in ends), F.lit(0))
    filled = free.withColumn("shard", shard.cast("int")).withColumn(
        "slot", F.col("_f") - _lookup(firsts, F.col("shard")) + _lookup(kept, F.col("shard"))
    )
    return own.unionByName(filled.drop("_f")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        *carry,
    )
