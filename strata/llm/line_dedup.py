"""Exact line deduplication by range-partitioned line hashes.

One row per long-enough line, ``(hash, doc, position)``, is range-partitioned
on the whole row and sorted, so a line that fills a third of the table is
spread over many partitions.  Each partition is streamed once: the first
document of a hash owns it, every other document's line is marked.  Only the
first hash of a partition can have begun in an earlier one; its rows stay
pending until the owners of partition borders (two rows a partition) are known.
The result is a compressed keep bitmap per document, not text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.scratch import Scratch

WHITE = b" \t\n\x0b\x0c\r"
MIN_KEY = 10

_ROWS = "h1 long, h2 long, doc long, pos int, n_lines int, text_key long"
_MARKS = "kind byte, h1 long, h2 long, doc long, pos int, n_lines int, text_key long"


def _line_rows(min_key: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            digests, docs, positions, lengths, keys = [], [], [], [], []
            columns = (batch.column(0), batch.column(1).cast(pa.binary()), batch.column(2))
            for doc, text, text_key in zip(*(c.to_pylist() for c in columns)):
                lines = (text or b"").split(b"\n")
                for pos, line in enumerate(lines):
                    key = line.strip(WHITE)
                    if len(key) >= min_key and (len(key) >= 4 * min_key or len(key.decode()) >= min_key):
                        digests.append(digest(key.lower()))
                        docs.append(doc)
                        positions.append(pos)
                        lengths.append(len(lines))
                        keys.append(text_key)
            h = np.frombuffer(b"".join(digests), dtype=">i8").astype(np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h[:, 0]),
                    pa.array(h[:, 1]),
                    pa.array(docs, pa.int64()),
                    pa.array(positions, pa.int32()),
                    pa.array(lengths, pa.int32()),
                    pa.array(keys, pa.int64()),
                ],
                ["h1", "h2", "doc", "pos", "n_lines", "text_key"],
            )

    return run


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream sorted rows: kind 0 drop, 1 pending (first hash of the partition), 2 owner of the last hash."""
    last = None  # (h1, h2, owner) of the hash that the previous batch ended in
    in_first = True
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        h1, h2, doc, pos, lines, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
        new = np.ones(n, bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        goes_on = last is not None and h1[0] == last[0] and h2[0] == last[1]
        if last is not None and not goes_on:
            in_first = False
        starts = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        owner = doc[starts]
        if goes_on:
            owner = np.where(starts == 0, last[2], owner)
        pending = (starts == 0) if in_first else np.zeros(n, bool)
        out = np.flatnonzero(pending | (doc != owner))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(pending[out].astype(np.int8)),
                *(pa.array(x[out]) for x in (h1, h2, doc, pos, lines, keys)),
            ],
            ["kind", "h1", "h2", "doc", "pos", "n_lines", "text_key"],
        )
        last = (h1[-1], h2[-1], owner[-1])
        in_first = bool(pending[-1])
    if last is not None:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([2], pa.int8()),
                *(pa.array([int(x)], pa.int64()) for x in last),
                pa.array([0], pa.int32()),
                pa.array([0], pa.int32()),
                pa.array([0], pa.int64()),
            ],
            ["kind", "h1", "h2", "doc", "pos", "n_lines", "text_key"],
        )


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dropped, maps = [], []
        for n, positions in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            keep = np.ones(n, bool)
            keep[positions] = False
            dropped.append(n - int(keep.sum()))
            maps.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(dropped, pa.int64()), pa.array(maps, pa.binary()), batch.column(3)],
            ["doc", "n_lines", "n_dropped", "keep_bitmap", "text_key"],
        )


def keep_bitmap(blob: bytes | None, n_lines: int) -> np.ndarray:
    """One boolean per line; no bitmap, or a line past its end: kept."""
    keep = np.ones(n_lines, bool)
    if blob is not None:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(blob), np.uint8), bitorder="little")[:n_lines]
        keep[: len(bits)] = bits.astype(bool)
    return keep


def duplicate_line_bitmaps(
    docs: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text", min_key: int = MIN_KEY
) -> DataFrame:
    """Keep bitmaps ``(doc, n_lines, n_dropped, keep_bitmap, text_key)`` of the documents that lose lines.

    A line's key is the line without white space at its ends, ASCII-lower-cased.
    Keys of ``min_key`` code points or more that several documents hold lose
    all their lines but those of the smallest id.  ``keep_bitmap`` is a
    zlib-compressed little-endian bit per line, 1 for keep.

    Null or empty text: one empty line, never dropped.  A null id: takes no
    part.  Rows that repeat an id count as one holder of their keys, and each
    of their texts has a bitmap of its own (``text_key`` is the text's hash).
    Empty table: empty result.  Other columns are ignored.
    """
    rows = (
        docs.where(F.col(id_col).isNotNull())
        .select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_key"))
        .mapInArrow(_line_rows(min_key), _ROWS)
    )
    order = ["h1", "h2", "doc", "pos"]
    marks = scratch.table(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_marks, _MARKS), "marks"
    )
    owners = marks.where("kind > 0").groupBy("h1", "h2").agg(F.min("doc").alias("owner"))
    late = (
        marks.where("kind = 1")
        .join(F.broadcast(owners), ["h1", "h2"])  # two rows a partition at most
        .where("doc <> owner")
    )
    cols = ["doc", "pos", "n_lines", "text_key"]
    dropped = marks.where("kind = 0").select(cols).union(late.select(cols))
    return (
        dropped.groupBy("doc", "text_key")
        .agg(F.max("n_lines").alias("n_lines"), F.collect_set("pos").alias("positions"))
        .select("doc", "n_lines", "positions", "text_key")
        .mapInArrow(_bitmaps, "doc long, n_lines int, n_dropped long, keep_bitmap binary, text_key long")
    )


def apply_line_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, emit, schema: str, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Join the bitmaps to the documents; ``emit(ids, kept, n_lines)`` builds the output columns.

    ``kept`` holds, per document, the kept lines as UTF-8 bytes.
    """
    joined = (
        docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_key"))
        .join(bitmaps.select("doc", "text_key", "keep_bitmap"), ["doc", "text_key"], "left")
        .select("doc", "text", "keep_bitmap")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, counts = [], []
            for text, blob in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                lines = (text or b"").split(b"\n")
                counts.append(len(lines))
                if blob is not None:
                    keep = keep_bitmap(blob, len(lines))
                    lines = [line for line, k in zip(lines, keep.tolist()) if k]
                kept.append(lines)
            yield emit(batch.column(0), kept, counts)

    return joined.mapInArrow(run, schema)


def kept_text(docs: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` with the duplicate lines taken out."""

    def emit(ids, kept, counts):
        return pa.RecordBatch.from_arrays(
            [ids, pa.array([b"\n".join(x).decode() for x in kept], pa.string())], ["doc_id", "text"]
        )

    maps = duplicate_line_bitmaps(docs, scratch, id_col=id_col, text_col=text_col)
    return apply_line_bitmaps(docs, maps, emit, "doc_id long, text string", id_col=id_col, text_col=text_col)


def line_dedup_digest(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Per document: lines, dropped lines and the SHA-256 of the kept text."""
    import hashlib

    def emit(ids, kept, counts):
        return pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array(counts, pa.int64()),
                pa.array([n - len(x) for n, x in zip(counts, kept)], pa.int64()),
                pa.array([hashlib.sha256(b"\n".join(x)).hexdigest() for x in kept], pa.string()),
            ],
            ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        )

    maps = duplicate_line_bitmaps(docs, scratch)
    return apply_line_bitmaps(
        docs, maps, emit, "doc_id long, n_lines long, n_dropped long, kept_sha256 string"
    )
