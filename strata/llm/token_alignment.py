"""Alignment of two tokenizers' tokens by merge path.

Both tokenizers cut the same bytes (a space and the text) into tokens.  The
ends of A's and of B's tokens are two sorted lists, and merging them meets
every overlapping pair of tokens once.  The merge is cut where its diagonals
``i + j = k * STEP`` cross the merge path, found by binary search, so every
piece takes ``STEP`` ends whatever the texts look like, and all pieces of a
batch of documents advance together.  A piece emits its overlaps and counts the
ends that A and B share; the running sum of these counts over the pieces
numbers the groups, which stitches groups that cross piece borders.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.scratch import Scratch
from strata.llm.token_count import _unit_bytes, tokenizer_path

#: Ends that a piece merges.
STEP = 256
#: Bytes of text tokenized and merged at once; a longer text is a batch of its own.
BATCH_BYTES = 1_000_000
#: Most frequent id pairs that are sent to every task; the other pairs are joined by a shuffle.
HOT_PAIRS = 100_000
#: The faster library runs out of stack in longer runs of white space; such texts go to the other one.
LONGEST_SPACE = 2_000
_END = np.iinfo(np.int64).max
ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
    "a_ids array<int>, b_ids array<int>, times array<int>"
)


def crossings(ends_a: np.ndarray, ends_b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many ends of A come before each diagonal of the merge (equal ends: A first)."""
    low = np.maximum(0, diagonals - len(ends_b))
    high = np.minimum(diagonals, len(ends_a))
    while True:
        open_ = low < high
        if not open_.any():
            return low
        mid = (low + high) // 2
        other = np.clip(diagonals - 1 - mid, 0, max(len(ends_b) - 1, 0))
        before = open_ & (ends_a[np.minimum(mid, len(ends_a) - 1)] <= ends_b[other])
        low = np.where(before, mid + 1, low)
        high = np.where(open_ & ~before, mid, high)


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(a, b, group)`` of every overlapping pair of tokens, in text order.

    ``ends_a`` and ``ends_b`` are rising byte ends of the two token lists over
    the same bytes.  A step of the merge takes the next end; the tokens that
    it falls into overlap, unless the end is B's and A's equal end came just
    before.
    """
    total = len(ends_a) + len(ends_b)
    if not total:
        return (np.empty(0, np.int64),) * 3
    diagonals = np.arange(0, total, step, dtype=np.int64)
    i = crossings(ends_a, ends_b, diagonals)
    j = diagonals - i
    a, b = np.append(ends_a, _END), np.append(ends_b, _END)
    before = np.append(-1, ends_a)  # before[i]: the end of A's token i - 1
    rows = min(step, total)
    at_a, at_b = np.empty((rows, len(i)), np.int64), np.empty((rows, len(i)), np.int64)
    emits, closes = np.empty((rows, len(i)), bool), np.empty((rows, len(i)), bool)
    for k in range(rows):
        end_a, end_b = a[i], b[j]
        take_a = (end_a <= end_b) & (end_a < _END)
        take_b = ~take_a & (end_b < _END)
        at_a[k], at_b[k] = i, j
        emits[k] = take_a | (take_b & (before[i] != end_b))
        closes[k] = take_a & (end_a == end_b)
        i, j = i + take_a, j + take_b
    emitted = emits.T
    shared = closes.T & emitted
    # stitched: groups closed in earlier pieces, then inside the piece before this overlap
    earlier = np.cumsum(shared.sum(axis=1)) - shared.sum(axis=1)
    group = earlier[:, None] + np.cumsum(shared, axis=1) - shared
    return at_a.T[emitted], at_b.T[emitted], group[emitted]


class Pair:
    """The two tokenizers and their tables; one per task."""

    def __init__(self, path_a: str, path_ranks: str | None, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        units = _unit_bytes()
        self.slow = Tokenizer.from_file(path_a)
        self.slow.encode_special_tokens = True
        vocab = self.slow.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for word, k in vocab.items():
            # a special token is in the vocabulary under its own name, which no text is encoded to
            self.a_bytes[k] = bytes(units[c] for c in word) if all(c in units for c in word) else b""
        self.fast = self._fast(path_ranks)
        self.long_space = re.compile(rf"\s{{{LONGEST_SPACE}}}").search
        self.settled: set[str] = set(map(chr, range(128)))
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode()
            for k, p in enumerate(pieces)
        ]
        self.a_sizes = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], np.int64)
        n_a, n_b = len(self.a_bytes), len(self.b_bytes)
        names = [*(f"{k}," for k in range(n_a)), *(f"{k}|" for k in range(n_a))]
        names += [*(f"{k}," for k in range(n_b)), *(f"{k};" for k in range(n_b)), *map(str, range(n_b))]
        self.names = names

    def _fast(self, path: str | None):
        """The same vocabulary in a faster library, if a rank file is given and proves to be the same."""
        if path is None:
            return None
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        if any(self.a_bytes[k] != token for token, k in ranks.items() if k < len(self.a_bytes)):
            return None
        return tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary

    def is_settled(self, text: str) -> bool:
        """Whether all characters have had one class since Unicode 3.2, so that both libraries class them alike.

        False, too, for texts with runs of white space that the faster library cannot take.
        """
        if len(text) > LONGEST_SPACE and self.long_space(text):
            return False
        if text.isascii():
            return True
        new = set(text) - self.settled
        old = unicodedata.ucd_3_2_0.category
        self.settled.update(c for c in new if old(c) == unicodedata.category(c) != "Cn")
        return new <= self.settled

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and B for every text; both empty where the joined bytes are not a space and the text."""
        spaced = [" " + t for t in texts]
        fast = self.fast
        a = [fast(t) if fast and self.is_settled(t) else None for t in spaced]
        slow = [k for k, ids in enumerate(a) if ids is None]
        for k, e in zip(slow, self.slow.encode_batch_fast([spaced[k] for k in slow], add_special_tokens=False)):
            a[k] = e.ids
        b = self.b.encode(texts, num_threads=1)
        for k, text in enumerate(spaced):
            data = text.encode()
            same = texts[k] and all(
                b"".join(map(table.__getitem__, ids)) == data
                for table, ids in ((self.a_bytes, a[k]), (self.b_bytes, b[k]))
            )
            if not same:
                a[k], b[k] = [], []
        return a, b

    def align(self, doc_ids: list, texts: list[str], step: int = STEP) -> pa.RecordBatch:
        ids_a, ids_b = self.encode(texts)
        n_docs = len(texts)
        n_a = np.array([len(x) for x in ids_a], np.int64)
        n_b = np.array([len(x) for x in ids_b], np.int64)
        flat = lambda lists, n: np.fromiter(chain.from_iterable(lists), np.int64, int(n.sum()))
        a, b = flat(ids_a, n_a), flat(ids_b, n_b)
        at_a, at_b, group = overlaps(np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b]), step)
        doc_a = np.repeat(np.arange(n_docs), n_a)
        doc = doc_a[at_a]
        n_links = np.bincount(doc, minlength=n_docs)
        # groups as text: A ids of a group, then its B ids
        group_a, group_b = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
        group_a[at_a], group_b[at_b] = group, group
        n_groups = np.bincount(doc_a[np.flatnonzero(np.diff(group_a, prepend=-1))], minlength=n_docs)
        count = int(group_a[-1]) + 1 if len(a) else 0
        size_a, size_b = np.bincount(group_a, minlength=count), np.bincount(group_b, minlength=count)
        last_a = np.append(group_a[1:] != group_a[:-1], True)[: len(a)]
        last_b = np.append(group_b[1:] != group_b[:-1], True)[: len(b)].astype(np.int64)
        ends = np.cumsum(n_b)[n_b > 0] - 1
        last_b[ends] = 2
        names = np.empty(len(a) + len(b), np.int64)
        base = len(self.a_bytes)
        names[np.arange(len(a)) + (np.cumsum(size_b) - size_b)[group_a]] = a + base * last_a
        names[np.arange(len(b)) + np.cumsum(size_a)[group_b]] = b + 2 * base + len(self.b_bytes) * last_b
        text_of, names = self.names.__getitem__, names.tolist()
        upto = np.cumsum(n_a + n_b).tolist()
        groups = ["".join(map(text_of, names[lo:hi])) for lo, hi in zip([0, *upto], upto)]
        # linked id pairs of a document with their number
        n_ids = len(self.b_bytes)
        key = np.sort((doc * base + a[at_a]) * n_ids + b[at_b])
        first = np.flatnonzero(np.diff(key, prepend=-1))
        times = np.diff(np.append(first, len(key)))
        key = key[first]
        offsets = pa.array(np.searchsorted(key, np.arange(n_docs + 1) * base * n_ids), pa.int32())
        lists = lambda values: pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(doc_ids, pa.int64()),
                *(pa.array(n, pa.int64()) for n in (n_a, n_b, n_groups, n_links)),
                pa.array(groups, pa.string()),
                lists(key // n_ids % base),
                lists(key % n_ids),
                lists(times),
            ],
            [c.split()[0] for c in ALIGNED.split(", ")],
        )


def _align_batches(
    paths: tuple[str, str | None, str], batches: Iterator[pa.RecordBatch], size: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    pair = Pair(*paths)
    for batch in batches:
        ids, texts, held = [], [], 0
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(doc_id)
            texts.append(text or "")
            held += len(texts[-1]) + 100
            if held >= size:
                yield pair.align(ids, texts)
                ids, texts, held = [], [], 0
        if ids:
            yield pair.align(ids, texts)


def align_tokens(
    docs: DataFrame,
    *,
    path_a: str | None = None,
    path_ranks: str | None = "",
    path_b: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Groups and links of A's and B's tokens for every row, without a shuffle.

    ``(doc_id, n_a, n_b, n_groups, n_links, groups, a_ids, b_ids, times)``:
    ``groups`` is ``a1,a2|b1;a3|b2,b3`` (ids of A and B, groups in text order);
    ``a_ids``, ``b_ids`` and ``times`` list the linked id pairs of the document
    and how many links hold them.  A is a byte-level BPE of the ``tokenizers``
    library, B a ``sentencepiece`` model; ``path_ranks`` names A's vocabulary
    as a rank file for a faster library (None: not used), which is used for
    texts that both libraries are known to split alike.  The paths must be
    open to the executors.  Special tokens inside texts are plain text.  Null
    and empty texts, and texts whose joined tokens of A or B are not the bytes
    of a space and the text, have no tokens: zeros, empty lists and groups.
    Null ids and repeated rows pass row by row; empty table: empty result.
    """
    paths = (
        path_a or tokenizer_path(),
        tokenizer_path("byte_bpe_50k.tiktoken") if path_ranks == "" else path_ranks,
        path_b or tokenizer_path("piece_bpe_32k.model"),
    )
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        partial(_align_batches, paths), ALIGNED
    )


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(a_id, b_id, n, best)``: links of an id pair in all documents, and whether that is its B id's highest."""
    links = exploded(aligned)
    counts = links.groupBy("a_id", "b_id").agg(F.sum("k").alias("n"))
    most = counts.groupBy("b_id").agg(F.max("n").alias("most"))  # as many rows as B has ids
    return counts.join(F.broadcast(most), "b_id").select("a_id", "b_id", "n", (F.col("n") == F.col("most")).alias("best"))


def exploded(aligned: DataFrame, *keys: str) -> DataFrame:
    zipped = F.explode(F.arrays_zip("a_ids", "b_ids", "times")).alias("x")
    return aligned.select(*keys, zipped).select(
        *keys, F.col("x.a_ids").alias("a_id"), F.col("x.b_ids").alias("b_id"), F.col("x.times").cast("long").alias("k")
    )


def alignment_digest(docs: DataFrame, scratch: Scratch, **options: str | None) -> DataFrame:
    """Per document its tokens, groups and links, and how common its links are in all documents.

    ``n_best``: links whose id pair has its B id's highest number of links
    corpus-wide (ties included); ``count_sum``: these numbers summed over the
    links; ``groups_sha256``: digest of the groups, empty without tokens.  Rows
    are counted by a key of their own, so ids may be null or repeat.

    The ``HOT_PAIRS`` most frequent pairs, which hold most links, are sent to
    the documents' lists; only links of the other pairs are shuffled, so a pair
    that every document holds meets no single task.
    """
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    aligned = align_tokens(docs, **options).withColumn("groups", digest)
    table = scratch.table(aligned.withColumn("_key", F.monotonically_increasing_id()), "aligned")
    counts = scratch.table(pair_counts(table), "counts")
    hot = scratch.table(counts.orderBy(F.desc("n"), "a_id", "b_id").limit(HOT_PAIRS), "hot")
    links = exploded(table, "_key")
    sums = (
        F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("n_best"),
        F.sum(F.col("k") * F.col("n")).alias("count_sum"),
    )
    common = links.join(F.broadcast(hot), ["a_id", "b_id"]).groupBy("_key").agg(*sums)
    others = links.join(F.broadcast(hot.select("a_id", "b_id")), ["a_id", "b_id"], "left_anti")
    rare = others.join(counts.join(hot, ["a_id", "b_id"], "left_anti"), ["a_id", "b_id"]).groupBy("_key").agg(*sums)
    both = common.unionByName(rare).groupBy("_key").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return table.join(both, "_key", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"),
        F.col("groups").alias("groups_sha256"),
    )
