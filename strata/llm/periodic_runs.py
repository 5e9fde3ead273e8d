"""Runs of periodic words in texts by maximal-pair enumeration.

A run is a stretch of consecutive words with smallest period ``q`` that no
neighbouring word extends.  Its words ``s .. e-1`` are one maximal pair: the
phrase of ``e - s - q`` words at ``s`` comes again at ``s + q``, and neither
the words before nor the words after the two places are equal.  So runs are
read off the repeated phrases of a document without any extension step:

* suffixes of word numbers are sorted by prefix doubling, for a whole batch of
  documents at once; only suffixes whose first ``least_repeat`` words come
  twice in their document can belong to a run and are sorted further;
* their LCP-interval tree is visited bottom-up (borders by falling LCP, the
  smaller interval into the larger).  An interval keeps its places by class of
  the word on their left; a place is paired with places of other classes and
  of other children only, within the distances that the length rule allows;
* of pairs with equal start and end the least distance is the smallest period
  (larger ones are its multiples).
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words handled at once; a longer text is a batch of its own.
BATCH_WORDS = 200_000
_MUL = np.uint64(0x9E3779B97F4A7C15)
RESULT = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class Interval:
    """Places of an LCP interval: in order, and by class of the word on their left."""

    __slots__ = ("classes", "places")

    def __init__(self, place: int, left: int):
        self.places = [place]
        self.classes = {left: [place]}

    def absorb(self, other: Interval) -> None:
        for left, places in other.classes.items():
            mine = self.classes.get(left)
            if mine is None:
                self.classes[left] = places
            else:
                for place in places:
                    insort(mine, place)
        for place in other.places:
            insort(self.places, place)

    def partners(self, low: int, high: int, left: int, lefts: list[int]) -> Iterator[int]:
        """Places from ``low`` to ``high`` whose left word is another one.

        Walks the places or the classes, whichever are fewer.  Places nearer
        than half their phrase are periodic and repeat one class, and distinct
        classes need distinct phrases, so the fewer are O(sqrt(words)).
        """
        a, b = bisect_left(self.places, low), bisect_right(self.places, high)
        if b - a <= len(self.classes):
            for place in self.places[a:b]:
                if lefts[place] != left:
                    yield place
        else:
            for kind, places in self.classes.items():
                if kind != left:
                    yield from places[bisect_left(places, low) : bisect_right(places, high)]


def maximal_pairs(order: list[int], lcp: list[int], lefts: list[int], least: int, times: int) -> dict:
    """``{(start, end): least distance}`` of maximal pairs at least ``least`` words and ``times`` distances long.

    ``order`` holds suffixes in order, ``lcp[k]`` the common words of suffixes
    ``k - 1`` and ``k`` (0 where a new tree begins), ``lefts`` the word before
    every place.  A pair at distance ``q`` with ``n`` common words spans
    ``n + q`` words, so ``q <= n / (times - 1)`` and ``q >= least - n``.
    """
    found: dict[tuple[int, int], int] = {}
    first = list(range(len(order)))  # of the interval that ends at a rank: its first rank
    last = list(range(len(order)))  # of the interval that starts at a rank: its last rank
    at: dict[int, Interval] = {}  # by first rank
    borders = [k for k in range(1, len(order)) if lcp[k] > 0]
    borders.sort(key=lcp.__getitem__, reverse=True)
    for k in borders:
        common = lcp[k]
        a, z = first[k - 1], last[k]
        one = at.pop(a, None) or Interval(order[a], lefts[order[a]])
        two = at.pop(k, None) or Interval(order[k], lefts[order[k]])
        if len(one.places) < len(two.places):
            one, two = two, one
        near, far = max(1, least - common), common // (times - 1)
        if near <= far:
            for left, places in two.classes.items():
                for x in places:
                    for y in one.partners(x + near, x + far, left, lefts):
                        key = (x, y + common)
                        found[key] = min(found.get(key, y - x), y - x)
                    for y in one.partners(x - far, x - near, left, lefts):
                        key = (y, x + common)
                        found[key] = min(found.get(key, x - y), x - y)
        one.absorb(two)
        at[a] = one
        first[z], last[a] = a, z
    return found


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Dense ranks from 1 on."""
    return np.unique(keys, return_inverse=True)[1].astype(np.int64) + 1


def repeated_suffixes(words: np.ndarray, doc: np.ndarray, least_repeat: int):
    """Suffixes that share ``least_repeat`` words with another of their document: ``(order, lcp)``.

    ``words`` are word numbers of several documents in a row and ``doc`` the
    document of each.  Ranks of 1, 2, 4 … words are kept: a suffix alone in
    its rank is done, and common words are summed up from the kept ranks.
    """
    n = len(words)
    levels = [_ranks(doc * (int(words.max()) + 1) + words)]
    size, live = 1, np.arange(n)
    while True:
        rank = levels[-1]
        ahead = np.minimum(live + size, n - 1)
        second = np.where((live + size < n) & (doc[ahead] == doc[live]), rank[ahead], 0)
        fresh = rank.copy()
        if len(live) == n:
            fresh = _ranks(rank * (n + 1) + second)
        else:
            # ranks stay those of first places: members of a rank are renumbered inside its own gap
            by = np.lexsort((second, rank[live]))
            r, s = rank[live][by], second[by]
            new_rank = np.r_[True, r[1:] != r[:-1]]
            new_pair = new_rank | np.r_[True, s[1:] != s[:-1]]
            place = np.arange(len(by))
            start = np.maximum.accumulate(np.where(new_rank, place, 0))
            pair = np.maximum.accumulate(np.where(new_pair, place, 0))
            fresh[live[by]] = r + pair - start
        if len(live) == n:
            # from here on a rank is the number of smaller suffixes, which leaves room for its members
            counts = np.bincount(fresh)
            fresh = (np.cumsum(counts) - counts)[fresh] + 1
        levels.append(fresh)
        size *= 2
        counts = np.bincount(fresh, minlength=n + 2)
        live = np.flatnonzero(counts[fresh] > 1)
        if size <= least_repeat:
            suffixes = live
        if len(live) == 0:
            break
    if least_repeat & (least_repeat - 1):
        raise ValueError("least_repeat must be a power of two")
    if not len(suffixes):
        return suffixes, suffixes
    order = suffixes[np.argsort(levels[-1][suffixes], kind="stable")]
    a, b = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(len(order), np.int64)
    same = doc[a] == doc[b]
    for level in range(len(levels) - 1, -1, -1):
        step, rank = 1 << level, levels[level]
        inside = same & (a < n) & (b < n)
        ia, ib = np.minimum(a, n - 1), np.minimum(b, n - 1)
        equal = inside & (rank[ia] == rank[ib]) & (doc[ia] == doc[order[:-1]]) & (doc[ib] == doc[order[1:]])
        a, b = a + step * equal, b + step * equal
        lcp[1:] += step * equal
    lcp[lcp < least_repeat] = 0
    return order, lcp


def _may_repeat(words: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    """Documents in which the hash of some ``size`` words comes twice (a hash clash only adds documents)."""
    with np.errstate(over="ignore"):
        h = words.astype(np.uint64) * _MUL
        step = 1
        while step < size:
            h = (h[:-step] ^ (h[:-step] >> np.uint64(29))) * _MUL + h[step:]
            step *= 2
    inside = doc[: len(h)] == doc[size - 1 :]
    h, d = h[inside], doc[: len(inside)][inside]
    with np.errstate(over="ignore"):
        h = h ^ (d.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    by = np.argsort(h, kind="stable")
    h = h[by]
    return np.unique(d[by[1:][h[1:] == h[:-1]]])


def runs_of(texts: list[list[int]], least: int = 24, times: int = 3) -> list[list[tuple[int, int, int]]]:
    """Runs ``(start, length, period)`` of every sequence of word numbers, by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    # a run of n words and period q has a phrase of n - q >= (1 - 1 / times) * least words twice
    phrase, least_repeat = least - least // times, 1
    while 2 * least_repeat <= phrase:
        least_repeat *= 2
    sizes = np.array([len(t) for t in texts], np.int64)
    if sizes.sum() < least:
        return out
    words = np.concatenate([np.asarray(t, np.int64) for t in texts])
    doc = np.repeat(np.arange(len(texts)), sizes)
    some = _may_repeat(words, doc, least_repeat) if len(words) >= least_repeat else np.empty(0, np.int64)
    if not len(some):
        return out
    inside = np.isin(doc, some)
    words, doc = words[inside], doc[inside]
    order, lcp = repeated_suffixes(words, doc, least_repeat)
    begins = np.r_[True, doc[1:] != doc[:-1]]
    lefts = np.where(begins, -1, np.r_[-1, words[:-1]])
    offset = np.maximum.accumulate(np.where(begins, np.arange(len(words)), 0))
    found = maximal_pairs(order.tolist(), lcp.tolist(), lefts.tolist(), least, times)
    for (start, end), q in found.items():
        out[int(doc[start])].append((int(start - offset[start]), int(end - start), int(q)))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside runs and of each run's first period, one space apart."""
    kept, upto = [], 0
    for a, b in sorted((s + q, s + n) for s, n, q in runs):
        kept += words[upto:a]
        upto = max(upto, b)
    return b" ".join(kept + words[upto:])


def periodic_runs(
    docs: DataFrame, *, least: int = 24, times: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` for every row, without a shuffle.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, numbered from 0.
    ``runs`` holds ``(start, length, period)`` of every run of at least
    ``least`` words and ``times`` periods, by start, then period; runs may
    overlap.  ``collapsed`` is the text without the words that any run holds
    after its first period, one space between words.  Null or empty text: no
    words, no runs, empty ``collapsed``.  Null ids, repeated rows and other
    columns do not matter; rows stay rows.  Empty table: empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(ids: list, parts: list[list[bytes]], numbers: list[list[int]]) -> pa.RecordBatch:
            runs = runs_of(numbers, least, times)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(w) for w in parts], pa.int64()),
                    pa.array(
                        [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs],
                        pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])),
                    ),
                    pa.array([collapsed(w, r).decode() for w, r in zip(parts, runs)], pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

        for batch in batches:
            ids: list = []
            parts: list[list[bytes]] = []
            numbers: list[list[int]] = []
            held, number = 0, {}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = (text or b"").split()  # bytes split at the six ASCII white spaces
                ids.append(doc_id)
                parts.append(words)
                numbers.append([number.setdefault(w, len(number)) for w in words])
                held += len(words)
                if held >= BATCH_WORDS:
                    yield done(ids, parts, numbers)
                    ids, parts, numbers, held, number = [], [], [], 0, {}
            if ids:
                yield done(ids, parts, numbers)

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")
    ).mapInArrow(run, f"doc_id long, {RESULT}")


def with_planted_periods(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` where one text in ten is made periodic from some word on.

    With ``h = crc32(decimal doc_id)`` and ``g = floor(h / 10)``, a text of
    ``n > 0`` words with ``h % 10 = 0`` gets words ``a + (i - a) % p`` from
    ``a = g % n`` on, ``p = 1 + floor((n - a) / (3 + g % 8))``.  Other texts,
    null texts and rows with a null id stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all(text_col, F.lit(r"([^\x20\x09-\x0D]+)"), 1))
    n, g, a, p = F.array_size("_words"), F.col("_g"), F.col("_a"), F.col("_p")

    def word(i: Column) -> Column:
        return F.get("_words", F.when(i < a, i).otherwise(a + (i - a) % p))

    some = docs.select(id_col, text_col).withColumns({"_words": words, "_g": F.floor(h / 10)})
    some = some.withColumn("_a", F.when(n > 0, g % n).cast("int"))
    some = some.withColumn("_p", (1 + F.floor((n - a) / (3 + g % 8))).cast("int"))
    made = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), word), " ")
    return some.select(id_col, F.when(n > 0, made).otherwise(F.col(text_col)).alias(text_col))


def runs_digest(docs: DataFrame, **columns: str) -> DataFrame:
    """Per document of :func:`periodic_runs`: number, strongest run, and digests of runs and collapsed text."""
    found = periodic_runs(docs, **columns)
    # least of (-exponent, start, period): exponents as exact fractions over a common multiple compare as a / b < c / d
    best = F.reduce(
        "runs",
        F.lit(None).cast("struct<start: long, length: long, period: long>"),
        lambda x, r: F.when(
            x.isNull()
            | (r["length"] * x["period"] > x["length"] * r["period"]),  # ties keep the earlier: runs are in order
            r,
        ).otherwise(x),
    )
    lines = F.array_join(
        F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), ""
    )
    top = F.col("top")
    return found.withColumn("top", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        top["start"].alias("start"),
        top["length"].alias("length"),
        top["period"].alias("period"),
        F.floor(1000 * top["length"] / top["period"]).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )
