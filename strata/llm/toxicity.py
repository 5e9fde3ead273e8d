"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

A bounded sample of the allowed labelled documents (parameter ``examples``) is
the index, each with every word it has.  A word weighs its inverse document
frequency, times a floor plus its correlation with the label beyond chance, so
that words which mark toxic examples lead and all others still count; the
vectors are log-scaled counts times these weights, scaled to length 1.  The
index is inverted, in blocks of examples, with the largest weight per term and
block: blocks are scored in order of their upper bound until no block can hold
a nearer example, so the neighbours are exact.  Votes weighted by distance are
calibrated by leave-one-out votes of the examples; the neighbours are returned
as evidence.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.scratch import Scratch, received, sent

EXAMPLES = 4_000
#: What a word weighs that has nothing to do with the label; a word's correlation with the label comes on top.
FLOOR = 0.02
#: Standard deviations of a correlation that are put down to chance.
CHANCE_Z = 3.0
#: By the leave-one-out votes of the examples: fewer than 15 leave rare toxic words enough of the vote.
NEIGHBOURS = 8
BLOCK = 64
#: Blocks that are scored before the bound is applied to the others.
FIRST_BLOCKS = 4
TOXIC_AT = 0.7
BINS = 20

_WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class Words:
    """Words of a text by their numbers; words that no example has are left out (they share nothing)."""

    def __init__(self, numbers: dict[str, int]):
        self.numbers = numbers

    def count(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        known = sorted((self.numbers[w], n) for w, n in Counter(words_of(text)).items() if w in self.numbers)
        both = np.array(known, np.int64).reshape(-1, 2)
        return both[:, 0], both[:, 1]


def term_weights(n0: np.ndarray, n1: np.ndarray, of0: int, of1: int) -> np.ndarray:
    """Weights of terms found in ``n0`` of ``of0`` clean and ``n1`` of ``of1`` toxic examples.

    One toxic example is taken off each count before the correlation, so that
    a term does not mark the only example that has it.
    """
    total, df = of0 + of1, n0 + n1
    share = df / total
    z = (np.maximum(n1 - 1, 0) / max(1, of1) - n0 / max(1, of0)) / np.sqrt(share * (1 - share) * (1 / max(1, of0) + 1 / max(1, of1)) + 1e-12)
    return np.log(1 + total / df) * (FLOOR + np.maximum(0, z - CHANCE_Z) / np.sqrt(total))


def _spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All places of the spans ``starts[i]..ends[i]``, one span after the other."""
    sizes = ends - starts
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class BlockMaxIndex:
    """Unit vectors of examples, inverted by blocks.

    ``cell`` is one term in one block: its largest weight, and where its postings start.
    """

    def __init__(self, weight: np.ndarray, examples: list[tuple[int, int, list[int], list[int]]], block: int = BLOCK):
        """``examples``: (id, label, terms, counts), none without terms."""
        self.weight, self.block = weight, block
        vectors = [self.vector(np.array(e[2], np.int64), np.array(e[3])) for e in examples]
        # examples with the same heaviest terms share blocks
        near = sorted(range(len(examples)), key=lambda k: ([examples[k][2][j] for j in np.argsort(-vectors[k], kind="stable")[:4]], examples[k][0]))
        examples, vectors = [examples[k] for k in near], [vectors[k] for k in near]
        self.ids = np.array([e[0] for e in examples], np.int64)
        self.labels = np.array([e[1] for e in examples], float)
        self.blocks = -(-len(examples) // block)
        rows = np.repeat(np.arange(len(examples)), [len(v) for v in vectors])
        cols = np.concatenate([np.array(e[2], np.int64) for e in examples]) if examples else np.empty(0, np.int64)
        vals = np.concatenate(vectors) if examples else np.empty(0)
        order = np.lexsort((rows, cols))
        rows, cols, vals = rows[order], cols[order], vals[order]
        self.rows, self.vals = rows, vals
        key = cols * max(1, self.blocks) + rows // block
        _, first = np.unique(key, return_index=True)
        self.cell_start = np.append(first, len(rows))
        self.cell_most = np.maximum.reduceat(vals, first) if len(first) else np.empty(0)
        self.cell_block = rows[first] // block
        self.start = np.searchsorted(cols[first], np.arange(len(weight) + 1))

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        w = (1 + np.log(counts)) * self.weight[terms]
        return w / np.sqrt(w @ w)

    def nearest(self, terms: np.ndarray, counts: np.ndarray, k: int, own: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the ``k`` nearest examples (ties: smaller id first), ``own`` left out."""
        query = self.vector(terms, counts)
        cells = _spans(self.start[terms], self.start[terms + 1])
        factor = np.repeat(query, self.start[terms + 1] - self.start[terms])
        bound = np.bincount(self.cell_block[cells], factor * self.cell_most[cells], self.blocks)
        order = np.argsort(-bound, kind="stable")
        rows, cosines = self.best(cells, factor, order[:FIRST_BLOCKS], k, own)
        # only blocks whose bound reaches the k-th best so far can hold a nearer example
        least = cosines[k - 1] - 1e-12 if len(cosines) >= k else 0.0
        more = order[FIRST_BLOCKS:]
        more = more[(bound[more] > 0) & (bound[more] >= least)]
        if len(more):
            late_rows, late = self.best(cells, factor, more, k, own)
            rows, cosines = np.concatenate([rows, late_rows]), np.concatenate([cosines, late])
            keep = np.lexsort((self.ids[rows], -np.round(cosines, 12)))[:k]
            rows, cosines = rows[keep], cosines[keep]
        return rows, cosines

    def best(self, cells: np.ndarray, factor: np.ndarray, blocks: np.ndarray, k: int, own: int | None):
        """The ``k`` nearest examples of some blocks."""
        wanted = np.zeros(self.blocks, bool)
        wanted[blocks] = True
        here = wanted[self.cell_block[cells]]
        cells, factor = cells[here], factor[here]
        start, end = self.cell_start[cells], self.cell_start[cells + 1]
        at = _spans(start, end)
        scores = np.bincount(self.rows[at], np.repeat(factor, end - start) * self.vals[at], len(self.ids))
        found = np.flatnonzero(scores)
        if own is not None:
            found = found[self.ids[found] != own]
        scores = np.round(scores[found], 12)
        if len(found) > k:
            good = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            found, scores = found[good], scores[good]
        keep = np.lexsort((self.ids[found], -scores))[:k]
        return found[keep], scores[keep]

    def vote(self, rows: np.ndarray, cosines: np.ndarray) -> float:
        w = 1 / (1.05 - np.minimum(cosines, 1.0))
        return float(w @ self.labels[rows] / w.sum())


def held_out(id_col: str) -> Column:
    """Whether a document is kept from learning: CRC-32 of its id as text leaves 1 by 3 (a null id: of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(3)) == 1


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by term and label, summed in the batch."""
    for batch in batches:
        sums: tuple[Counter, Counter] = (Counter(), Counter())
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sums[label].update(set(words_of(text)))
        terms = list(sums[0].keys() | sums[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), *(pa.array([s[t] for t in terms], pa.int64()) for s in sums)], ["term", "n0", "n1"]
        )


def _family(text: str | None) -> int:
    """Smallest hash of the three-word runs of a text: near copies mostly share it."""
    words = words_of(text)
    runs = {" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))}
    return min(map(xxhash.xxh3_64_intdigest, runs)) - 2**63


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        family = [_family(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(family, pa.int64()), batch.column(2), batch.column(1)], ["id", "family", "toxic", "text"])


def _calibration(pairs: list, prior: float) -> np.ndarray:
    """Rising probability per vote bin: pooled adjacent violators over smoothed bins."""
    n, y = np.zeros(BINS), np.zeros(BINS)
    for b, count, toxic in pairs:
        n[b] += count
        y[b] += toxic
    raw = (np.arange(BINS) + 0.5) / BINS
    pools = [[n[b] + 2.0, y[b] + 2.0 * raw[b], 1] for b in range(BINS)]  # two pseudo-votes at the bin's own value
    merged: list[list[float]] = []
    for pool in pools:
        merged.append(pool)
        while len(merged) > 1 and merged[-2][1] / merged[-2][0] > merged[-1][1] / merged[-1][0]:
            b = merged.pop()
            merged[-1] = [x + z for x, z in zip(merged[-1], b)]
    return np.array([p[1] / p[0] for p in merged for _ in range(int(p[2]))])


class Model:
    """What a task needs to score texts; its size is bounded by the examples' words."""

    def __init__(self, numbers: dict[str, int], index: BlockMaxIndex, prior: float):
        self.words, self.index, self.prior = Words(numbers), index, prior
        self.curve, self.blank = None, prior
        self.answers: dict = {}

    def raw(self, terms: np.ndarray, counts: np.ndarray, own: int | None = None) -> tuple[float | None, np.ndarray, np.ndarray]:
        none = np.empty(0, np.int64), np.empty(0)
        if not len(terms):
            return (None, *none)
        rows, cosines = self.index.nearest(terms, counts, NEIGHBOURS, own)
        if not len(rows):
            return (None, *none)
        return self.index.vote(rows, cosines), rows, cosines

    def answer(self, text: str | None) -> tuple[float | None, np.ndarray, np.ndarray]:
        """``raw`` of a text, remembered by its hash: many texts are copies."""
        key = xxhash.xxh3_128_digest((text or "").encode("utf-8", "surrogatepass"))
        if key not in self.answers:
            if len(self.answers) >= 50_000:
                self.answers.clear()
            self.answers[key] = self.raw(*self.words.count(text))
        return self.answers[key]

    def score(self, raw: float | None) -> float:
        return self.blank if raw is None else float(self.curve[min(int(raw * BINS), BINS - 1)])


def train(
    docs: DataFrame, labels: DataFrame, scratch: Scratch, *, id_col: str, text_col: str, label_col: str, examples: int
) -> Model | None:
    spark = docs.sparkSession
    known = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max(label_col).cast("int").alias("toxic"))
    )
    known = scratch.table(known, "known")
    n = known.count()
    share = min(1.0, examples / max(1, n))
    chosen = known.where(F.pmod(F.xxhash64(F.lit(8), "id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    texts = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(F.broadcast(chosen), "id")  # about `examples` rows
        .select("id", "text", "toxic")
    )
    # one example of each family of near copies, so that a copied document does not make its words count
    sample = scratch.table(
        texts.mapInArrow(_families, "id long, family long, toxic int, text string")
        .groupBy("family", "toxic")
        .agg(F.min(F.struct("id", "text")).alias("x"))
        .select("x.id", "x.text", "toxic"),
        "sample",
    )
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    if not n0 + n1:
        return None
    found = (
        sample.select("text", "toxic")
        .mapInArrow(_term_counts, "term string, n0 long, n1 long")
        .groupBy("term")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .orderBy("term")
        .toArrow()  # the words of about `examples` texts
    )
    numbers = {t: k for k, t in enumerate(found.column("term").to_pylist())}
    weight = term_weights(found.column("n0").to_numpy(), found.column("n1").to_numpy(), n0, n1)
    box = sent(spark, numbers)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(received(box))
        for batch in batches:
            found = [words.count(t) for t in batch.column(1).to_pylist()]
            lists = [pa.array([x[k] for x in found], pa.list_(pa.int64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *lists], ["id", "toxic", "terms", "counts"])

    held = scratch.table(sample.mapInArrow(vectors, "id long, toxic int, terms array<long>, counts array<long>"), "vectors")
    kept = held.where(F.size("terms") > 0).toArrow().to_pylist()  # about `examples` rows
    index = BlockMaxIndex(weight, [(r["id"], r["toxic"], r["terms"], r["counts"]) for r in kept])
    model = Model(numbers, index, n1 / (n0 + n1))
    model_box = sent(spark, model)

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = received(model_box)
        for batch in batches:
            bins = []
            for i, t, c in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                raw = m.raw(np.array(t, np.int64), np.array(c, np.int64), own=i)[0]
                bins.append(-1 if raw is None else min(int(raw * BINS), BINS - 1))
            yield pa.RecordBatch.from_arrays([pa.array(bins, pa.int32()), batch.column(1)], ["bin", "toxic"])

    pairs = (
        held.mapInArrow(left_out, "bin int, toxic int").groupBy("bin").agg(F.count("*").alias("n"), F.sum("toxic").alias("y")).collect()
    )
    model.curve = _calibration([(r["bin"], r["n"], r["y"]) for r in pairs if r["bin"] >= 0], model.prior)
    blank = [(r["n"], r["y"]) for r in pairs if r["bin"] < 0]
    model.blank = (sum(y for _, y in blank) + model.prior) / (sum(k for k, _ in blank) + 1)
    return model


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    scratch: Scratch,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    examples: int = EXAMPLES,
    toxic_at: float = TOXIC_AT,
) -> DataFrame:
    """``(doc_id, held_out, score, predicted, evidence, similarity)`` for every row.

    Only labelled rows that are not held out are learnt from.  A text that
    shares no word with any example (null and empty ones too) has no evidence
    and gets the share of toxic examples among such texts.  Without any usable label every score is 0.5.  A label
    row with a null id or a label other than 0 and 1 is ignored; of several
    labels of one id the largest counts.  Null ids and repeated rows pass row
    by row; empty table: empty result.
    """
    model = train(docs, labels, scratch, id_col=id_col, text_col=text_col, label_col=label_col, examples=examples)
    box = sent(docs.sparkSession, model)  # bounded by the words of `examples` texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = received(box)
        for batch in batches:
            scores, evidence, similarity = [], [], []
            for text in batch.column(2).to_pylist():
                raw, rows, cosines = m.answer(text) if m else (None, [], [])
                scores.append(m.score(raw) if m else 0.5)
                evidence.append(m.index.ids[rows].tolist() if m and len(rows) else [])
                similarity.append([float(c) for c in cosines])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= toxic_at) for s in scores], pa.int32()),
                    pa.array(evidence, pa.list_(pa.int64())),
                    pa.array(similarity, pa.list_(pa.float64())),
                ],
                ["doc_id", "held_out", "score", "predicted", "evidence", "similarity"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int, evidence array<long>, similarity array<double>"
    )
