"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document.
Votes are counted by pattern over all documents; expectation-maximisation on
the pattern counts estimates each labeller's accuracy, and the posterior of a
document's pattern is its soft label.  A hashed linear scorer is trained on
the soft labels of a bounded sample (parameter ``train_rows``) by logistic
regression in the partitions, averaged over them, and scores every document.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.scratch import Scratch

DIM = 1 << 12
TRAIN_ROWS = 20_000
FIT_PARTS = 6
KEEP_AT = 0.5
#: Assumed bound: a labeller votes bad on this share of the good documents at most.
FALSE_ALARMS = 0.01
#: Fewer words than this leave the ratios too coarse for a vote.
ENOUGH_WORDS = 8

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))
_MARKS = bytes(b for b in range(33, 127) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
_STOPS = b".,;:!?"
_PLAIN = re.compile(rb"[Aa]+[.,;:!?]?")
#: Letters (and all bytes of other scripts) to a, capitals to A, digits to 0.
_SHAPE = bytes(
    ord("a") if 97 <= b <= 122 or b >= 128 else ord("A") if 65 <= b <= 90 else ord("0") if 48 <= b <= 57 else b for b in range(256)
)


class Shapes(dict):
    """Word shape to (plain, hash); forgets when it holds ``most`` shapes."""

    most = 100_000

    def __missing__(self, shape: bytes) -> tuple[bool, int]:
        if len(self) >= self.most:
            self.clear()
        value = self[shape] = (_PLAIN.fullmatch(shape) is not None, xxhash.xxh3_64_intdigest(shape[:24]) % DIM)
        return value


def _share(part: int, whole: int) -> float:
    return part / whole if whole else 0.0


def _shapes(text: bytes) -> list[bytes]:
    """The shapes of the words: kinds of characters, runs of letters, capitals and digits as one."""
    text = text.translate(_SHAPE)
    for kind in (b"a", b"A", b"0"):
        while kind * 2 in text:
            text = text.replace(kind * 2, kind)
    return text.split()


def profile(text: bytes, shapes: Shapes) -> tuple[dict[str, float], Counter]:
    """Ratios of a text and the counts of its hashed word shapes."""
    cut = lambda drop: len(text) - len(text.translate(None, drop))
    found = Counter(_shapes(text))
    n = sum(found.values())
    words = text.lower().translate(None, _STOPS).split()
    counts = Counter(words)
    lines = text.split(b"\n")
    upper, lower = cut(_UPPER), cut(_LOWER)
    hashed: Counter = Counter()
    plain = 0
    for shape, c in found.items():
        is_plain, h = shapes[shape]
        plain += c * is_plain
        hashed[h] += c
    return {
        "words": n,
        "marks": _share(cut(_MARKS), len(text)),
        "digits": _share(cut(_DIGITS), len(text)),
        "upper": _share(upper, upper + lower),
        "distinct": _share(len(counts), len(words)),
        "top": _share(max(counts.values(), default=0), n),
        "again": _share(sum(map(eq, words, words[1:])), n),
        "plain": _share(plain, n),
        "pipes": _share(text.count(b"|"), n),
        "length": _share(len(text), n),
        "lines": _share(len(set(lines)), len(lines)),
    }, hashed


#: (ratio, good below or above, bad beyond): a labeller votes bad past the second bound, good within the first.
LABELLERS = (
    ("marks", 0.05, 0.10),
    ("upper", 0.10, 0.30),
    ("again", 0.05, 0.20),
    ("top", 0.16, 0.30),
    ("pipes", 0.02, 0.15),
    ("digits", 0.05, 0.40),
    ("plain", 0.90, 0.66),
    ("distinct", 0.40, 0.20),
    ("lines", 0.80, 0.50),
)


def votes(ratios: dict[str, float]) -> list[int]:
    """One vote a labeller: 1 good, 2 bad, 0 none."""
    if ratios["words"] < ENOUGH_WORDS:
        return [0] * len(LABELLERS)
    out = []
    for name, good, bad in LABELLERS:
        x = ratios[name] if good < bad else -ratios[name]
        out.append(1 if x <= (good if good < bad else -good) else 2 if x >= (bad if good < bad else -bad) else 0)
    return out


def pattern_of(vote: list[int]) -> int:
    return int("".join(map(str, vote)), 3)


def vote_of(pattern: int) -> list[int]:
    out = []
    for _ in LABELLERS:
        out.append(pattern % 3)
        pattern //= 3
    return out[::-1]


def estimate(patterns: dict[int, int], rounds: int = 100) -> dict[int, float]:
    """Posterior of good per vote pattern, by expectation-maximisation of the labellers' accuracies.

    A labeller that gives no vote says nothing: it adds no likelihood.
    """
    if not patterns:
        return {}
    keys = sorted(patterns)
    v = np.array([vote_of(k) for k in keys])
    n = np.array([patterns[k] for k in keys], float)
    hot = np.stack([v == 1, v == 2], axis=2).astype(float)  # pattern, labeller, vote
    good, bad = hot[:, :, 0].sum(1), hot[:, :, 1].sum(1)
    post = (good + 2) / (good + 3 * bad + 3)  # a bad vote is the rarer and surer kind
    for _ in range(rounds):
        w1, w0 = n * post, n * (1 - post)
        prior = (w1.sum() + 1) / (n.sum() + 2)
        p1 = np.einsum("p,plv->lv", w1, hot) + [2.0, 0.1]
        p0 = np.einsum("p,plv->lv", w0, hot) + [0.5, 0.5]
        p1, p0 = p1 / p1.sum(axis=1, keepdims=True), p0 / p0.sum(axis=1, keepdims=True)
        false = np.minimum(p1[:, 1], FALSE_ALARMS)
        p1 = np.stack([1 - false, false], axis=1)
        odds = np.log(prior / (1 - prior)) + np.einsum("plv,lv->p", hot, np.log(p1) - np.log(p0))
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return dict(zip(keys, post.tolist()))


def features(ratios: dict[str, float], shapes: Counter) -> tuple[list[int], list[float]]:
    """Hashed features: buckets of the ratios, and word shapes by their share."""
    found: dict[int, float] = {0: 1.0}
    short = ratios["words"] < ENOUGH_WORDS
    for name, value in ratios.items():
        if name == "words":
            bucket = min(int(value), ENOUGH_WORDS)
        elif short:
            continue
        else:
            bucket = int(min(value, 3.0) * 20) if name != "length" else int(min(value, 40.0))
        found[xxhash.xxh3_64_intdigest(f"{name}={bucket}") % DIM] = 1.0
    total = sum(shapes.values())
    if not short:
        for h, c in shapes.items():
            found[h] = found.get(h, 0.0) + c / total
    return list(found), list(found.values())


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shapes, counts = Shapes(), Counter()
    for batch in batches:
        for text in batch.column(0).cast(pa.binary()).to_pylist():
            counts[pattern_of(votes(profile(text or b"", shapes)[0]))] += 1
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], ["pattern", "n"]
    )


def _examples(posterior: dict[int, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = Shapes()
        for batch in batches:
            idx, val, y = [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                ratios, shape = profile(text or b"", shapes)
                i, x = features(ratios, shape)
                idx.append(i)
                val.append(x)
                y.append(posterior[pattern_of(votes(ratios))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(idx, pa.list_(pa.int32())), pa.array(val, pa.list_(pa.float64())), pa.array(y, pa.float64())],
                ["r", "idx", "val", "y"],
            )

    return run


def _fit(rows: pa.Table) -> pa.Table:
    """Logistic regression on one part of the sample (full-batch AdaGrad)."""
    rows = rows.sort_by("r")
    y = rows["y"].to_numpy()
    x = np.zeros((len(y), DIM), np.float32)
    for k, (i, v) in enumerate(zip(rows["idx"].to_pylist(), rows["val"].to_pylist())):
        x[k, i] = v
    w, seen = np.zeros(DIM), np.full(DIM, 1e-8)
    for _ in range(150):
        p = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32), -30, 30)))
        g = (x.T @ (p - y).astype(np.float32)).astype(float) / len(y) + 1e-5 * w
        seen += g * g
        w -= 0.5 * g / np.sqrt(seen)
    return pa.table({"w": pa.array([w.tobytes()], pa.binary()), "n": pa.array([len(y)], pa.int64())})


def train(docs: DataFrame, scratch: Scratch, *, text_col: str = "text", train_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, dict[int, float]]:
    """Weights of the scorer and the posterior by vote pattern."""
    text = docs.select(F.col(text_col).alias("text"))
    counted = text.mapInArrow(_patterns, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    patterns = {r["pattern"]: r["n"] for r in counted}  # 3 ** labellers rows at most
    posterior = estimate(patterns)
    total = sum(patterns.values())
    if not total:
        return np.zeros(DIM), {}
    share = min(1.0, train_rows / total)
    r = F.xxhash64(F.lit(5), "text")
    sample = text.select(r.alias("r"), "text").where(F.pmod("r", F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    examples = scratch.table(
        sample.mapInArrow(_examples(posterior), "r long, idx array<int>, val array<double>, y double"), "examples"
    )
    # equal texts share a hash: they are one example, so a large group of copies is one too
    parts = examples.groupBy("r").agg(F.min(F.struct("idx", "val", "y")).alias("x")).select("r", "x.*")
    fitted = parts.groupBy(F.pmod(F.shiftright("r", 20), F.lit(FIT_PARTS)).alias("part")).applyInArrow(_fit, "w binary, n long").collect()
    rows = sum(f["n"] for f in fitted)
    return sum((np.frombuffer(f["w"]) * (f["n"] / rows) for f in fitted), np.zeros(DIM)), posterior


def quality_scores(
    docs: DataFrame,
    scratch: Scratch,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_at: float = KEEP_AT,
    train_rows: int = TRAIN_ROWS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``(doc_id, score, weak, keep)`` and the ``carry`` columns, for every row.

    ``score`` is the scorer's probability of good, ``weak`` the posterior of
    the labellers' votes; ``keep`` when the score reaches ``keep_at``.  Null
    text is scored as empty; texts of few words get no votes, so the prior.
    Null ids and repeated rows pass row by row; empty table: empty result.
    """
    weights, posterior = train(docs, scratch, text_col=text_col, train_rows=train_rows)
    model = docs.sparkSession.sparkContext.broadcast((weights, posterior))  # DIM weights, 3 ** labellers posteriors at most
    extra = [f for f in docs.schema.fields if f.name in carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, post = model.value
        shapes = Shapes()
        for batch in batches:
            scores, weak = [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                ratios, shape = profile(text or b"", shapes)
                i, x = features(ratios, shape)
                z = float(w[i] @ np.array(x))
                scores.append(1 / (1 + np.exp(-max(-30.0, min(30.0, z)))))
                weak.append(post.get(pattern_of(votes(ratios)), 0.5))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(weak, pa.float64()), pa.array([s >= keep_at for s in scores])]
                + [batch.column(2 + k) for k in range(len(extra))],
                ["doc_id", "score", "weak", "keep", *[f"x_{f.name}" for f in extra]],
            )

    schema = "doc_id long, score double, weak double, keep boolean" + "".join(
        f", `x_{f.name}` {f.dataType.simpleString()}" for f in extra
    )
    scored = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *[F.col(f.name).alias(f"x_{f.name}") for f in extra]
    ).mapInArrow(run, schema)
    return scored


def accepted(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with their own columns."""
    scored = quality_scores(docs, scratch, carry=tuple(docs.columns), **options)
    return scored.where("keep").select(*[F.col(f"x_{c}").alias(c) for c in docs.columns])
