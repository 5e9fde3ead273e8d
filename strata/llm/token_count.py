"""Token counts of a byte-level BPE with a whole-token shortcut.

A text is split into pre-tokens.  Vocabulary strings that are proved, by the
tokenizer itself, to be one pre-token and to encode alone as one token are
counted by a table lookup; only other pre-tokens are merged by the tokenizer.
Characters that the two Unicode tables at hand class differently are found by
asking the tokenizer; a text that holds one is left to the tokenizer whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the published pre-token pattern of this vocabulary.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Merged pre-tokens remembered by a task; beyond it the memory starts anew.
REMEMBERED = 500_000
#: Longer pre-tokens are merged each time they are met.
LONGEST_REMEMBERED = 64


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _unit_bytes() -> dict[str, int]:
    """Printable stand-ins of a byte-level vocabulary: byte values that print as themselves, others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def whole_tokens(path: str) -> list[str]:
    """Vocabulary strings that are one pre-token and encode alone as one token."""
    import regex
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    pattern, units = regex.compile(PRE_TOKEN), _unit_bytes()
    found = []
    for word in tokenizer.get_vocab(with_added_tokens=False):
        try:
            text = bytes(units[c] for c in word).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if pattern.fullmatch(text):
            found.append(text)
    encoded = tokenizer.encode_batch(found, add_special_tokens=False)
    return sorted(t for t, e in zip(found, encoded) if len(e.ids) == 1)


class Counter:
    """Counts tokens of texts; one per task."""

    def __init__(self, path: str, whole: list[str]):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.split = regex.compile(PRE_TOKEN).findall
        self.whole = dict.fromkeys(whole, 1)
        self.known = dict(self.whole)
        self.agreed: set[str] = set()
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None

    def merged(self, pieces: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def agrees(self, char: str) -> bool:
        """Whether our pattern and the tokenizer split ``char`` alike among letters, digits, spaces and marks."""
        probe = f"a{char}1{char} {char}{char}  ."
        spans = [span for _, span in self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)]
        return self.split(probe) == [probe[a:b] for a, b in spans]

    def count(self, text: str) -> int:
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(map(self.plain, parts))
        return self.plain(text)

    def plain(self, text: str) -> int:
        if not text.isascii():
            new = set(text) - self.agreed
            self.agreed.update(filter(self.agrees, new))
            if not new <= self.agreed:
                return self.merged([text])[0]
        pieces = self.split(text)
        known = self.known
        if len(known) > len(self.whole) + REMEMBERED:
            known = self.known = dict(self.whole)
        new = set(pieces).difference(known)
        if not new:
            return sum(map(known.__getitem__, pieces))
        new = list(new)
        counts = dict(zip(new, self.merged(new)))
        total = sum(known[p] if p in known else counts[p] for p in pieces)
        known.update((p, n) for p, n in counts.items() if len(p) <= LONGEST_REMEMBERED)
        return total


def token_counts(
    docs: DataFrame, *, path: str | None = None, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row, without a shuffle.

    ``path`` names a byte-level BPE file that the executors can open.  Null
    text counts as empty: no bytes, no tokens.  Strings of special tokens
    inside a text are special tokens, as the library has it by default.  Null
    ids and repeated rows pass through row by row; empty table: empty result.
    """
    path = path or tokenizer_path()
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counter = Counter(path, whole.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = [counter.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
