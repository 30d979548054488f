"""Token counts under a unigram vocabulary, with one dynamic program shared by all words with a prefix.

A text's pre-tokens are its words, each with the word mark in front. The distinct pre-tokens of a batch form a trie; the
best score of a prefix (the sum of log probabilities of its best split into pieces) depends on the prefix alone, so it is
computed once per trie node and all words below it start from there. Walking the words in sorted order visits the trie
depth first, so only the path to the current word is held. The count and score of each word are kept at its end.

Pieces and their order come from a public vocabulary file; a piece's probability follows Zipf's law on its rank there.
A character that is no piece costs its bytes, each as rare as the rarest piece.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from modelmon.llm.common import WORD, fixed

MARK = "▁"
# Zipf: probability in proportion to 1 / (rank + SHIFT).
SHIFT = 2.7
# Different words whose counts a Python worker remembers; the memory is emptied when full.
REMEMBERED = 700_000
_worker: dict = {}


def log_probabilities(path: str) -> dict[str, float]:
    """The pieces of a vocabulary file with their log probabilities, special and byte pieces left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    total = math.log(sum(1 / (r + SHIFT) for r in range(len(pieces))))
    return {p: -math.log(r + SHIFT) - total for r, p in enumerate(pieces)}


def score_words(words: Iterable[str], pieces: dict[str, float], longest: int | None = None) -> Iterator[tuple[str, int, float]]:
    """(word, pieces of its best split, score) for distinct words, in sorted order. Equal scores: fewer pieces."""
    longest = longest or max(map(len, pieces), default=1)
    rarest = min(pieces.values(), default=0.0)
    before = ""
    # By length of the prefix: best score, pieces of that split.
    scores, counts = [0.0], [0]
    for word in sorted(words):
        marked = MARK + word
        shared, most = 0, min(len(before), len(marked))
        while shared < most and before[shared] == marked[shared]:
            shared += 1
        del scores[shared + 1 :], counts[shared + 1 :]
        for end in range(shared + 1, len(marked) + 1):
            best, n = -math.inf, 0
            for start in range(max(0, end - longest), end):
                piece = pieces.get(marked[start:end])
                if piece is not None:
                    score = scores[start] + piece
                    if score > best or score == best and counts[start] + 1 < n:
                        best, n = score, counts[start] + 1
            if best == -math.inf or marked[end - 1] not in pieces:
                size = len(marked[end - 1].encode())
                score = scores[end - 1] + size * rarest
                if score > best:
                    best, n = score, counts[end - 1] + size
            scores.append(best)
            counts.append(n)
        before = marked
        yield word, counts[-1], scores[-1]


class Counter:
    """Counts per text, remembering the words seen."""

    def __init__(self, path: str) -> None:
        self.pieces = log_probabilities(path)
        self.longest = max(map(len, self.pieces))
        self.known: dict[str, tuple[int, float]] = {}

    def __call__(self, texts: list[str | None]) -> list[tuple[int, int, float]]:
        if len(self.known) > REMEMBERED:
            self.known = {}
        # Printable ASCII has no white space but the space.
        split = [t.split() if t.isascii() and t.isprintable() else WORD.findall(t) for t in (t or "" for t in texts)]
        new = set().union(*split).difference(self.known)
        self.known.update((w, (n, s)) for w, n, s in score_words(new, self.pieces, self.longest))
        out = []
        for words in split:
            found = [self.known[w] for w in words]
            out.append((len(words), sum(n for n, _ in found), math.fsum(s for _, s in found)))
        return out


def token_counts(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens, log_probability) per row of ``docs`` (doc_id, text).

    Null, empty and blank texts have no pre-tokens and no tokens. Repeated rows come out repeated, an empty table gives an
    empty one, further columns are ignored. Nothing is shuffled: a word costs each Python worker one walk.
    """
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _worker.get("path") != vocabulary_path:
            _worker.update(path=vocabulary_path, counter=Counter(vocabulary_path))
        for batch in batches:
            rows = _worker["counter"](batch.column("text").to_pylist())
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array([round(s, 6) for s in columns[2]], pa.float64())],
                names=["doc_id", "n_pretokens", "n_tokens", "log_probability"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return fixed(source.mapInArrow(run, f"doc_id {kind}, n_pretokens long, n_tokens long, log_probability double"), "counts")
