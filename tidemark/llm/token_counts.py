"""Token counts under a unigram tokenizer by dynamic programming over a shared trie.

A text's pre-tokens are its words (split at ASCII white space), each with the word mark
in front. Of all ways to cut a pre-token into vocabulary pieces the one with the largest sum of
scores counts; at equal sums the one with fewer pieces. A character that no piece covers becomes its UTF-8
bytes, one token each.

The distinct pre-tokens of a batch are inserted in a trie. A node keeps the best score and
piece count of the prefix that it stands for, computed once for all pre-tokens below it
from the nodes above it; terminal nodes give the counts. The trie is walked depth first: in sorted
order, each pre-token shares with the one before the nodes up to their common prefix,
so only the path to the current node is held. Results of earlier batches of a task are
kept in a table of at most ``MAX_KNOWN`` pre-tokens, which is emptied when full.

Only texts are read, nothing is shuffled: a document is counted in the task that reads it, and
a task's memory is bounded by its batch and that table. The vocabulary (tens of
thousands of pieces, read from the tokenizer's file by the driver) is sent with the tasks.

Edge cases: a null or empty text has no tokens. Repeated rows are each counted. With no rows the
result is empty. Other columns pass through; those with the name of an added one are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Words, append_columns

WORD_MARK = "▁"
MAX_KNOWN = 400_000
#: What a byte token scores below the least likely piece.
BYTE_PENALTY = 10.0


@dataclass
class Vocabulary:
    """Log-probability of each piece, and that of one byte token."""

    scores: dict[str, float]
    byte: float


def load_vocabulary(path: str) -> Vocabulary:
    """Pieces of a sentencepiece model. Its order is a frequency order; a piece of rank r gets
    the log of Zipf's probability, 1 / (r * H(V))."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        sp.id_to_piece(i) for i in range(sp.get_piece_size())
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))
    ]
    norm = math.log(sum(1 / r for r in range(1, len(pieces) + 1)))
    scores = {p: -math.log(r) - norm for r, p in enumerate(pieces, 1)}
    return Vocabulary(scores, min(scores.values()) - BYTE_PENALTY)


class TrieCounter:
    """Piece counts and scores of words, with shared prefixes computed once."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        #: every ending of a piece: a cut may only go on leftwards through these
        self.endings = {p[i:] for p in vocabulary.scores for i in range(len(p))}
        self.nodes = 0

    def count(self, words: list[str]) -> dict[str, tuple[int, float]]:
        """(tokens, log score) of each distinct word."""
        scores, endings, byte = self.v.scores, self.endings, self.v.byte
        found: dict[str, tuple[int, float]] = {}
        best, pieces = [0.0], [0]  # of each prefix of the current path
        path = ""
        for word in sorted(set(words)):
            w = WORD_MARK + word
            shared = 0
            for a, b in zip(path, w):
                if a != b:
                    break
                shared += 1
            del best[shared + 1:], pieces[shared + 1:]
            for end in range(shared + 1, len(w) + 1):
                n_bytes = len(w[end - 1].encode("utf-8", "surrogatepass"))
                top, n = best[end - 1] + n_bytes * byte, pieces[end - 1] + n_bytes
                for start in range(end - 1, -1, -1):
                    piece = w[start:end]
                    if piece not in endings:
                        break
                    s = scores.get(piece)
                    if s is not None:
                        s += best[start]
                        if s > top or s == top and pieces[start] + 1 < n:
                            top, n = s, pieces[start] + 1
                best.append(top)
                pieces.append(n)
                self.nodes += 1
            path = w
            found[word] = (pieces[-1], best[-1])
        return found


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_tokens`` (long) and ``log_score`` (double, sum over the text) added."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    state: dict = {}

    def fn(b: pa.RecordBatch) -> dict[str, pa.Array]:
        if not state:  # once per task
            state.update(trie=TrieCounter(sent.value), known={})
        known = state["known"]
        w = Words(b.column(text))
        words = w.words.to_pylist()
        new = [x for x in words if x not in known]
        if len(known) + len(new) > MAX_KNOWN:
            known.clear()
            new = words
        known.update(state["trie"].count(new))
        n = np.fromiter((known[x][0] for x in words), np.int64, len(words))
        s = np.fromiter((known[x][1] for x in words), np.float64, len(words))
        if len(known) > MAX_KNOWN:
            known.clear()
        return {
            "n_words": pa.array(w.lengths),
            "n_tokens": pa.array(w.per_doc(n[w.ids])),
            "log_score": pa.array(w.per_doc(s[w.ids])),
        }

    return append_columns(docs, fn, "n_words long, n_tokens long, log_score double")
