"""Token counts under a unigram model, by forward scores shared along a trie of pre-tokens.

A pre-token is a word with a mark in front.  The best segmentation of a pre-token into pieces of the vocabulary has the
highest sum of piece scores; of equal sums, the one of fewer pieces.  Distinct pre-tokens are inserted into a trie whose
nodes hold the best score and count of pieces up to there, so a prefix that many pre-tokens share is computed once;
the count at the last node of a pre-token is kept for its next occurrence.

The vocabulary is a given tokenizer file, nothing is trained: pieces come in order of frequency there, and the scores
are those of Zipf's law, minus the logarithm of the rank.  Characters outside the vocabulary are spelled in bytes.

Edge cases: a null or blank text has no pre-tokens and no tokens; a very long word is scored alone, without the trie;
repeated rows are counted as often as they occur; an empty table gives no rows; all columns of the documents are
kept, and clashing names are replaced by the counts.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gridlake.llm.common import BLANKS, read_table, small_batches

WORD = re.compile(f"[^{BLANKS}]+")
MARK = "▁"
#: What a byte scores below the last piece.
BYTE_PENALTY = 2.0
#: Nodes and words held by a task; beyond either the trie starts anew, which changes the time only.
MAX_NODES, MAX_WORDS = 400_000, 300_000
#: Longer pre-tokens do not go into the trie.
LONGEST = 64


def piece_scores(model_path: str) -> dict[str, float]:
    """Pieces of a sentencepiece file with minus the logarithm of their rank; bytes and control pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    plain = [i for i in range(model.get_piece_size())
             if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    return {model.id_to_piece(i): -float(np.log(rank + 1)) for rank, i in enumerate(plain)}


class TokenCounter:
    """Counts of pieces in the best segmentations of pre-tokens."""

    def __init__(self, scores: dict[str, float]):
        self.byte_score = min(scores.values(), default=0.0) - BYTE_PENALTY
        # Every ending of a piece, with the score if it is a piece itself: a longer one can only follow from these.
        self.endings = {piece[i:]: None for piece in scores for i in range(len(piece))} | scores
        self.reset()

    def reset(self) -> None:
        self.nodes: dict[str, tuple[float, int]] = {}  # the trie, a node by its prefix: score and pieces
        self.terminal: dict[str, int] = {}

    def forward(self, text: str, end: int, best: list[float], count: list[int]) -> tuple[float, int]:
        """Score and pieces up to `end`, given those of every shorter prefix in `best` and `count`."""
        endings, start = self.endings, end - 1
        char = text[start]
        score = endings.get(char)
        if score is None:
            n = len(char.encode("utf-8", "replace"))
            top, pieces = best[start] + n * self.byte_score, count[start] + n
        else:
            top, pieces = best[start] + score, count[start] + 1
        while start:
            if char not in endings:
                break
            start -= 1
            char = text[start:end]
            score = endings.get(char)
            if score is not None:
                score += best[start]
                if score > top or score == top and count[start] + 1 < pieces:
                    top, pieces = score, count[start] + 1
        return top, pieces

    def alone(self, text: str) -> int:
        best, count = [0.0], [0]
        for end in range(1, len(text) + 1):
            score, pieces = self.forward(text, end, best, count)
            best.append(score)
            count.append(pieces)
        return count[-1]

    def insert(self, text: str) -> int:
        """Walk or extend the trie along `text`; the count at its end."""
        nodes, best, count = self.nodes, [0.0], [0]  # scores and counts along the path
        for end in range(1, len(text) + 1):
            node = nodes.get(text[:end])
            if node is None:
                node = nodes[text[:end]] = self.forward(text, end, best, count)
            best.append(node[0])
            count.append(node[1])
        return count[-1]

    def words(self, words: list[str]) -> int:
        """Tokens of a text, given its words."""
        if len(self.nodes) > MAX_NODES or len(self.terminal) > MAX_WORDS:
            self.reset()
        total, known = 0, self.terminal
        for word in words:
            n = known.get(word)
            if n is None:
                n = known[word] = self.insert(MARK + word) if len(word) < LONGEST else self.alone(MARK + word)
            total += n
        return total


def count_columns(model_path: str, text: Column) -> Column:
    @F.pandas_udf("n_pretokens long, n_tokens long")
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = TokenCounter(piece_scores(model_path))
        for batch in batches:
            bags = [WORD.findall(t) if t else [] for t in batch]
            yield pd.DataFrame({
                "n_pretokens": np.array([len(b) for b in bags], dtype="int64"),
                "n_tokens": np.array([counter.words(b) for b in bags], dtype="int64")})

    return counts(text)


def with_token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """The documents with n_pretokens and n_tokens."""
    small_batches(docs.sparkSession)
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("n_pretokens", "n_tokens")]
    return docs.select(*kept, count_columns(model_path, F.col("text")).alias("_counts")).select(
        *kept, "_counts.n_pretokens", "_counts.n_tokens")


def op1_token_counts(spark, sf_dir):
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_token_counts(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")
