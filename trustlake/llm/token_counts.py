"""Token counts by a unigram model, worked out once per shared prefix of the distinct words.

A text's pre-tokens are its words, each with the vocabulary's word mark before it. A pre-token's tokens are those of its
most probable segmentation into pieces, a piece's probability falling with its place in the vocabulary; of equally probable
ones the one with fewer tokens. A character no piece covers counts as its UTF-8 bytes. The forward score of a position
depends on the characters before it only: distinct pre-tokens are therefore visited in sorted order, which is the depth-first
order of their trie, and the scores of the path to the present node are all that is held. Where a word ends, its count is
stored; a task remembers the counts of recent words and sums them per document.

Defined results: a null text is empty and has no tokens. Repeated rows give repeated rows. An empty table gives an empty
table. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from math import log
from os.path import commonprefix
from typing import NamedTuple

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlake.llm.frames import byte_texts, in_slices, record

MARK = "▁"
#: Longer words share nothing and are not remembered.
LONG = 1024
#: Letters of words that a task remembers.
CACHE_LETTERS = 1 << 22
#: Added to a piece's place before the logarithm, so that the first pieces do not dwarf all others.
OFFSET = 10.0


class Pieces(NamedTuple):
    """Every beginning of a piece, with the piece's score where it is a whole one; and the score of a byte without a piece."""

    scores: dict[str, float | None]
    byte_score: float
    longest: int


def with_beginnings(scores: dict[str, float], byte_score: float) -> Pieces:
    beginnings: dict[str, float | None] = {piece[:n]: None for piece in scores for n in range(1, len(piece))}
    return Pieces(beginnings | scores, byte_score, max(map(len, scores), default=1))


@cache
def load_pieces(path: str) -> Pieces:
    """A vocabulary's pieces; a score is the log-probability but for a constant."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    whole = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    ranked = sorted(whole, key=lambda i: (-model.get_score(i), i))
    scores = {model.id_to_piece(i): -log(place + OFFSET) for place, i in enumerate(ranked)}
    return with_beginnings(scores, -2 * log(size + OFFSET))


def trie_counts(words: Iterable[str], pieces: Pieces) -> Iterator[tuple[str, int]]:
    """Every word of a sorted iterable with its number of tokens."""
    scores, byte_score, _ = pieces
    path = ""
    # forward[i]: score and minus the number of tokens of the best segmentation of path[:i]
    forward: list[tuple[float, int]] = [(0.0, 0)]
    # begun[i]: where a piece may have begun that goes on at i
    begun: list[list[int]] = [[0]]
    for word in words:
        text = MARK + word
        shared = len(commonprefix((path, text)))
        del forward[shared + 1 :], begun[shared + 1 :]
        for end in range(shared + 1, len(text) + 1):
            before, tokens = forward[end - 1]
            size = len(text[end - 1].encode("utf-8", "surrogatepass"))
            best, going = (before + size * byte_score, tokens - size), []
            for start in begun[end - 1]:
                piece = text[start:end]
                if piece in scores:
                    going.append(start)
                    score = scores[piece]
                    if score is not None:
                        before, tokens = forward[start]
                        best = max(best, (before + score, tokens - 1))
            forward.append(best)
            going.append(end)
            begun.append(going)
        path = text
        yield word, -forward[-1][1]


def long_count(word: str, pieces: Pieces) -> int:
    """The tokens of one word, of which only as many scores are kept as the longest piece has characters."""
    scores, byte_score, longest = pieces
    forward, base, going = [(0.0, 0)], 0, [0]
    for end in range(1, len(word) + len(MARK) + 1):
        character = word[end - len(MARK) - 1] if end > len(MARK) else MARK
        before, tokens = forward[-1]
        size = len(character.encode("utf-8", "surrogatepass"))
        best, still = (before + size * byte_score, tokens - size), []
        for start in going:
            piece = MARK + word[: end - len(MARK)] if start == 0 else word[start - len(MARK) : end - len(MARK)]
            if piece in scores:
                still.append(start)
                score = scores[piece]
                if score is not None:
                    before, tokens = forward[start - base]
                    best = max(best, (before + score, tokens - 1))
        forward.append(best)
        still.append(end)
        going = still
        if len(forward) > 8 * longest + 64:
            gone = len(forward) - longest - 1
            del forward[:gone]
            base += gone
    return -forward[-1][1]


def count_tokens(
    docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_pretokens, n_tokens`` per row."""
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").cast("binary").alias("text")
    )
    schema = pa.schema([("doc_id", pa.int64()), ("n_pretokens", pa.int64()), ("n_tokens", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_pieces(vocabulary)
        known: dict[str, int] = {}
        held = 0
        for batch in in_slices(batches, 1 << 23):
            texts = [text.decode("utf-8", "replace").split() for text in byte_texts(batch["text"])]
            fresh = {word for words in texts for word in words if len(word) <= LONG and word not in known}
            if held + sum(map(len, fresh)) > CACHE_LETTERS:
                known.clear()
                held = 0
                fresh = {word for words in texts for word in words if len(word) <= LONG}
            held += sum(map(len, fresh))
            known.update(trie_counts(sorted(fresh), pieces))
            totals = [sum(known[w] if len(w) <= LONG else long_count(w, pieces) for w in words) for words in texts]
            yield record(schema, batch["doc_id"], [len(w) for w in texts], totals)

    return rows.mapInArrow(count, "doc_id bigint, n_pretokens bigint, n_tokens bigint")
