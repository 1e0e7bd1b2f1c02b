"""Token counts by unigram segmentation, dynamic programming shared over a trie.

The vocabulary is a public piece file. Its pieces stand in the order in which they were
learned, so a piece of rank r gets the Zipf score -ln(r + 1). A text has as many tokens as
its best-scoring segmentation has pieces; a character that is no piece costs its bytes.

A pre-token is a run of spaces with the characters up to the next space or line end. No
piece crosses such a border, so a text's count is the sum over its pre-tokens. The distinct
pre-tokens of a batch form a trie. Visiting it depth first (that is, in sorted order) keeps
only the current path: each node's forward score is computed once for all pre-tokens that
share the prefix, and the count at a terminal node is stored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .common import file_bytes, held, id_text, Memo, ship, slices

MARK = "▁"
PRE_TOKEN = re.compile(r" *[^ \n]+| +|\n")


def piece_scores(model: bytes) -> dict[str, float]:
    """Score of every ordinary piece of a sentencepiece file."""
    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    ordinary = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())
                if not (pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_byte(i)
                        or pieces.is_unused(i))]
    return {p: -math.log(rank + 1) for rank, p in enumerate(ordinary, 1)}


class Counter:
    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores))
        self.unknown = min(scores.values()) - 10.0
        self.memo = Memo(None)

    def count(self, words: Iterable[str]) -> dict[str, int]:
        """Tokens of each distinct word, by one walk over their trie."""
        score, longest, found = self.scores.get, self.longest, {}
        best, tokens = [0.0], [0]  # of the prefixes on the current path
        last = ""
        for word in sorted(set(words)):
            shared, most = 0, min(len(word), len(last))
            while shared < most and word[shared] == last[shared]:
                shared += 1
            del best[shared + 1:], tokens[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                char = word[end - 1]
                own = score(char)
                if own is None:
                    top, n = best[end - 1] + self.unknown, tokens[end - 1] + len(char.encode())
                else:
                    top, n = best[end - 1] + own, tokens[end - 1] + 1
                for start in range(max(0, end - longest), end - 1):
                    own = score(word[start:end])
                    if own is not None and (total := best[start] + own) >= top:
                        if total > top or tokens[start] + 1 < n:
                            top, n = total, tokens[start] + 1
                best.append(top)
                tokens.append(n)
            found[word] = tokens[-1]
            last = word
        return found

    def texts(self, texts: list[str]) -> list[tuple[int, int]]:
        """(tokens, pre-tokens) of each text."""
        cut = [PRE_TOKEN.findall(t) for t in texts]
        found = self.memo.with_all(set().union(*cut), self.marked)
        return [(sum(map(found.__getitem__, words)), len(words)) for words in cut]

    def marked(self, words: list[str]) -> dict[str, int]:
        counted = self.count(w.replace(" ", MARK) for w in words)
        return {w: counted[w.replace(" ", MARK)] for w in words}


def counter(data) -> Counter:
    return held(("token_count", hash(data.value)), lambda: Counter(piece_scores(data.value)))


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, n_pre_tokens) of each whole text.

    A null or empty text has 0 of both. Repeated rows and null doc_ids pass through, other
    columns are ignored, an empty table gives no rows.
    """
    data = file_bytes(ship(docs.sparkSession), path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(data)
        for batch in slices(batches):
            found = own.texts(batch.column("text").to_pylist())
            tokens, words = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(tokens, pa.int64()),
                 pa.array(words, pa.int64())], ["doc_id", "n_tokens", "n_pre_tokens"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return id_text(docs).mapInArrow(run, f"doc_id {id_type}, n_tokens long, n_pre_tokens long")
