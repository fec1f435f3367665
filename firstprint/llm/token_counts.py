"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary's word-initial and continuation pieces form two tries. Every node carries a failure link: where matching
goes on when no edge fits, and how many pieces are finished ("popped") on the way there. Both are worked out once, when
the automaton is built, so a word is measured in one pass over its characters, without building a piece or looking back.
A word that cannot be split counts as one unknown piece.

Counts of words are remembered per task, within a bound.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from firstprint.llm.caching import Remembered
from firstprint.llm.frames import frame

DEAD = -1
WORD_START = "▁"


class Automaton:
    """Longest-match-first piece counts of words, for pieces that start a word and pieces that continue one."""

    def __init__(self, initial: Iterable[str], continuing: Iterable[str]):
        self.edges: list[dict[str, int]] = [{}, {}]  # node 0 starts a word, node 1 continues it
        self.final: list[bool] = [False, False]
        for root, pieces in ((0, initial), (1, continuing)):
            for piece in pieces:
                if piece:
                    self._add(root, piece)
        self.fail, self.popped = [DEAD] * len(self.edges), [0] * len(self.edges)
        self._link()

    def _add(self, node: int, piece: str) -> None:
        for character in piece:
            following = self.edges[node].get(character)
            if following is None:
                following = len(self.edges)
                self.edges.append({})
                self.final.append(False)
                self.edges[node][character] = following
            node = following
        self.final[node] = True

    def _link(self) -> None:
        """Breadth first: the links of a node follow from those of its parent."""
        waiting = deque([0, 1])
        while waiting:
            parent = waiting.popleft()
            for character, node in self.edges[parent].items():
                if self.final[node]:  # the whole string is a piece
                    self.fail[node], self.popped[node] = 1, 1
                else:
                    at, popped = self.fail[parent], self.popped[parent]
                    while at != DEAD and character not in self.edges[at]:
                        popped += self.popped[at]
                        at = self.fail[at]
                    if at != DEAD:
                        self.fail[node], self.popped[node] = self.edges[at][character], popped
                waiting.append(node)

    def count(self, word: str) -> int:
        """Pieces of a word; 0 if it cannot be split."""
        node, pieces = 0, 0
        for character in word:
            while (following := self.edges[node].get(character)) is None:
                pieces += self.popped[node]
                node = self.fail[node]
                if node == DEAD:
                    return 0
            node = following
        while node != 1:  # what is left must end in whole pieces
            pieces += self.popped[node]
            node = self.fail[node]
            if node == DEAD:
                return 0
        return pieces


def sentencepiece_vocabulary(model_file: str) -> tuple[list[str], list[str]]:
    """Word-initial and continuation pieces of a sentencepiece model, without control, unknown and byte pieces."""
    from sentencepiece import SentencePieceProcessor
    model = SentencePieceProcessor(model_file=model_file)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return [p[1:] for p in pieces if p.startswith(WORD_START)], [p for p in pieces if not p.startswith(WORD_START)]


def token_counts(docs: DataFrame, vocabulary: Callable[[], tuple[list[str], list[str]]]) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_tokens, n_unknown.

    Words are what white space separates; an unknown word is one token. A null text has no words. Texts of any length are
    read whole; repeated rows get equal counts; a null doc_id is kept; other columns are not read. `vocabulary` is called
    in each task and returns the word-initial and the continuing pieces.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = Remembered(Automaton(*vocabulary()).count)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                found = list(map(counts.__getitem__, (text or "").split()))
                unknown = found.count(0)
                rows.append((doc_id, len(found), sum(found) + unknown, unknown))
            yield frame("doc_id n_words n_tokens n_unknown", rows)

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id bigint, n_words bigint, n_tokens bigint, n_unknown bigint")
