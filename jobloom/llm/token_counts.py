"""Token counts by greedy longest match with a linear automaton (operator 4).

The automaton is the trie of the vocabulary with failure links. When a state has no
step for the next byte, its longest piece (and whatever further pieces that settles)
is popped: the link leads to the state of the bytes that remain, and the number of
pieces popped is stored with it. So a word's token count needs one pass over its bytes, no
pieces are built, and no byte is read again. All 256 single bytes count as pieces, so
every text has a count (a sign outside the vocabulary counts one per byte).

A slice of texts runs its distinct words through the automaton side by side.

Defined cases: a null or empty text has 0 words and 0 tokens; words of any length are
counted whole; repeated rows are counted each; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from jobloom.llm.textkit import Words, slices

WORD_START = "▁".encode()
_SIDE_BY_SIDE = 64


class LongestMatch:
    """Automaton of a vocabulary; the word start is put in front of every word."""

    def __init__(self, pieces: Iterable[bytes], word_start: bytes = WORD_START):
        steps: list[dict[int, int]] = [{}]
        final = [False]
        for piece in [*pieces, *(bytes([b]) for b in range(256))]:
            at = 0
            for byte in piece:
                if byte not in steps[at]:
                    steps[at][byte] = len(steps)
                    steps.append({})
                    final.append(False)
                at = steps[at][byte]
            final[at] = True
        link, popped, closing = [0] * len(steps), [0] * len(steps), [0] * len(steps)
        queue = [0]
        for at in queue:  # by depth: links lead to shorter states
            for byte, to in steps[at].items():
                queue.append(to)
                if final[to]:
                    popped[to] = 1
                else:
                    back, count = link[at], popped[at]
                    while byte not in steps[back]:
                        back, count = link[back], count + popped[back]
                    link[to], popped[to] = steps[back][byte], count
                closing[to] = popped[to] + closing[link[to]]
        edges = sorted((at << 8 | byte, to) for at, row in enumerate(steps) for byte, to in row.items())
        self.keys, self.to = (np.array(side, np.int64) for side in zip(*edges, strict=True))
        self.link, self.popped, self.closing = (np.array(x, np.int64) for x in (link, popped, closing))
        self.start, self.before = self._walk(0, 0, word_start)

    def _step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        key = state << 8 | byte
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.to[at], -1)

    def _walk(self, state: int, count: int, piece: bytes) -> tuple[int, int]:
        """One word, byte by byte."""
        for byte in piece:
            while True:
                at = int(np.searchsorted(self.keys, state << 8 | byte))
                if at < len(self.keys) and self.keys[at] == state << 8 | byte:
                    state = int(self.to[at])
                    break
                count += int(self.popped[state])
                state = int(self.link[state])
        return state, count

    def counts(self, words: Words, chosen: np.ndarray) -> np.ndarray:
        """Token counts of the chosen words."""
        sizes = (words.end - words.begin)[chosen]
        order = np.argsort(-sizes, kind="stable")
        out = np.zeros(len(chosen), np.int64)
        long = int((sizes > _SIDE_BY_SIDE).sum())
        for i in order[:long].tolist():
            state, count = self._walk(self.start, self.before, words.text(chosen[i]))
            out[i] = count + self.closing[state]
        order = order[long:]
        first, sizes = words.begin[chosen[order]], sizes[order]
        state, count = np.full(len(order), self.start, np.int64), np.full(len(order), self.before, np.int64)
        for place in range(int(sizes[0]) if len(sizes) else 0):
            live = int(np.searchsorted(-sizes, -place))  # words longer than this place
            byte = words.data[first[:live] + place].astype(np.int64)
            to = self._step(state[:live], byte)
            stuck = np.flatnonzero(to < 0)
            while len(stuck):
                count[stuck] += self.popped[state[stuck]]
                state[stuck] = self.link[state[stuck]]
                to[stuck] = self._step(state[stuck], byte[stuck])
                stuck = stuck[to[stuck] < 0]
            state[:live] = to
        out[order] = count + self.closing[state]
        return out


def sentence_pieces(path: str) -> list[bytes]:
    """The ordinary pieces of a sentencepiece model file (no control, unknown or byte pieces)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ordinary = (
        i for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    )
    return [model.id_to_piece(i).encode() for i in ordinary]


def count_tokens(docs: DataFrame, pieces: Iterable[bytes], text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_words, n_tokens) per row; the automaton has the vocabulary's fixed size and is sent to the tasks."""
    automaton = docs.sparkSession.sparkContext.broadcast(LongestMatch(pieces))
    narrow = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = Words(part["text"])
                _, first, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
                total = np.append(0, np.cumsum(automaton.value.counts(words, first)[which]))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(words.counts()), pa.array(np.diff(total[words.bounds]))],
                    names=["doc_id", "n_words", "n_tokens"],
                )

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, n_words long, n_tokens long")
