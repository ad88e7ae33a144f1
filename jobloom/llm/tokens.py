"""Token ids of many texts: every distinct piece of a slice of texts is encoded once."""

from __future__ import annotations

import json
from array import array

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from jobloom.llm.textkit import SPACE, Words, ragged

# Byte classes of the split before encoding: letters run on, digits stand alone, other signs run on.
_OTHER, _LETTER, _DIGIT = 0, 1, 2
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_CLASS[48:58] = _DIGIT


def _byte_signs() -> dict[int, str]:
    """The sign that stands for each byte: itself where it can be printed, else one from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


_SIGNS = _byte_signs()


class Encoder:
    """Ids of texts under a word-end byte-pair tokenizer (lower case, blanks dropped).

    The tokenizer never joins across blanks, so a text's ids are its words' ids in
    order. Plain words (ASCII and Latin-1 letters, digits, signs other than an
    apostrophe or a control sign) are cut into runs of letters, single digits and runs of signs as the
    tokenizer cuts them; each distinct run meets the model once. All other words
    go to the tokenizer whole. `kept` bounds the runs remembered between slices.
    """

    def __init__(self, content: str, kept: int = 300_000):
        split = json.loads(content)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if not split.endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"):
            raise ValueError(f"a tokenizer with another split of words: {split}")
        self._whole = Tokenizer.from_str(content)
        self._model = self._whole.model
        self._kept = kept
        self._forget()

    def _forget(self) -> None:
        self._places: dict[int, int] = {}
        self._ids, self._ends = array("I"), array("q", [0])

    def _remember(self, pieces: list[bytes], plain: list[bool]) -> None:
        """Append the ids of new pieces."""
        ids, ends, tokenize = self._ids, self._ends, self._model.tokenize
        for piece, simple in zip(pieces, plain, strict=True):
            if not simple:
                ids.extend(self._whole.encode(piece.decode(), add_special_tokens=False).ids)
            else:
                text = piece.decode().lower()
                if not text.isascii():
                    text = text.encode().decode("latin-1").translate(_SIGNS)
                ids.extend([token.id for token in tokenize(text)])
            ends.append(len(ids))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, first id of each text and the end)."""
        words = Words(texts)
        data, kind = words.data, _CLASS[words.data]
        # Words that need the whole tokenizer: an apostrophe, an opening "<|", a control sign, or one beyond Latin-1 letters.
        after = np.append(data[1:], 0)
        lead = (data == 0xC3) & (after != 0x97) & (after != 0xB7)
        odd = (data == 0x27) | ((data == 0x3C) & (after == 0x7C))
        odd |= (data >= 0x80) & ~(lead | np.append(False, lead[:-1]))
        odd |= (data < 0x20) | (data == 0x7F)
        odd &= ~SPACE[data]
        hard = np.zeros(len(words), bool)
        hard[np.searchsorted(words.begin, np.flatnonzero(odd), "right") - 1] = True
        # Pieces: cut where the class changes and before and after each digit, but not inside hard words.
        cut = np.ones(len(data), bool)
        cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        inside = ragged(words.begin[hard], (words.end - words.begin)[hard])
        cut[inside] = False
        cut[words.begin] = True
        gap = np.ones(len(data) + 1, bool)
        filled = ragged(words.begin, words.end - words.begin)
        gap[filled] = False
        begin = np.flatnonzero(cut & ~gap[:-1])
        stop = np.ones(len(data) + 1, bool)
        stop[:-1] = cut | gap[:-1]
        ends = np.flatnonzero(stop)
        end = ends[np.searchsorted(ends, begin, "right")]
        whole = np.zeros(len(data) + 1, bool)
        whole[words.begin[hard]] = True
        plain = ~whole[begin]
        pieces = Words.__new__(Words)
        pieces.data, pieces.begin, pieces.end = data, begin, end
        found, first, which = np.unique(pieces.hashes(lower=True) ^ plain, return_index=True, return_inverse=True)
        if len(self._places) > self._kept:
            self._forget()
        places, keys = self._places, found.tolist()
        new = [i for i, key in enumerate(keys) if key not in places]
        places.update(zip((keys[i] for i in new), range(len(places), len(places) + len(new)), strict=True))
        chosen, raw = first[new], data.tobytes()
        spans = zip(begin[chosen].tolist(), end[chosen].tolist(), strict=True)
        self._remember([raw[low:high] for low, high in spans], plain[chosen].tolist())
        at = np.fromiter(map(places.__getitem__, keys), np.int64, len(keys))[which]
        ends = np.array(self._ends)
        counts = (ends[1:] - ends[:-1])[at]
        ids = np.array(self._ids, np.uint32)[ragged(ends[at], counts)]
        edge = np.searchsorted(begin, words.offsets)
        total = np.append(0, np.cumsum(counts))
        return ids, total[edge]


