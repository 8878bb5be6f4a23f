"""Ids of whole texts by the tokenizers library."""

from __future__ import annotations

import os
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from tillcast.llm.memo import Memo

#: How the tokenizer's file splits a text that is lower case already (a fixed value of its format).
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Below this character each one but U+0130 is lowered alone and composition changes nothing.
_PLAIN = "ɐ"
# Words with anything else, apostrophes or other white space are not cut by Arrow.
_ODD = r"['\t\x0b-\r\x{85}\x{a0}\x{130}]|[^\x{0}-\x{24f}]"
_SIGNS = r"(\pN|[^\pL\pN\s]+)"


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class WordIds:
    """A tokenizer file whose pre-tokenizer drops white space, with lower-casing and word ends.

    No token of such a vocabulary spans a blank, and its normalizer works on each side of one
    alone, so texts are cut at blanks and Arrow numbers the distinct words.  Plain ones (Latin letters
    without apostrophes) are lowered and cut into the file's pieces, distinct pieces are encoded by
    the library's model, other words by the whole library, and both are remembered up to a bound.
    Ids are packed as unsigned little-endian integers.
    """

    def __init__(self, path: str, memo: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.letters = _byte_letters()
        self.words = Memo(self._word_ids, memo)

    def _packed(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _piece_ids(self, piece: str) -> bytes:
        if not (piece.isascii() and piece.isprintable()):
            piece = "".join([self.letters[b] for b in piece.encode()])
        return self._packed([token.id for token in self.model.tokenize(piece)])

    def _word_ids(self, word: str) -> bytes:
        if not word:
            return b""
        if word.isascii() and word.isalpha() and word.islower():
            return array(self.code, [token.id for token in self.model.tokenize(word)]).tobytes()
        if (word.isascii() or max(word) < _PLAIN) and "\u0130" not in word:
            return b"".join([self._piece_ids(piece) for piece in PIECES.findall(word.lower())])
        return self._packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty), each followed by ``end_id``, and the places between texts."""
        self.words.turn()
        cut = pc.split_pattern(pc.replace_substring(texts.fill_null(""), "\n", " "), " ")
        words = cut.flatten().dictionary_encode()
        distinct = words.dictionary
        plain = pc.replace_substring_regex(pc.utf8_lower(distinct), _SIGNS, r" \1 ")
        split = pc.split_pattern(pc.if_else(pc.match_substring_regex(distinct, _ODD), distinct, plain), " ")
        pieces = split.flatten().dictionary_encode()
        packed = list(map(self.words.__getitem__, pieces.dictionary.to_numpy(zero_copy_only=False)))
        ids = np.frombuffer(b"".join(packed), self.dtype)
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // self.dtype.itemsize
        ids, edges = _joined(split, pieces.indices, ids, np.concatenate([[0], np.cumsum(sizes)]))
        ids, edges = _joined(cut, words.indices, ids, edges)
        return np.insert(ids, edges[1:], end_id), edges + np.arange(len(edges))


def _joined(lists: pa.ListArray, numbers: pa.Array, ids: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each list and the places between lists, from the ids of its numbered members."""
    number = numbers.to_numpy()
    taken = np.diff(edges)[number]
    ends = np.cumsum(taken)
    at = np.repeat(edges[number] - (ends - taken), taken)
    at += np.arange(len(at))
    between = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return ids[at], np.concatenate([[0], ends])[between]


@lru_cache(maxsize=2)
def loaded(path: str) -> WordIds:
    """One per Python worker; its memo serves all tasks of the worker."""
    return WordIds(path)
