"""Ids of texts by a byte-level tokenizer, each different piece of a slice looked up once.

The tokenizer splits a text before it merges bytes, and always before a space or line feed that
stands in front of a printable character. Cut there, the parts have the ids they have in the whole
text. Words of letters with marks behind them are cut further, as letters and marks are never one
piece. Parts seen before are remembered up to a bound; all others go to the tokenizer.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from stocktide.llm.text import gathered

SPACE = "\u0120"  # how byte-level vocabularies write a leading space
CACHED_PARTS = 800_000  # about 200 bytes each
SLICE_BYTES = 8 << 20  # text encoded at once
TOGETHER = 512  # parts of letters encoded as one text
_FRONT = "!-~\\x{C0}-\\x{24F}"
# parts that are pieces of their own; apostrophes and digits have rules and stay whole
_PARTS = r"^(?P<feed>\n?)(?P<letters> ?[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+)(?P<marks>[.,!?;:%&$*#|]*)$"


def _listed(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.pieces = Tokenizer.from_file(path), Tokenizer.from_file(path)
        # for parts known to be pieces of their own
        self.pieces.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.apart = "|".join(["\0", *map(re.escape, added)])
        self.known: dict[str, bytes] = {"": b""}
        vocabulary = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for token, i in vocabulary.items() if token.startswith(SPACE)]] = True

    def _ids(self, parts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def _learn(self, parts: list[str]) -> None:
        """Ids of parts not known yet. Words with a space in front are encoded many at once and told apart by the
        ids that begin with a space."""
        letters = [p for p in parts if p[0] == " " and p[1:].isalpha()]
        others = [p for p in parts if p[0] != " " or not p[1:].isalpha()]
        runs = [letters[at : at + TOGETHER] for at in range(0, len(letters), TOGETHER)]
        for own, found in zip(runs, self.pieces.encode_batch_fast(runs, is_pretokenized=True, add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            starts = (4 * np.flatnonzero(self.spaced[ids])).tolist()
            if len(starts) != len(own):
                others = others + own
                continue
            packed = ids.tobytes()
            self.known.update((part, packed[s:e]) for part, s, e in zip(own, starts, [*starts[1:], len(packed)]))
        self.known.update(zip(others, self._ids(others)))

    def _table(self, parts: list[str]) -> list[bytes]:
        found = list(map(self.known.get, parts))
        new = [part for part, ids in zip(parts, found) if ids is None]
        if not new:
            return found
        if len(self.known) + len(new) > CACHED_PARTS:
            # what this slice has in common with earlier ones stays
            self.known = {"": b""} | {part: ids for part, ids in zip(parts, found) if ids is not None}
        self._learn(new)
        return list(map(self.known.get, parts))

    def _words(self, column: pa.Array) -> pa.Array:
        """Each text as a list of words that begin with the white space in front of them."""
        odd = pc.match_substring_regex(column, f"[ \\n][^{_FRONT}]")
        cut = pc.replace_substring(pc.replace_substring(column, "\n", "\0\n"), " ", "\0 ")
        if pc.any(odd).as_py():
            slow = pc.replace_substring_regex(column.filter(odd), f"[ \\n][{_FRONT}]", "\0\\0")
            cut = pc.replace_with_mask(cut, odd, slow)
        return pc.split_pattern(cut, "\0")

    def _encode(self, column: pa.Array) -> Iterator[bytes]:
        split = self._words(column)
        words = split.flatten().dictionary_encode()
        found = pc.extract_regex(words.dictionary, _PARTS)
        plain = found.is_valid()
        fields = [found.field(name).filter(plain).dictionary_encode() for name in ("feed", "letters", "marks")]
        parts = [p for field in fields for p in _listed(field.dictionary)]
        parts += [*_listed(words.dictionary.filter(pc.invert(plain))), ""]
        table = self._table(parts)
        # a word is its line feed, its letters and its marks, or itself and nothing
        picks = np.full((len(words.dictionary), 3), len(parts) - 1)
        is_plain, at = plain.to_numpy(zero_copy_only=False), 0
        for place, field in enumerate(fields):
            picks[is_plain, place] = field.indices.to_numpy() + at
            at += len(field.dictionary)
        picks[~is_plain, 0] = np.arange(at, len(parts) - 1)
        sizes = np.fromiter(map(len, table), np.int64, len(table)) // 4
        values, sizes = gathered(np.frombuffer(b"".join(table), "<u4"), sizes, picks.ravel())
        ids, sizes = gathered(values, sizes.reshape(-1, 3).sum(1), words.indices.to_numpy())
        total = np.concatenate([[0], np.cumsum(sizes)])
        bounds = total[split.offsets.to_numpy()].tolist()
        for first, last in zip(bounds, bounds[1:]):
            yield ids[first:last].tobytes()

    def encode(self, column: pa.Array) -> Iterator[bytes]:
        """Ids of each text as little-endian 32-bit numbers. White space before a special token ends
        there, so texts that hold one go to the tokenizer whole, as do texts with a NUL."""
        if not len(column):
            return
        column = pa.concat_arrays([column])  # a copy of its own: kernels then see no offset into a batch
        whole = pc.match_substring_regex(column, self.apart)
        by_word = self._encode(column.filter(pc.invert(whole)))
        by_text = iter(self._ids(_listed(column.filter(whole))))
        for is_whole in whole.to_numpy(zero_copy_only=False).tolist():
            yield next(by_text) if is_whole else next(by_word)


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encoded(column: pa.Array, path: str) -> Iterator[bytes]:
    """Ids of the texts of a batch, slice by slice."""
    lengths = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False)) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(lengths)) + 1).tolist(), len(column)]
    for start, end in zip(cuts, cuts[1:]):
        yield from encoder(path).encode(column.slice(start, end - start))
