"""Token ids of whole texts with a public tokenizer of the tokenizers library, on Arrow batches."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHED_WORDS = 300_000  # of each of two generations, per Python worker: about 130 MB
CACHED_LENGTH = 64  # longer words are encoded each time
PART_BYTES = 4 << 20  # of text that is encoded at a time
# A space before white space (as Unicode has it) or the end.
_UNSAFE = " (?:[\\t-\\r\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]|$)"


class Encoder:
    """Encodes each distinct word of a batch once, and remembers the ids of words.

    The byte-level pre-tokenizer starts a new piece at a space that a non-space follows, whatever stands before.
    Texts are cut at such spaces, so that the ids are those of the whole text; a text with any other space is
    encoded as it is. Words not seen lately are encoded together, as one text, whose ids fall into words at each
    token that starts with a space. Tokenizers that work otherwise get whole texts.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        kind = repr(self.tokenizer.pre_tokenizer)
        self.cuts = (kind.startswith("ByteLevel") and "add_prefix_space=False" in kind and "use_regex=True" in kind
                     and self.tokenizer.normalizer is None)
        self.starts_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.starts_word[[i for token, i in self.tokenizer.get_vocab().items() if token.startswith("\u0120")]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of each word with a space before it."""
        found = []
        for at in range(0, len(words), 20_000):
            part = words[at:at + 20_000]
            ids = np.frombuffer(self._plain([" " + " ".join(part)])[0], "<u4")
            bounds = np.append(np.flatnonzero(self.starts_word[ids]), len(ids)) * 4
            whole = ids.tobytes()
            assert len(bounds) == len(part) + 1
            found += [whole[i:j] for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        return found

    def _known(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words with a space before each, from the last two generations or encoded now."""
        found: list = list(map(self.young.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        kept = {i: self.old[words[i]] for i in missing if words[i] in self.old}
        new = [i for i in missing if i not in kept]
        kept.update(zip(new, self._words([words[i] for i in new]), strict=True))
        if len(self.young) > CACHED_WORDS:
            self.young, self.old = {}, self.young
        for i, ids in kept.items():
            found[i] = ids
            if len(words[i]) <= CACHED_LENGTH:
                self.young[words[i]] = ids
        return found

    def _pieces(self, texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The ids of distinct pieces, the pieces of all texts in a row, and where each text's begin and end.

        A piece is a word, the head of a text up to its first space, or a text that cannot be cut.
        """
        cut = np.zeros(len(texts), bool)
        if self.cuts:
            spaced, unsafe = pc.match_substring(texts, " "), pc.match_substring_regex(texts, _UNSAFE)
            cut = pc.and_not(spaced, unsafe).to_numpy(zero_copy_only=False)
        whole = np.flatnonzero(~cut)
        split = pc.split_pattern(texts.filter(pa.array(cut)), " ")
        offsets = split.offsets.to_numpy().astype(np.int64)
        words = split.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        named, codes = words.dictionary, words.indices.to_numpy().astype(np.int64)
        heads = offsets[:-1] - offsets[0]
        as_word = np.zeros(len(named), bool)
        as_word[np.delete(codes, heads)] = True
        used = np.flatnonzero(as_word)
        units = self._known(named.take(pa.array(used)).to_pylist())
        place = np.zeros(len(named), np.int64)
        place[used] = np.arange(len(used))
        first, turn = np.unique(codes[heads], return_inverse=True)
        pieces = place[codes]
        pieces[heads] = len(units) + turn
        units = units + self._plain(named.take(pa.array(first)).to_pylist())
        counts = np.ones(len(texts), np.int64)
        counts[cut] = np.diff(offsets)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        out = np.empty(bounds[-1], np.int64)
        out[np.repeat(bounds[:-1][cut] - heads, np.diff(offsets)) + np.arange(len(pieces))] = pieces
        out[bounds[:-1][whole]] = len(units) + np.arange(len(whole))
        return units + self._plain(texts.take(pa.array(whole)).to_pylist()), out, bounds

    def counts(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text."""
        units, pieces, bounds = self._pieces(texts)
        sizes = np.fromiter(map(len, units), np.int64, len(units)) // 4
        return np.diff(np.concatenate([[0], np.cumsum(sizes[pieces])])[bounds])

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin and end."""
        units, pieces, bounds = self._pieces(texts)
        sizes = np.fromiter(map(len, units), np.int64, len(units)) // 4
        pool, starts = np.frombuffer(b"".join(units), "<u4"), np.cumsum(sizes) - sizes
        sizes = sizes[pieces]
        ends = np.cumsum(sizes)
        places = np.repeat(starts[pieces] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return pool[places], np.concatenate([[0], ends])[bounds]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        ids, bounds = self.ids(pa.array(texts, pa.string()))
        return [ids[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:], strict=True)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _parts(column: pa.Array) -> Iterator[pa.Array]:
    """The column, null as empty, in parts of few MB of text or of one row."""
    texts = column.fill_null("")
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + PART_BYTES, side="right")))
        yield texts.slice(at, end - at)
        at = end


def encode_column(column: pa.Array, path: str) -> Iterator[np.ndarray]:
    """The ids of each row of an Arrow text column."""
    for part in _parts(column):
        ids, bounds = encoder(path).ids(part)
        for i, j in zip(bounds[:-1], bounds[1:], strict=True):
            yield ids[i:j]


def count_column(column: pa.Array, path: str) -> np.ndarray:
    """The number of ids of each row."""
    return np.concatenate([np.zeros(0, np.int64), *(encoder(path).counts(part) for part in _parts(column))])
