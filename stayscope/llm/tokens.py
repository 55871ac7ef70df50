"""Token ids of whole texts with the public word-end BPE vocabulary, one word at a time.

The vocabulary's tokenizer never lets a token cross white space, so a text's ids are its words' ids
in a row. Words repeat, so each Python worker keeps the ids of the words it has met.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

CACHE_WORDS = 600_000
PLAIN = re.compile("[\x21-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
# Fixed values of the vocabulary's own pre-tokenizer, for letters up to U+00FF.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+")
CONTROLS = re.compile("[\x1c-\x1f]")


def _byte_letters() -> dict[int, str]:
    """Latin-1 letters as their UTF-8 bytes, each byte written as a printable letter."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    for i, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + i)
    return {c: "".join(letters[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class WordTokenizer:
    """Ids as little-endian unsigned integers of `width` bytes, which must hold every id of the vocabulary."""

    def __init__(self, path: str, width: int = 4, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        if self.whole.get_vocab_size() > 1 << 8 * width:
            raise ValueError(f"ids of {path} need more than {width} bytes")
        self.width = width
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {}
        self.cache_words = cache_words

    def encode(self, text: str) -> bytes:
        """Ids of a text, straight from the tokenizer."""
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=f"<u{self.width}").tobytes()

    def _word(self, word: str) -> bytes:
        if PLAIN.fullmatch(word) and "<|" not in word:
            low = word.lower()
            pieces = PIECES.findall(low) if not low.isalpha() else [low]
            if not word.isascii():
                pieces = [p.translate(self.letters) for p in pieces]
            ids = b"".join([t.id.to_bytes(self.width, "little") for p in pieces for t in self.model.tokenize(p)])
        else:
            ids = self.encode(word)
        if len(self.words) >= self.cache_words:
            self.words.clear()
        self.words[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        """Ids of a text; the same as `encode`, from the cache where it can be."""
        if CONTROLS.search(text):
            return self.encode(text)
        words = text.split()
        found = list(map(self.words.get, words))
        if None in found:
            found = [self._word(w) if i is None else i for w, i in zip(words, found, strict=True)]
        return b"".join(found)


_KEPT: dict[tuple[str, int], WordTokenizer] = {}


def word_tokenizer(path: str, width: int = 4) -> WordTokenizer:
    """The worker's tokenizer for a vocabulary file, loaded once."""
    if (path, width) not in _KEPT:
        _KEPT[path, width] = WordTokenizer(path, width)
    return _KEPT[path, width]


def id_bytes(path: str) -> int:
    """Bytes that hold any id of a vocabulary file: 2 or 4."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else 4


def widened(ids: pa.Array, width: int) -> pa.Array:
    """Binary ids of `width` bytes each as ids of four bytes."""
    ids = ids.cast(pa.large_binary())
    ends = np.frombuffer(ids.buffers()[1], dtype=np.int64)[ids.offset : ids.offset + len(ids) + 1]
    first, last = (int(ends[0]), int(ends[-1])) if len(ids) else (0, 0)
    values = np.frombuffer(ids.buffers()[2] or b"", dtype=np.uint8)[first:last].view(f"<u{width}").astype("<u4")
    places = pa.py_buffer((ends - first) // width * 4) if len(ids) else ids.buffers()[1]
    return pa.Array.from_buffers(pa.large_binary(), len(ids), [None, places, pa.py_buffer(values)])
