"""Token ids of whole texts, with a bounded cache of words in each worker."""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

import tiktoken

from postlens.llm.common import take_turn

#: Words of these characters only are tokenized alone, whatever stands around them.
_PLAIN = re.compile("\n?[\x21-\x7eÀ-ÖØ-öø-ſ]+")
_CACHED_WORDS = 800_000


#: Tiktoken's name for the split into words that byte-level vocabularies of this kind start with.
_SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a byte-level file as bytes; ids rank the merges.

    Such a file writes printable bytes of Latin-1 as themselves and the others, in order, as characters from 256 on.
    """
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    special = {t["content"] for t in content["added_tokens"]}
    return {bytes(byte[c] for c in word): k for word, k in content["model"]["vocab"].items() if word not in special}


class TextEncoder:
    """Ids as little-endian 32-bit bytes, the same as of the whole text by the tokenizer.

    The tokenizer of the byte-level vocabulary first splits a text so that no token
    reaches over a space into the word before it. So texts of plain words with single
    spaces and line ends between them are looked up word by word, and only new words
    are encoded, by the library that is quick at single words; any other text, or one
    that spells a special token, is encoded whole by the tokenizer itself.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.word_ids = tiktoken.Encoding("words", pat_str=_SPLIT, mergeable_ranks=_ranks(path), special_tokens={}).encode_ordinary
        #: Ids of a word with the space or line end before it; None if it takes the whole text to tell.
        self.words: dict[str, bytes | None] = {}
        self.line_end = array("I", self.word_ids("\n")).tobytes()

    def _learn(self, words: set[str]) -> None:
        if len(self.words) > _CACHED_WORDS:
            self.words.clear()
        for word in words.difference(self.words):
            plain = _PLAIN.fullmatch(word) and not any(s in word for s in self.special)
            self.words[word] = array("I", self.word_ids(word if word[0] == "\n" else f" {word}")).tobytes() if plain else None

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " \n").split(" ") for t in texts]
        # a line end stands for the space before the first word, which has none
        for words in split:
            words[0] = f"\n{words[0]}"
        self._learn(set().union(*split))
        known, skip = self.words.__getitem__, len(self.line_end)
        out = []
        for text, words in zip(texts, split):
            try:
                out.append(b"".join(map(known, words))[skip:])
            except TypeError:  # a word that is None
                out.append(array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes() if text else b"")
        return out


@lru_cache(maxsize=2)
def _encoder(path: str) -> TextEncoder:
    return TextEncoder(path)


def encoder(path: str) -> TextEncoder:
    """One for each worker process."""
    take_turn("tokens", _encoder.cache_clear)
    return _encoder(path)
