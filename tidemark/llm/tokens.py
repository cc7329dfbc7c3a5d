"""Token ids of the public byte-level vocabulary, and the reading of vocabulary files."""

from __future__ import annotations

import base64
import re

import numpy as np

from .common import per_worker

END_OF_TEXT = "<|endoftext|>"
END_OF_TEXT_ID = 50256

#: Token strings are remembered up to this number per task.
REMEMBERED = 400_000

_LETTER = "A-Za-zÀ-ÖØ-öø-ſ"
_SPACE = r"\t\n\x0b\x0c\r "
_PLAIN = re.compile(
    rf"'(?:[sdmt]|ll|ve|re)| ?[{_LETTER}]+| ?[0-9]+| ?[^{_SPACE}{_LETTER}0-9]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: Characters on whose kind the pattern above and the vocabulary's own may differ.
_RARE = re.compile(rf"[^{_SPACE}!-~{_LETTER}‐-‧]")


class BytePairs(dict):
    """Text -> little-endian 32-bit ids, equal to those of the vocabulary's tokenizer file.

    Words of plain texts are looked up and encoded once; texts with rarer characters, whose classes
    only the tokenizer's own pattern knows, are encoded whole.
    """

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks,
                                          special_tokens={END_OF_TEXT: END_OF_TEXT_ID})

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.encoding.encode_ordinary(word), "<u4").tobytes()
        if len(self) < REMEMBERED and len(word) < 64:
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if END_OF_TEXT in text or _RARE.search(text):
            return np.array(self.encoding.encode(text, allowed_special="all"), "<u4").tobytes()
        return b"".join(map(self.__getitem__, _PLAIN.findall(text)))


def byte_pairs(ranks_path: str, pattern: str) -> BytePairs:
    """One for each Python worker."""
    return per_worker(("byte pairs", ranks_path), lambda: BytePairs(ranks_path, pattern))
