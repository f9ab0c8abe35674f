"""Token ids of whole texts by a public tokenizer file.

A tokenizer that drops white space and never joins across it gives a text the ids of its words in turn. Texts, and long
runs inside a text, of plain letters, digits and signs go at once through the same merges in the faster of two public
libraries: nothing is remembered of their words, so it doesn't matter how many different ones there are. Other words go
through the library that the file is made for, once in a while each, and are looked up otherwise; texts for any other kind
of file go through it whole. Tests compare both.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np

from .words import Known

# Spark decides how many cores a task uses; the library's own threads would come on top.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

END = 1
#: What a file's entries must say for words to be independent (fixed values of this kind of file).
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD_END = "</w>"
#: The same pattern for lower-case words of ASCII and Latin-1 letters, digits and signs.
_PLAIN = r"[!-~À-ÖØ-öø-ÿ]"
_SPACE = r"[\x20\x09-\x0D]"
_PLAIN_TEXT = re.compile(r"[!-~À-ÖØ-öø-ÿ\x20\x09-\x0D]*+")
#: Runs worth a call of their own: eight words or more, whole ones.
_PLAIN_RUN = re.compile(rf"(?<![^\x20\x09-\x0D])(?:{_PLAIN}++{_SPACE}++){{8,}}+")
#: What stands apart from the letters beside it: an ending, a run of signs, one digit, one line break or the like.
_APART = re.compile(r"[^a-zß-öø-ÿ\x20](?:(?<=')(?:s|t|re|ve|m|ll|d)|(?<=[^0-9\x09-\x0D])[^a-zß-öø-ÿ0-9\x20\x09-\x0D]*|)")


def default_tokenizer() -> str:
    """Place of the tokenizer file used by the registered queries; it is looked up on each executor."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Words:
    """Ids of texts, for files whose words are independent."""

    def __init__(self, tokenizer, model: dict):
        self.tokenizer = tokenizer
        self.known = Known(self._new)
        self.merges = self._merges(model["vocab"])
        self.merge = self.merges._core_bpe.encode_single_piece

    @staticmethod
    def _merges(vocab: dict[str, int]):
        """The file's merges in the other library. That has no word ends: the space after a piece, which is in none, marks them."""
        import tiktoken

        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that such files write as themselves
        hidden = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        space = next(c for c, b in byte.items() if b == 32)
        ranks = {}
        for token, id in vocab.items():
            word = token.removesuffix(_WORD_END)
            if not token.startswith("<|") and space not in word:
                ranks[bytes(byte[c] for c in word) + (b" " if word != token else b"")] = id
        # "<|" is in no plain text; where no mark is named, the library looks for an empty one at each place of a text.
        return tiktoken.Encoding("words", pat_str=r"\S+\x20", mergeable_ranks=ranks, special_tokens={"<|": max(vocab.values()) + 1})

    def _plain(self, text: str) -> np.ndarray:
        return self.merges.encode_to_numpy(_APART.sub(r" \g<0> ", text.lower()) + " ", disallowed_special=())

    def _new(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "surrogatepass")
        if "<|" not in text and _PLAIN_TEXT.fullmatch(text):
            text = text.lower()
            ids = self.merge(text.encode() + b" ") if text.isalpha() else [i for p in _APART.sub(r" \g<0> ", text).split() for i in self.merge(p.encode() + b" ")]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def _by_word(self, text: str) -> np.ndarray:
        known = self.known
        return np.frombuffer(b"".join([known[w] for w in text.encode("utf-8", "surrogatepass").split()]), np.uint32)

    def ids(self, text: str) -> np.ndarray:
        if "<|" in text:
            return self._by_word(text)
        if _PLAIN_TEXT.fullmatch(text):
            return self._plain(text)
        found, at = [], 0
        for run in _PLAIN_RUN.finditer(text + " "):
            found += [self._by_word(text[at:run.start()]), self._plain(run[0])]
            at = run.end()
        return np.concatenate([*found, self._by_word(text[at:])])


class Texts:
    """Ids by text, for any other file."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=2)
def _tokenizer(path: str | None) -> Words | Texts:
    from tokenizers import Tokenizer

    path = path or default_tokenizer()
    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as source:
        said = json.load(source)
    normal = [x["type"] for x in (said["normalizer"] or {}).get("normalizers", [])]
    patterns = [x["pattern"]["Regex"] for x in (said["pre_tokenizer"] or {}).get("pretokenizers", []) if x["type"] == "Split" and x["behavior"] == "Removed"]
    if normal == _NORMALIZERS and patterns == [_WORD_PATTERN] and said["model"].get("end_of_word_suffix") == _WORD_END:
        return Words(tokenizer, said["model"])
    return Texts(tokenizer)


def token_ids(text: str | None, path: str | None = None) -> np.ndarray:
    """Ids of a text, without special tokens added; none for null."""
    return _tokenizer(path).ids(text) if text else np.zeros(0, np.uint32)


def with_end(text: str | None, path: str | None = None) -> np.ndarray:
    """Ids of a text and the end mark."""
    return np.append(token_ids(text, path), np.uint32(END))
