"""Token ids of whole texts, exactly as the tokenizers library gives them for a tokenizer file.

Byte-pair encoding needs only the order of the merges. For two kinds of file the vocabulary is in that order, and the
texts go to a faster encoder over the same vocabulary: byte-level BPE with its own pattern, and lower-case BPE with
word ends, whose texts are first normalised and cut here. A file of any other kind, and a text whose characters the
two libraries may class differently, is encoded by the tokenizers library.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from array import array

import regex
import tiktoken

from fieldspark.llm.common import held


# fixed values: how these two kinds of tokenizer cut a text
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
#: The same for a lower-case text of the first 256 characters, spelt out so that the faster standard library can run it.
_LETTERS, _DIGITS, _SPACES = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", r" \t-\r\x85\xa0"
LATIN_PATTERN = rf"[{_LETTERS}]+|[{_DIGITS}]|'(?:s|t|re|ve|m|ll|d)|[^{_SPACES}{_LETTERS}{_DIGITS}]+"

#: Characters that old and new versions of Unicode class alike and whose lower case does not depend on what follows.
SETTLED = re.compile("[^\\x00-\u03a2\u03a4-\u0557\u1e00-\u208e\u20a0-\ua7ca\uac00-\ud7a3]")
BEYOND_LATIN = re.compile("[^\\x00-\xff]")
#: What ends a word on its way to the encoder; words themselves hold no white space.
LINE = "\n"

#: How byte-level vocabularies show bytes: printable ones as themselves, the others in order from 256 on.
BYTE_LETTERS = dict(zip((b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)), range(256, 512)))
_LETTER_BYTES = {chr(BYTE_LETTERS.get(b, b)): b for b in range(256)}


def entry_bytes(entry: str) -> bytes:
    """The bytes that a byte-level vocabulary entry stands for."""
    return bytes(map(_LETTER_BYTES.__getitem__, entry))


class TextTokenizer:
    """``encode(texts)`` gives the ids of each text as little-endian unsigned 32-bit bytes; no special tokens are added.

    With ``special`` their strings inside a text count as the library counts them, without they are ordinary text.
    """

    def __init__(self, path: str, special: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = not special
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.kind = _kind(spec)
        self.vocabulary, self._added = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self._special = set(self._added) if special else set()
        if self.kind == "bytes":
            ranks = {entry_bytes(e): i for e, i in self.vocabulary.items() if e not in self._added}
            self._fast = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens=self._added)
        elif self.kind == "words":
            ranks = {}
            for entry, i in self.vocabulary.items():
                if entry not in self._added:
                    end = entry.endswith(WORD_END)
                    ranks[entry_bytes(entry.removesuffix(WORD_END)) + LINE.encode() * end] = i
            # a line end is never a token of its own here, as it first merges with the byte before it
            ranks[LINE.encode()] = len(self.vocabulary)
            self._fast = tiktoken.Encoding("words", pat_str=r"[^\n]+\n", mergeable_ranks=ranks, special_tokens={})
            self._words, self._latin_words = regex.compile(WORD_PATTERN), re.compile(LATIN_PATTERN)

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.kind == "bytes":
            fast, special = self._fast.encode_to_numpy, self._special
            return [fast(t, allowed_special=special, disallowed_special=()).tobytes() for t in texts]
        if self.kind == "words":
            return [self._of_words(t) for t in texts]
        return [_packed(e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _of_words(self, text: str) -> bytes:
        if any(s in text for s in self._added):
            return _packed(self.library.encode(text, add_special_tokens=False).ids)
        if not BEYOND_LATIN.search(text):
            words = self._latin_words.findall(text.lower())
        elif not SETTLED.search(text):
            words = self._words.findall(unicodedata.normalize("NFC", text).lower())
        else:
            return _packed(self.library.encode(text, add_special_tokens=False).ids)
        if not words:
            return b""
        words.append("")
        return self._fast.encode_to_numpy(LINE.join(words), disallowed_special=()).tobytes()


def _kind(spec: dict) -> str:
    """Which encoder gives the library's ids for a tokenizer file; anything not recognised is left to the library."""
    pre, norm, model = spec.get("pre_tokenizer") or {}, spec.get("normalizer"), spec.get("model") or {}
    added = [t["content"] for t in spec.get("added_tokens") or []]
    plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec.get("added_tokens") or [])
    apart = not any(a != b and a in b for a in added for b in added)
    if not (plain and apart and model.get("type") == "BPE" and not model.get("ignore_merges") and not model.get("dropout")):
        return "whole"
    suffix = model.get("end_of_word_suffix")
    if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre["add_prefix_space"] and not suffix:
        return "bytes" if _in_merge_order(model, 256) else "whole"
    parts = pre.get("pretokenizers") or [{}]
    steps = [n["type"] for n in (norm or {}).get("normalizers", [])]
    split, last = parts[0], parts[-1]
    drops = split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert") and split["pattern"].get("Regex") == WORD_PATTERN
    level = last.get("type") == "ByteLevel" and not last.get("add_prefix_space") and not last.get("use_regex")
    if drops and level and len(parts) == 2 and steps == ["NFC", "Replace", "Lowercase"] and suffix == WORD_END:
        return "words" if _in_merge_order(model, 512) else "whole"
    return "whole"


def _in_merge_order(model: dict, first: int) -> bool:
    """Whether the ids from ``first`` on are those of the merges, in their order, so that an id is a rank."""
    vocabulary, merges = model["vocab"], model["merges"]
    joined = ("".join(m if isinstance(m, list) else m.split(" ")) for m in merges)
    return all(vocabulary.get(entry) == first + i for i, entry in enumerate(joined))


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def tokenizer(path: str, special: bool = True) -> TextTokenizer:
    """One tokenizer for each worker process."""
    return held(("tokenizer", path, special), lambda: TextTokenizer(path, special))


def version(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()
