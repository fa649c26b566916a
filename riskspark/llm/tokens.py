"""Token ids of whole texts, with a worker-side cache of words."""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

#: Characters that Python's ``str.split`` takes for blanks and tokenizers do not.
_ODD_BLANKS = re.compile("[\x1c-\x1f]")
#: Letters that lower-casing maps one to one and normalization leaves alone, then ASCII signs without an apostrophe.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")
#: A full stop or comma next to another sign, with which it is one pre-token.
_SIGN_BY_SIGN = re.compile(r"[.,](?:(?=[^\w\s]|_)|(?<=[^\w\s].)|(?<=_.))")
_PROBES = ("a", "The", "thention", "Éeuxè.", "STRASSE!!", "straße,", "x***", "of%%%", "ÑAñÿ", "word#$&|<>", "Über-", "niño;", "lower_", "z(~)")
CACHED_WORDS = 300_000


class _Known(dict):
    """Values by key, made by ``make`` when first asked for. Of what is full, the last ``limit`` keys stay at hand."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        self[key] = value = self.make(key) if value is None else value
        return value

    def trim(self):
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()


class WordEncoder:
    """Ids under a tokenizer whose pre-tokens never contain white space, so that words can be encoded apart.

    ``encode`` gives each text's ids as little-endian bytes of ``dtype``.
    Words met before come from a bounded cache. Where that gives what the whole
    tokenizer gives for some probe words, texts are lower-cased first (Latin-1
    texts, whose letters have no other forms), full stops and commas that stand alone are
    parted from words, and a word of plain letters and signs goes to the
    tokenizer's model in those two parts, without its normalizer; other words
    go through the whole tokenizer.
    Strings of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str, dtype: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.dtype = Tokenizer.from_file(path), np.dtype(dtype)
        self.tokenizer.encode_special_tokens = True
        if self.tokenizer.get_vocab_size() > np.iinfo(self.dtype).max + 1:
            raise ValueError(f"{dtype} does not hold every id of {path}")
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: byte_level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.model = self.tokenizer.model
        ids = np.arange(np.iinfo(self.dtype).max + 1 if self.dtype.itemsize <= 2 else self.tokenizer.get_vocab_size())
        self.bytes_of = [x.tobytes() for x in ids.astype(self.dtype)]
        self.words = _Known(self._word, CACHED_WORDS)
        self.plain = True
        self.plain = all(self.encode([w])[0] == self._whole(w) for w in (*_PROBES, " ".join(_PROBES)))
        self.words.clear()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _word(self, word: str) -> bytes:
        if not self.plain or not (m := _PLAIN.fullmatch(word)):
            return self._whole(word)
        letters, signs = m.groups()
        if letters and signs:
            return self.words[letters] + self.words[signs]
        mapped = signs or letters.lower()
        if not mapped.isascii():
            mapped = mapped.translate(self.letters)
        return b"".join([self.bytes_of[t.id] for t in self.model.tokenize(mapped)])

    def _split(self, text: str) -> list[str]:
        if self.plain:
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return text.split()
            text = text.lower()
            if not _SIGN_BY_SIGN.search(text):
                text = text.replace(",", " , ").replace(".", " . ")
        return text.split()

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for t in texts:
            self.words.trim()
            out.append(self._whole(t) if _ODD_BLANKS.search(t) else b"".join(map(self.words.__getitem__, self._split(t))))
        return out


@lru_cache(maxsize=2)
def encoder(path: str, dtype: str = "<u2") -> WordEncoder:
    """One encoder per Python worker and tokenizer."""
    return WordEncoder(path, dtype)
