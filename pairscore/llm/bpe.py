"""BPE encoding by forced-boundary splitting, and decoding.

A merge can only join two neighbouring symbols if the pair occurs inside some vocabulary token. So where a word has a
pair of symbols that no token holds, no token can ever reach across: a certain cut. Words are split at all their
certain cuts, each fragment is encoded on its own by the library's merge model, and the fragments' ids are put together.
A worker remembers the ids of the strings it met most lately, in bounded number.

Text is handled as the tokenizers library does for a file with NFC, white-space and lower-case normalisers, a splitting
pattern and byte-level symbols with an end-of-word mark: special tokens in a raw text are cut out first; then the rest
is normalised and split into words. Texts with only characters below U+0300, where NFC does nothing and one character's
lower case depends on no other, are split directly; for any other the library's own normaliser and splitter serve.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from .common import map_text, remembers

#: Texts of letters, digits, full stops and commas: there a mark that stands alone after a string is a word of its own, and
#: is set apart before strings are looked up, as they repeat more often without it.
_PLAIN = re.compile(r"[ \t\n\r\x0b\x0cA-Za-z0-9À-ÖØ-öø-įı-ʯ.,]*")
_RUNS = ("..", ",,", ".,", ",.")
_SIMPLE = re.compile(r"[\x00-\x1b\x20-˿]*")
#: White-space separated strings whose ids a worker remembers: when so many are new, the last so many become the old
#: ones, and older ones are forgotten.
STRINGS_KEPT = 700_000
_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def byte_symbols() -> list[str]:
    """A printable character for each byte, by the byte-level rule: printable Latin-1 stands for itself, the others get
    the characters from U+0100 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in set(printable) else chr(next(others)) for b in range(256)]


class _Met(dict):
    """Strings just met, with their ids as bytes; ``make`` gives those of others."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, s: str) -> bytes:
        return self.make(s)


class ForcedCutEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.library = Tokenizer.from_file(path)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        #: encoders for a fragment within a word, and for one at its end
        self.inner = BPE(self.vocab, merges)
        self.final = self.library.model
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*self.vocab.values(), *self.special.values()]) + 1)
        for token, i in (*self.vocab.items(), *self.special.items()):
            self.tokens[i] = token
        self.inside = {pair for token in self.vocab for pair in self._pairs(token)}
        # the letters without which a word of plain letters has no cut
        cut = [(a, b) for a in _LETTERS for b in _LETTERS if a + b not in self.inside or a + b + self.end not in self.inside]
        cover = ""
        while left := [p for p in cut if not set(p) & set(cover)]:
            cover += max(_LETTERS, key=lambda c: sum(c in p for p in left))
        self.may_cut = re.compile(f"[{cover}]" if cover else "(?!)")
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.id_bytes = [i.to_bytes(4, "little") for i in range(len(self.tokens))]
        self.symbol = byte_symbols()
        self.table = {b: s for b, s in enumerate(self.symbol)}
        self.forget()

    def _pairs(self, token: str) -> Iterator[str]:
        """Neighbouring symbols inside a token, as strings; the last symbol of a word-final token bears the mark."""
        final = bool(self.end) and token.endswith(self.end) and len(token) > len(self.end)
        body = token.removesuffix(self.end) if final else token
        for i in range(1, len(body)):
            yield body[i - 1 : i + 1] + (self.end if final and i == len(body) - 1 else "")

    def word_ids(self, word: str) -> list[int]:
        """Ids of a word given in byte-level symbols: cut where no token reaches across, encode each fragment."""
        at, ids = 0, []
        for i in range(1, len(word)):
            pair = word[i - 1 : i + 1]
            if (pair + self.end if i == len(word) - 1 else pair) not in self.inside:
                ids += [t.id for t in self.inner.tokenize(word[at:i])]
                at = i
        return ids + [t.id for t in self.final.tokenize(word[at:])]

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            if not self.may_cut.search(word):
                return b"".join([self.id_bytes[t.id] for t in self.final.tokenize(word)])
        else:
            word = word.encode().decode("latin-1").translate(self.table)
        return b"".join([self.id_bytes[i] for i in self.word_ids(word)])

    def _string(self, s: str) -> bytes:
        """Ids, as bytes, of a lower-case string without white space that is not among those just met."""
        found = self.older.get(s)
        if found is None:
            found = self._word(s) if s.isalpha() else b"".join(map(self._word, self.pattern.findall(s)))
        if len(self.strings) >= STRINGS_KEPT:
            self.older, self.strings = self.strings, _Met(self._string)
        self.strings[s] = found
        return found

    def forget(self) -> None:
        self.strings, self.older = _Met(self._string), {}

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers; null is as empty."""
        out: list[bytes] = []
        for part in self.cut_special.split(text or "") if self.cut_special else [text or ""]:
            if part in self.special:
                out.append(self.id_bytes[self.special[part]])
            elif _SIMPLE.fullmatch(part):
                if _PLAIN.fullmatch(part) and not any(r in part for r in _RUNS):
                    part = part.replace(". ", " . ").replace(", ", " , ").replace(".\n", " . ").replace(",\n", " , ")
                out.append(b"".join(map(self.strings.__getitem__, part.lower().split())))
            elif part:
                for word, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part)):
                    out += [self.id_bytes[i] for i in self.word_ids(word)]
        return b"".join(out)

    def decode(self, ids) -> str:
        """The library's text for ids where a file names no decoder: tokens with a space between."""
        return " ".join(map(self.tokens.__getitem__, ids))


def where(path: str) -> str:
    """A vocabulary file here: the path itself or, where this machine has none there, the public tokenizers' file of that
    name. Called on the worker, whose folders may be others than the driver's."""
    if os.path.exists(path):
        return path
    import public_tokenizers

    return public_tokenizers.path(os.path.basename(path))


@lru_cache(maxsize=1)
def encoder(path: str) -> ForcedCutEncoder:
    """One encoder a worker process: what it remembers serves all batches of a task, and the next tasks' too, until another
    operator's task needs the memory."""
    made = ForcedCutEncoder(where(path))
    _MADE.append(made)
    return made


_MADE: list[ForcedCutEncoder] = []


@remembers
def forget_strings() -> None:
    for made in _MADE:
        made.forget()


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` (binary: little-endian unsigned 32-bit) for each row; null and empty texts have no ids. Rows with
    a null or repeated doc_id come back as they are; other columns are ignored; an empty table gives an empty result."""

    def make():
        enc = encoder(path)
        return lambda texts: [[enc.encode(t) for t in texts]]

    return map_text(docs, "text", ["doc_id"], "ids binary", make, forget_strings)


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: the round trip of each text, as digests. Ids do not leave the
    worker, so nothing as large as the corpus is moved."""
    import hashlib

    def make():
        enc = encoder(path)

        def digests(texts):
            sizes, coded, decoded = [], [], []
            for t in texts:
                ids = enc.encode(t)
                sizes.append(len(ids) // 4)
                coded.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(enc.decode(np.frombuffer(ids, "<u4").tolist()).encode("utf-8")).hexdigest())
            return sizes, coded, decoded

        return digests

    return map_text(docs, "text", ["doc_id"], "n_tokens long, ids_sha256 string, decoded_sha256 string", make, forget_strings)
