"""Exact, cached encoding with the tokenizers library.

Both vocabularies split a text into pieces before merging, and each piece is encoded by itself, so a piece's ids can be
kept. Texts of plain characters are split here with ``re``; any text with other characters, and any that may hold a
special token's string, goes to the library whole. Pieces that are not kept yet go to the library too.
"""

from __future__ import annotations

import os
import re
import struct

import numpy as np

from quireflow.llm.common import worker_kept

#: Letters that both the library and this module treat as letters, and characters that both treat as neither letter, digit nor space.
LETTERS = "A-Za-zÀ-ÖØ-öø-įıĲ-ſ"
SAFE = re.compile(r"[\t\n\r -~¡-©«¬®-±´¶-¸»¿-įı-ſ‐-‧€]*")
#: The libraries' split rules, with the commonest case first: the cases begin with different characters, so their order is free but for the last ones.
SPLITS = {
    "byte": r" ?[L]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^\sL0-9]+|\s+(?!\S)|\s+".replace("L", LETTERS),
    "word": r"[L]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sL0-9]+".replace("L", LETTERS),
}
#: Pieces kept by a worker at most, and the longest piece kept.
KEPT, LONGEST = 500_000, 48


def vocabulary(name: str) -> str:
    """Path of a vocabulary file, where the workers find it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Pieces(dict):
    def __init__(self, encode) -> None:
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = _packed(self.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= LONGEST:
            if len(self) >= KEPT:
                self.clear()
            self[piece] = ids
        return ids


class _Sizes(dict):
    def __init__(self, encode) -> None:
        self.encode = encode

    def __missing__(self, piece: str) -> int:
        n = len(self.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= LONGEST:
            if len(self) >= KEPT:
                self.clear()
            self[piece] = n
        return n


class CachedEncoder:
    """Gives a text's ids as little-endian unsigned 32-bit bytes, equal to the library's for every text."""

    def __init__(self, path: str, kind: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(path)
        # for single pieces the library need neither normalise nor split again
        single = Tokenizer.from_file(path)
        single.normalizer, single.pre_tokenizer = None, ByteLevel(add_prefix_space=False, use_regex=False)
        self.findall, self.lower = re.compile(SPLITS[kind]).findall, kind == "word"
        self.pieces, self.sizes = _Pieces(single.encode), _Sizes(single.encode)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if "<|" in text or not SAFE.fullmatch(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.pieces.__getitem__, self.findall(text.lower() if self.lower else text)))

    def count(self, text: str | None) -> int:
        """The number of a text's ids."""
        if not text:
            return 0
        if "<|" in text or not SAFE.fullmatch(text):
            return len(self.library.encode(text, add_special_tokens=False).ids)
        return sum(map(self.sizes.__getitem__, self.findall(text.lower() if self.lower else text)))


def encoders(files: list[tuple[str, str]]) -> list[CachedEncoder]:
    """An encoder for each (vocabulary, kind) in a Python worker."""
    return worker_kept(f"encoders:{files}", lambda: [CachedEncoder(*f) for f in files])


def encoder(path: str, kind: str) -> CachedEncoder:
    """One encoder for a vocabulary in a Python worker."""
    return worker_kept(f"{kind}:{path}", lambda: CachedEncoder(path, kind))
