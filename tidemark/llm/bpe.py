"""Byte-level BPE ids, the same as the tokenizers library gives for a byte-level vocabulary file."""

from __future__ import annotations

import json
import re

import numpy as np
import tiktoken

from tidemark.llm.common import once_per_worker

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
#: The public pre-token rule of byte-level BPE, with possessive repeats where nothing can be given back.
_SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: A space after something that is not white space always begins a pre-token.
_SAFE_CUT = re.compile(r"(?<=\S) ")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_VOCABULARY)


def _byte_of_letter() -> dict[str, int]:
    """Byte-level files write printable bytes as they are and the others as letters from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _read(path: str) -> tiktoken.Encoding:
    with open(path, encoding="utf-8") as file:
        parsed = json.load(file)
    special = {t["content"] for t in parsed["added_tokens"]}
    letters = _byte_of_letter()
    ranks = {bytes(letters[c] for c in token): i for token, i in parsed["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding(path, pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})


def encoder(path: str) -> tiktoken.Encoding:
    return once_per_worker(f"bpe:{path}", lambda: _read(path))


def ids(path: str, text: str | None) -> np.ndarray:
    return np.array(encoder(path).encode_ordinary(text), "<u4") if text else np.empty(0, "<u4")


def count(path: str, text: str) -> int:
    return len(encoder(path).encode_ordinary(text))


def safe_cuts(text: str, every: int) -> list[int]:
    """Starts of pieces of at least ``every`` characters that can be encoded apart."""
    cuts, at = [0], 0
    while m := _SAFE_CUT.search(text, at + every):
        cuts.append(at := m.start())
    return cuts
