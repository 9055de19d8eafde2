"""Hashed character n-grams of whole texts, as arrays over a batch."""

from __future__ import annotations

import sys

import numpy as np

from shoalcast.llm.common import U64, mix

TABLES: dict[str, np.ndarray] = {}


def letter_table() -> np.ndarray:
    """Lower case of each code point that is a letter, 0 for the others."""
    if "letters" not in TABLES:
        out = np.zeros(sys.maxunicode + 1, np.uint32)
        for code in range(sys.maxunicode + 1):
            c = chr(code)
            if c.isalpha():
                low = c.lower()
                out[code] = ord(low) if len(low) == 1 else code
        TABLES["letters"] = out
    return TABLES["letters"]


def codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, with one separator 0 before and after each; the text of each place."""
    raw = np.frombuffer(("\0" + "\0".join(t or "" for t in texts) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t or "") + 1 for t in texts])
    owner = np.repeat(np.arange(len(texts)), lengths)
    return raw, np.append(owner, len(texts) - 1)


def hashed(symbols: np.ndarray, owner: np.ndarray, sizes: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the given sizes that lie in one text, and their texts."""
    base = U64(0x9E3779B97F4A7C15)
    wide = symbols.astype(U64)
    buckets, texts = [], []
    value = np.zeros(len(wide), U64)
    for size in range(1, max(sizes) + 1):
        n = len(wide) - size + 1
        if n <= 0:
            break
        value = value[:n] * base + wide[size - 1 :]
        if size in sizes:
            inside = owner[:n] == owner[size - 1 :]
            buckets.append((mix(value[inside] + U64(size)) >> U64(64 - bits)).astype(np.int64))
            texts.append(owner[:n][inside])
    return (np.concatenate(buckets), np.concatenate(texts)) if buckets else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def letters_only(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters, runs of anything else as one separator 0; the text of each place.  Texts
    without a letter have no place."""
    raw, owner = codes(texts)
    symbols = letter_table()[raw]
    kept = symbols != 0
    lettered = np.bincount(owner[kept], minlength=len(texts)) > 0
    kept[1:] |= symbols[:-1] != 0
    kept &= lettered[owner]
    return symbols[kept], owner[kept]
