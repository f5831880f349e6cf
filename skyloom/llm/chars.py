"""Texts of many rows as one array of code points, so that numpy can treat a block of them at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Characters treated at a time within a task; a longer text is a block of its own.
BLOCK_CHARS = 1 << 20
LIMIT = 0x110000


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Runs of rows with their texts (null as empty), about BLOCK_CHARS characters each."""
    for b in batches:
        texts = [t or "" for t in b.column(column).to_pylist()]
        start = size = 0
        for k, t in enumerate(texts):
            if size and size + len(t) > BLOCK_CHARS:
                yield b.slice(start, k - start), texts[start:k]
                start, size = k, 0
            size += len(t)
        if start < len(texts):
            yield b.slice(start), texts[start:]


def code_points(texts: list[str]) -> np.ndarray:
    """The code points of the texts, a 0 before the first and after each; zeros within texts become blanks."""
    joined = "\0" + "\0".join(t.replace("\0", " ") if "\0" in t else t for t in texts) + "\0"
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)


_TABLES: dict[str, np.ndarray] = {}


def word_table() -> np.ndarray:
    """For each code point: itself in lower case if it is a letter or digit, 0 for the text separator, else a blank."""
    if "word" not in _TABLES:
        table = np.full(LIMIT, 32, np.uint32)
        for c in range(LIMIT):
            ch = chr(c)
            if ch.isalnum():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else ord(low[0])
        table[0] = 0
        _TABLES["word"] = table
    return _TABLES["word"]


def words_only(codes: np.ndarray) -> np.ndarray:
    """Lower-case runs of letters and digits with one blank between them; separators stay, without blanks beside them."""
    c = word_table()[codes]
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 32) | ((c[:-1] != 32) & (c[:-1] != 0))
    c = c[keep]
    edge = np.zeros(len(c), bool)
    edge[:-1] = (c[:-1] == 32) & (c[1:] == 0)
    return c[~edge]


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    key = f"{base}"
    if key not in _TABLES or len(_TABLES[key]) < n:
        size = max(n, BLOCK_CHARS + 1024)
        out = np.empty(size, np.uint64)
        out[0] = 1
        filled, step = 1, base % (1 << 64)
        while filled < size:
            m = min(filled, size - filled)
            np.multiply(out[:m], np.uint64(step), out=out[filled : filled + m])
            filled, step = filled + m, step * step % (1 << 64)
        _TABLES[key] = out
    return _TABLES[key][:n]


def gram_sums(codes: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``gram_hashes`` reads the hash of any run of characters."""
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(codes)), out=out[1:])
    return out


def gram_hashes(sums: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of each run of ``q`` characters, by its first character; equal runs have equal hashes."""
    n = len(sums) - 1 - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = (sums[q:] - sums[:-q]) * _powers(_INVERSE, n)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h
