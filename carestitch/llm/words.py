"""Words, word shingles and hashes of whole texts, as numpy arrays over many documents at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that are worked on together; a longer text is worked on alone.
CHUNK_BYTES = 2 << 20
#: Words that a worker remembers in each place; see ``Known``.
MOST_KNOWN = 1 << 16


class Known(dict):
    """What ``make`` says of a word, made once in a while.

    Spark's Python workers live on and serve later stages too, so what is remembered stays beside their memory: it is
    dropped whenever it reaches ``MOST_KNOWN`` words, inside a text as well. Frequent words are soon back.
    """

    def __init__(self, make: Callable[[bytes], object]):
        self.make = make

    def __missing__(self, word: bytes):
        if len(self) >= MOST_KNOWN:
            self.clear()
        self[word] = value = self.make(word)
        return value


_CODES = Known(xxhash.xxh3_64_intdigest)


def mix(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit value for each 64-bit value (the public splitmix64 finaliser)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(text: str | None) -> list[bytes]:
    """Words between white space (space and U+0009 to U+000D), A-Z in lower case; none for null."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def codes(found: list[bytes]) -> np.ndarray:
    """A 64-bit code of each word."""
    return np.array([_CODES[w] for w in found], np.uint64)


def chunks(batches: Iterator[pa.RecordBatch], text: str, most_rows: int = 4000) -> Iterator[pa.RecordBatch]:
    """Slices of some megabytes of text and at most ``most_rows`` rows."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and (total + size > CHUNK_BYTES or i - start >= most_rows):
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def shingles(texts: list[str | None], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each text's distinct shingles of ``k`` words, sorted; a text of fewer words is one shingle.

    Hashes have 52 bits, texts are numbered from 0 (below 4096), so both fit one sorted 64-bit key.
    """
    found = [words(t) for t in texts]
    n = np.array([len(w) for w in found], np.int64)
    flat = codes([w for ws in found for w in ws])
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), n)
    starts = np.cumsum(n) - n
    hashes = np.zeros(max(0, len(flat) - k + 1), np.uint64)
    if len(hashes):
        for i in range(k):
            hashes = mix(hashes * np.uint64(0xD6E8FEB86659FD93) ^ flat[i:i + len(hashes)])
    last = starts[owner.astype(np.int64)] + n[owner.astype(np.int64)] - k if len(flat) else np.zeros(0, np.int64)
    inside = np.flatnonzero(np.arange(len(hashes)) <= last[:len(hashes)])
    key = [(owner[inside] << np.uint64(52)) | (hashes[inside] >> np.uint64(12))]
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for i in range(k - 1):
            more = n[short] > i
            whole[more] = mix(whole[more] * np.uint64(0xC2B2AE3D27D4EB4F) ^ flat[starts[short[more]] + i])
        key.append((short.astype(np.uint64) << np.uint64(52)) | (mix(whole + n[short].astype(np.uint64)) >> np.uint64(12)))
    key = np.sort(np.concatenate(key))
    if len(key):
        key = key[np.concatenate(([True], key[1:] != key[:-1]))]
    return (key >> np.uint64(52)).astype(np.int64), key & np.uint64((1 << 52) - 1)
