"""Word shingles of texts as 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

_u64 = np.uint64
_WORDS_KEPT = 300_000


class _Hashes(dict):
    """Hash of each word met; emptied when it grows too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _WORDS_KEPT:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = _Hashes()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _u64(33))) * _u64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _u64(29))) * _u64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _u64(32))


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.encode().lower().split() if text else []


def word_hashes(lists: list[list[bytes]]) -> np.ndarray:
    get = _hashes.__getitem__
    return np.fromiter((get(w) for ws in lists for w in ws), np.uint64, sum(map(len, lists)))


def shingle_sets(texts: list[str | None], size: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    A text with fewer words is one shingle, its whole sequence; one without words has none.
    """
    lists = [words(t) for t in texts]
    count = np.fromiter(map(len, lists), np.int64, len(lists))
    h = word_hashes(lists)
    odd = mix(np.arange(1, size + 1, dtype=np.uint64)) | _u64(1)
    grams = np.zeros(max(len(h) - size + 1, 0), np.uint64)
    for k in range(size):
        grams += h[k:k + len(grams)] * odd[k]
    grams = mix(grams)
    out = []
    at = 0
    for n in count.tolist():
        if n >= size:
            s = np.sort(grams[at:at + n - size + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif n:
            short = (h[at:at + n] * odd[:n]).sum(dtype=np.uint64) + _u64(n)
            out.append(mix(mix(np.array([short], np.uint64))))
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out
