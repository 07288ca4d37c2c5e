"""Words and their hashes for whole batches of texts, in numpy.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed and carriage return.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

SPACES = b" \t\n\v\f\r"
# Texts are worked on in pieces of about so many bytes; the arrays of a piece take some forty times as much.
PIECE_BYTES = 1 << 21

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(SPACES)] = False


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """Well spread 64-bit hashes of 64-bit values: two multiply-and-shift rounds."""
    with np.errstate(over="ignore"):
        h = values.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
        return h ^ (h >> np.uint64(32))


_BYTE = mixed(np.arange(256), 11)
_BASE = np.uint64(0x5851F42D4C957F2D)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    if kind not in _powers or len(_powers[kind]) < n:
        steps = np.full(n, base, dtype=np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            _powers[kind] = np.cumprod(steps, dtype=np.uint64)
    return _powers[kind][:n]


def encoded(text: str | None) -> bytes:
    """UTF-8 of a text, null as empty."""
    return b"" if text is None else text.encode("utf-8", "replace")


def slices(batches, rows: int = 512):
    """Arrow batches cut into short ones, so that what is made of a batch stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of a byte string."""
    flags = np.zeros(len(data) + 2, dtype=np.int8)
    flags[1:-1] = _IS_WORD[np.frombuffer(data, dtype=np.uint8)]
    turns = np.diff(flags)
    return np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)


def span_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span: a polynomial over its bytes, equal wherever the span stands."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[np.frombuffer(data, dtype=np.uint8)] * _power("up", _BASE, len(data)), out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * _power("down", _BASE_INVERSE, len(data))[starts])


def cut(data: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """A long text in pieces that end between words; a single longer word stays whole."""
    at = 0
    while len(data) - at > size:
        end = at + size
        while end < len(data) and data[end] not in SPACES:
            end += 1
        yield data[at:end]
        at = end
    yield data[at:]


def word_hashes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts one after another, and where each text begins (one offset more than texts)."""
    counts, hashes = np.zeros(len(texts) + 1, dtype=np.int64), []

    def flush(blobs: list[bytes], first: int) -> None:
        data = b"\n".join(blobs)
        starts, ends = spans(data)
        hashes.append(span_hashes(data, starts, ends))
        bounds = np.cumsum([len(b) + 1 for b in blobs])
        counts[first + 1:first + 1 + len(blobs)] += np.bincount(np.searchsorted(bounds, starts, side="right"), minlength=len(blobs))

    waiting, held, first = [], 0, 0
    for i, text in enumerate(texts):
        blob = encoded(text)
        if waiting and held + len(blob) > PIECE_BYTES:
            flush(waiting, first)
            waiting, held = [], 0
        if len(blob) > PIECE_BYTES:
            for piece in cut(blob):
                flush([piece], i)
        else:
            if not waiting:
                first = i
            waiting.append(blob)
            held += len(blob) + 1
    if waiting:
        flush(waiting, first)
    return (np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)), np.cumsum(counts)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive values."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        rolled = np.zeros(n, dtype=np.uint64)
        for i in range(size):
            rolled = rolled * _BASE + hashes[i:i + n]
    return mixed(rolled, size)
