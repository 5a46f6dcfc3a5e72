"""Hashes of words and word shingles of a text, in numpy.

Words are runs of anything but space, TAB, LF, VT, FF and CR (or another set
of gap bytes), with A-Z lower-cased. All words of a text are hashed at once: with the prefix sums of
byte * q^-i modulo 2^64, the hash of the word from s to e is
(sum[e] - sum[s]) * q^e, whatever its place in the text.
"""

from __future__ import annotations

import unicodedata

import numpy as np

_Q = 0x5851F42D4C957F2D
_Q_INVERSE = pow(_Q, -1, 2**64)
SLICE_BYTES = 1 << 20

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# For units of letters and digits only: any other ASCII character is a gap.
PUNCTUATION = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])

# Code points of scripts written without spaces between words.
_UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F),
             (0x3005, 0x3007), (0x3021, 0x3029), (0x3031, 0x303C), (0x3040, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF),
             (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA980, 0xA9FF), (0xAA60, 0xAA7F), (0xF900, 0xFAFF), (0xFF66, 0xFF9F),
             (0x16FE0, 0x18DFF), (0x1AFF0, 0x1B2FF), (0x20000, 0x3FFFF)]
_GAP, _WORD, _MARK, _ALONE = range(4)
_kinds: list[np.ndarray] = []


def _kind_table() -> np.ndarray:
    """The kind of every code point; made once per process."""
    if not _kinds:
        of = {"L": _WORD, "N": _WORD, "M": _MARK}
        table = np.array([of.get(unicodedata.category(chr(c))[0], _GAP) for c in range(0x110000)], dtype=np.uint8)
        for begin, end in _UNSPACED:
            part = table[begin:end + 1]
            digit = np.array([unicodedata.category(chr(c)) == "Nd" for c in range(begin, end + 1)])
            part[(part == _WORD) & ~digit] = _ALONE
        _kinds.append(table)
    return _kinds[0]


def spaced_words(text: str) -> str:
    """``text`` with a space for every code point that is no letter, mark or
    digit, and spaces around each letter of the scripts written without."""
    if text.isascii():
        return text
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = _kind_table()[points]
    points = np.where(kinds == _GAP, np.uint32(0x20), points)
    if (kinds == _ALONE).any():
        # A mark belongs to the letter before it.
        base = np.maximum.accumulate(np.where(kinds == _MARK, 0, np.arange(len(kinds))))
        after = np.concatenate([[False], kinds[base[:-1]] == _ALONE])
        cut = (kinds == _ALONE) | (after & (kinds == _WORD))
        points = np.insert(points, np.flatnonzero(cut), np.uint32(0x20))
    return points.tobytes().decode("utf-32-le")


_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        _powers[name] = have = np.multiply.accumulate(steps)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _slice_words(data: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    gap = np.ones(len(data) + 2, dtype=bool)
    gap[1:-1] = gaps[data]
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    begins, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(data.astype(np.uint64) * _power("down", _Q_INVERSE, len(data)), out=sums[1:])
    h = (sums[ends] - sums[begins]) * _power("up", _Q, len(data) + 1)[ends]
    sizes = ends - begins
    return mix(h + sizes.astype(np.uint64)), sizes


def word_hashes(text: str, gaps: np.ndarray = SPACES) -> np.ndarray:
    """One u64 per word, in order. ``gaps`` marks the bytes between words."""
    return sized_word_hashes(text, gaps)[0]


def sized_word_hashes(text: str, gaps: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Hash and length in bytes of each word. Long texts go slice by slice, cut
    at gaps."""
    raw = text.encode("utf-8", "surrogatepass").lower()  # bytes: only A-Z change
    data = np.frombuffer(raw, dtype=np.uint8)
    if len(data) <= SLICE_BYTES:
        return _slice_words(data, gaps)
    parts, at = [], 0
    while at < len(data):
        end = min(at + SLICE_BYTES, len(data))
        while end < len(data) and not gaps[data[end]]:
            more = np.flatnonzero(gaps[data[end:end + SLICE_BYTES]])
            end = end + int(more[0]) if len(more) else min(end + SLICE_BYTES, len(data))
        parts.append(_slice_words(data[at:end], gaps))
        at = end
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


_PLACE = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words in order; of the whole sequence if it is
    shorter; nothing without words."""
    if len(words) == 0:
        return words
    k = min(n, len(words))
    h = np.zeros(len(words) - k + 1, dtype=np.uint64)
    for j in range(k):
        h += words[j:len(words) - k + 1 + j] * _PLACE[j]
    return mix(h + np.uint64(k))
