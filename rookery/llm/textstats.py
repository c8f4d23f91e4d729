"""Counts of one text, taken from its UTF-8 bytes; small helpers of the Arrow stages."""

from __future__ import annotations

from itertools import count

import numpy as np

# The character classes that the rules tell apart.
SYMBOLS = b"#*$%&|<>"
PUNCTUATION = b".,;:'\"!?()-"
CLASSES = ("lower", "upper", "digit", "space", "punctuation", "symbol", "other")


def _classes() -> np.ndarray:
    """Class of each byte; bytes that only continue a character have none (-1)."""
    of = np.full(256, 5, np.int64)
    of[ord("a") : ord("z") + 1] = 0
    of[ord("A") : ord("Z") + 1] = 1
    of[ord("0") : ord("9") + 1] = 2
    of[[9, 10, 11, 12, 13, 32]] = 3
    of[list(PUNCTUATION)] = 4
    of[128:192] = -1
    of[192:] = 6
    return of


BYTE_CLASS = _classes()
#: Letters in lower case, all other ASCII characters as spaces.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def byte_counts(data: bytes) -> np.ndarray:
    return np.bincount(np.frombuffer(data, np.uint8), minlength=256)


def class_counts(counts: np.ndarray) -> np.ndarray:
    held = BYTE_CLASS >= 0
    return np.bincount(BYTE_CLASS[held], weights=counts[held], minlength=len(CLASSES)).astype(np.int64)


def word_ids(words: list[bytes]) -> np.ndarray:
    """For each word the place of its first occurrence."""
    seen: dict[bytes, int] = {}
    return np.fromiter(map(seen.setdefault, words, count()), np.int64, len(words))


def repeated_windows(ids: np.ndarray) -> np.ndarray:
    """Which windows of three words occur at least twice."""
    n = len(ids)
    if n < 4:
        return np.zeros(max(n - 2, 0), bool)
    if n < 1 << 21:
        keys = (ids[:-2] * n + ids[1:-1]) * n + ids[2:]
    else:
        pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1]
        keys = pairs[:-1] * n + ids[2:]
    order = np.argsort(keys, kind="stable")
    same = np.diff(keys[order]) == 0
    repeated = np.zeros(n - 2, bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    return repeated


def covered_words(windows: np.ndarray, n_words: int) -> int:
    """Words that stand in at least one of the marked windows."""
    if not windows.any():
        return 0
    covered = np.zeros(n_words, bool)
    for shift in range(3):
        covered[shift : shift + len(windows)] |= windows
    return int(covered.sum())


def duplicate_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in data.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))
