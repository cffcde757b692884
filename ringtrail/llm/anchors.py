"""Anchors: few positions that windows with equal content agree on.

The anchor of a window is the gram (a shorter run of units) in it with the least hash, the first of
equal ones. It depends on the window's content alone, so windows that are equal anywhere have equal
anchors, at the same distance from their start. Comparing anchors instead of all windows finds
every repeat and moves a small part of the data. Units are bytes or the hashes of words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Units that are hashed at one go.
AT_ONCE = 1 << 20
_PLACE = np.uint64(24)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def gram_hashes(units: np.ndarray, length: int) -> np.ndarray:
    """A hash of the `length` units from each place on."""
    have, hashes = 1, mixed(units.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    while have < length:
        step = min(have, length - have)
        hashes = mixed(
            hashes[: len(hashes) - step] * np.uint64(0xFF51AFD7ED558CCD) + hashes[step:] + np.uint64(step)
        )
        have += step
    return hashes


def least_of(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of the `width` keys from each place on."""
    have = 1
    while have < width:
        step = min(have, width - have)
        keys = np.minimum(keys[: len(keys) - step], keys[step:])
        have += step
    return keys


def anchors(units: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For the window at each place: where its anchor is, and the hashes of all grams.

    At most 2**24 units.
    """
    hashes = gram_hashes(units, gram)
    place = np.arange(len(hashes), dtype=np.uint64)
    keys = (hashes >> _PLACE << _PLACE) | place
    found = least_of(keys, window - gram + 1) & np.uint64((1 << 24) - 1)
    return found.astype(np.int64), hashes


def pieces(length: int, window: int) -> Iterator[tuple[int, int]]:
    """Begin and end of parts of a long document that share `window` - 1 units, so that every
    window is in exactly one."""
    step = AT_ONCE - window + 1
    for begin in range(0, max(length - window + 1, 0), step):
        yield begin, min(begin + AT_ONCE, length)


class Batch:
    """Parts of documents laid one after another, with the windows that lie within one part."""

    def __init__(self, parts: list[tuple[int, int, np.ndarray]], window: int, gram: int):
        self.rows = np.array([p[0] for p in parts], np.int64)
        self.begins = np.array([p[1] for p in parts], np.int64)
        sizes = np.array([len(p[2]) for p in parts], np.int64)
        self.units = np.concatenate([p[2] for p in parts])
        self.first = np.cumsum(sizes) - sizes
        self.part = np.repeat(np.arange(len(parts)), sizes)
        at, self.hashes = anchors(self.units, window, gram)
        self.start = np.flatnonzero(self.part[: len(at)] == self.part[window - 1 :][: len(at)])
        self.anchor = at[self.start]

    def place(self, at: np.ndarray) -> np.ndarray:
        """Place in the document of a place in the batch."""
        part = self.part[at]
        return at - self.first[part] + self.begins[part]


def batches(docs: Iterable[tuple[int, np.ndarray]], window: int, gram: int) -> Iterator[Batch]:
    """Batches of about `AT_ONCE` units over all (row, units). Documents shorter than a window are
    left out."""
    parts, size = [], 0
    for row, units in docs:
        for begin, end in pieces(len(units), window):
            parts.append((row, begin, units[begin:end]))
            size += end - begin
            if size >= AT_ONCE:
                yield Batch(parts, window, gram)
                parts, size = [], 0
    if parts:
        yield Batch(parts, window, gram)
