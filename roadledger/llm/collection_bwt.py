"""Column-wise construction of the Burrows-Wheeler transform and the common prefixes of a collection of strings.

Every round puts the next symbol (from the right) of every string into the transform: it fills the place the string's
last suffix holds, and the counts of the symbol before that place say where the longer suffix belongs. The transform
and the common prefixes live in two files that each round reads once to count and once to merge, block by block. Files of
small collections are kept in memory: every round writes them anew, which is hundreds of times their size.
A prefix is the least of the prefixes since the symbol's previous place, plus one.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext

import numpy as np

#: Entries of the files that are in memory at a time.
BLOCK = 1 << 20
#: Symbols of a collection up to which its files are in memory; there are five, of a byte a symbol.
HELD = 8 << 20
#: Common prefixes are held in a byte and stop at this.
MOST = 255
_FAR = 1 << 30


class Files:
    """The two files of a collection, replaced as a whole every round; on disk if ``folder`` names one."""

    def __init__(self, folder: str | None):
        self.folder, self.round = folder, 0
        self.held: dict[str, bytearray] = {}

    def _name(self, name: str, round_: int) -> str:
        return f"{name}-{round_ % 2}"

    def blocks(self, name: str, round_: int = 0, block: int = BLOCK) -> Iterator[np.ndarray]:
        name = self._name(name, round_)
        if self.folder is None:
            held = np.frombuffer(self.held[name], np.uint8)
            for low in range(0, len(held), block):
                yield held[low:low + block].copy()
            return
        with open(os.path.join(self.folder, name), "rb") as file:
            while len(part := np.fromfile(file, np.uint8, block)):
                yield part

    @contextmanager
    def replaced(self, name: str, round_: int = 0) -> Iterator[Callable[[bytes], object]]:
        """Gives what writes the next part of the file."""
        name = self._name(name, round_)
        if self.folder is None:
            self.held[name] = bytearray()
            yield self.held[name].extend
        else:
            with open(os.path.join(self.folder, name), "wb") as file:
                yield file.write

    def read(self, name: str, block: int = BLOCK) -> Iterator[np.ndarray]:
        return self.blocks(name, self.round, block)

    def whole(self, name: str) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint8), *self.read(name)])


def _least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of values[low:high] for every pair; ranges hold one value at least."""
    ends = np.empty(2 * len(low), np.int64)
    ends[0::2], ends[1::2] = low, high
    return np.minimum.reduceat(np.append(values, MOST), ends)[0::2]


def _next_round(files: Files, place: np.ndarray, symbol: np.ndarray, block: int) -> np.ndarray:
    """Fills ``symbol`` in at ``place`` (ascending) and inserts the longer suffixes; gives back their places."""
    seen = np.zeros(256, np.int64)  # of each symbol so far
    since = np.full(256, _FAR, np.int64)  # least prefix since its last place
    fresh = np.zeros(256, bool)  # was its last place filled in this round
    rank, prefix = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
    later: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # symbol, rank, prefix of old suffixes after new ones
    base = first = 0
    with files.replaced("filled") as fill:
        for text, common in zip(files.read("bwt", block), files.read("lcp", block)):
            last = first + int(np.searchsorted(place[first:], base + len(text)))
            at, new = place[first:last] - base, symbol[first:last]
            text[at] = new
            fill(text.tobytes())
            is_new = np.zeros(len(text), bool)
            is_new[at] = True
            order = np.argsort(text, kind="stable")
            sorted_text = text[order]
            counts = np.bincount(text, minlength=256)
            starts = np.cumsum(counts) - counts
            where = np.empty(len(text), np.int64)
            where[order] = np.arange(len(text))

            # Places that look back: those filled now, and old ones whose symbol was filled in just before.
            index = where[at]
            after = index + 1
            after = after[(after < len(text))]
            after = after[(sorted_text[after] == sorted_text[after - 1]) & ~is_new[order[after]]]
            heads = starts[(counts > 0) & fresh]  # first place of a symbol whose last place is in an earlier block
            heads = heads[(sorted_text[heads] > 0) & ~is_new[order[heads]]]
            looks = np.concatenate([index, after, heads])
            here, kind = order[looks], sorted_text[looks].astype(np.int64)
            inside = looks > starts[kind]
            found = np.full(len(looks), -1, np.int64)
            if inside.any():
                found[inside] = _least(common, order[looks[inside] - 1] + 1, here[inside] + 1)
            if (~inside).any():
                running = np.minimum.accumulate(common).astype(np.int64)
                outer = ~inside & (seen[kind] > 0)
                found[outer] = np.minimum(since[kind[outer]], running[here[outer]])
            found = np.minimum(found + 1, MOST)
            ranks = seen[kind] + looks - starts[kind]
            rank[first:last], prefix[first:last] = ranks[:len(at)], found[:len(at)]
            later.append((kind[len(at):], ranks[len(at):], found[len(at):]))

            behind = np.append(np.minimum.accumulate(common[::-1])[::-1].astype(np.int64), _FAR)
            present = np.nonzero(counts)[0]
            ends = order[starts[present] + counts[present] - 1]
            since = np.minimum(since, behind[0])
            since[present] = behind[ends + 1]
            fresh[present] = is_new[ends]
            seen += counts
            base, first = base + len(text), last
    # The empty suffixes come first, one for each place that holds no symbol of its own yet or ever.
    total = seen.copy()
    total[0] = files.strings
    offset = np.cumsum(total) - total
    new_place = offset[symbol] + rank
    kinds, ranks, prefixes = (np.concatenate(part) for part in zip(*later))
    changed = offset[kinds] + ranks
    _merge(files, new_place, prefix, changed, prefixes, block)
    return new_place


def _merge(files: Files, new_place: np.ndarray, prefix: np.ndarray, changed: np.ndarray, prefixes: np.ndarray,
           block: int) -> None:
    """Writes the next pair of files: old entries in order, new ones at their places, changed prefixes replaced."""
    order = np.argsort(new_place, kind="stable")
    target, prefix = new_place[order], prefix[order].astype(np.uint8)
    before = target - np.arange(len(target))  # old entries in front of each new one
    order = np.argsort(changed, kind="stable")
    changed, prefixes = changed[order], prefixes[order].astype(np.uint8)
    base = done = first = 0
    with files.replaced("bwt", files.round + 1) as bwt, files.replaced("lcp", files.round + 1) as lcp:
        for text, common in zip(files.blocks("filled", block=block), files.read("lcp", block)):
            end = base + len(common)
            last = first + int(np.searchsorted(before[first:], end))
            at = before[first:last] - base
            text, common = np.insert(text, at, 0), np.insert(common, at, prefix[first:last])
            low, high = np.searchsorted(changed, [done, done + len(common)])
            common[changed[low:high] - done] = prefixes[low:high]
            bwt(text.tobytes())
            lcp(common.tobytes())
            base, first, done = end, last, done + len(common)
        if first < len(target):
            bwt(bytes(len(target) - first))
            lcp(prefix[first:].tobytes())
    files.round += 1


def build(strings: list[bytes], folder: str | None, block: int = BLOCK) -> tuple[Files, np.ndarray]:
    """The files of a collection of strings (without the byte 0xFF), and the place of every whole string."""
    files = Files(folder)
    files.strings = len(strings)
    for name in ("bwt", "lcp"):
        with files.replaced(name) as write:
            write(bytes(len(strings)))
    length = np.array([len(s) for s in strings], np.int64)
    joined = np.frombuffer(b"".join(strings), np.uint8)
    ends = np.cumsum(length)
    place = np.arange(len(strings))
    for column in range(int(length.max(initial=0))):
        active = np.nonzero(length > column)[0]
        active = active[np.argsort(place[active], kind="stable")]
        symbol = joined[ends[active] - 1 - column] + np.uint8(1)
        new = _next_round(files, place[active], symbol, block)
        if len(active) < len(strings):  # whole strings move with what is put in before them
            target = np.sort(new)
            idle = np.nonzero(length <= column)[0]
            place[idle] += np.searchsorted(target - np.arange(len(target)), place[idle], side="right")
        place[active] = new
    return files, place


def repeated_windows(strings: list[bytes], windows: np.ndarray, size: int, block: int = BLOCK, held: int = HELD) -> list[np.ndarray]:
    """For each string and each of its first ``windows`` places: does the ``size``-byte string there start anywhere else
    in the collection too. Collections of more than ``held`` symbols use files of the task's scratch folder."""
    if size > MOST:
        raise ValueError(f"common prefixes are held up to {MOST}")
    small = sum(map(len, strings)) + len(strings) <= held
    with nullcontext() if small else tempfile.TemporaryDirectory(prefix="bwt-") as folder:
        files, place = build(strings, folder, block)
        bwt, lcp = files.whole("bwt"), files.whole("lcp")
    far = np.append(lcp >= size, False)
    shared = far[:-1] | far[1:]
    # Dropping a suffix's first symbol leads to the place that holds this symbol.
    order = np.argsort(bwt, kind="stable")[np.count_nonzero(bwt == 0):]
    out = np.zeros((len(strings), int(windows.max(initial=0))), bool)
    for step in range(out.shape[1]):
        active = np.nonzero(windows > step)[0]
        out[active, step] = shared[place[active]]
        longer = active[windows[active] > step + 1]
        place[longer] = order[place[longer] - len(strings)]
    return [line[:n] for line, n in zip(out, windows)]
