"""Results by word, remembered within a Python worker up to a fixed number of words."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Sequence
from itertools import chain, repeat
from typing import TypeVar

import numpy as np
import pyarrow as pa

T = TypeVar("T")


_held: dict[tuple, object] = {}


def held(key: tuple, make: Callable[[], T]) -> T:
    """The model of ``key``, made on first use; a worker process keeps one model at a time."""
    if key not in _held:
        forget()
        _held[key] = make()
        # What only its making took.
        _release()
    return _held[key]


def forget() -> None:
    """Drops the model of an earlier stage and gives a worker's free memory back to the system.

    Workers outlive their stage, and what its batches and model took stays with the process otherwise.
    """
    _held.clear()
    _release()


def _release() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        # Only the GNU library has it.
        pass


class _Index(dict):
    def __init__(self, miss: Callable[[str], int]):
        self.miss = miss

    def __missing__(self, word: str) -> int:
        at = self[word] = self.miss(word)
        return at


def _grown(values: np.ndarray, size: int) -> np.ndarray:
    if size <= len(values):
        return values
    more = np.zeros((max(size, 2 * len(values)), *values.shape[1:]), values.dtype)
    more[: len(values)] = values
    return more


class CountMemo:
    """Sums of ``of(word)``, a list of ``width`` integers, over the words of a text."""

    def __init__(self, of: Callable[[str], Sequence[int]], width: int, most: int = 300_000):
        self.of, self.most = of, most
        self.rows = np.zeros((1024, width), np.int64)
        self.index = _Index(self._add)

    def _add(self, word: str) -> int:
        at = len(self.index)
        self.rows = _grown(self.rows, at + 1)
        self.rows[at] = self.of(word)
        return at

    def total(self, words: list[str]) -> np.ndarray:
        if len(self.index) > self.most:
            self.index.clear()
        places = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        return self.rows[places].sum(axis=0)


class _Spans:
    """Lists of integers by word, in flat arrays."""

    def __init__(self) -> None:
        self.starts, self.sizes = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.flat, self.used = np.zeros(4096, np.int32), 0
        self.index: dict[str, int] = {}

    def add(self, words: list[str], sizes: np.ndarray, values: np.ndarray) -> None:
        at, ends = len(self.index), self.used + np.cumsum(sizes)
        self.starts, self.sizes = _grown(self.starts, at + len(words)), _grown(self.sizes, at + len(words))
        self.starts[at : at + len(words)] = ends - sizes
        self.sizes[at : at + len(words)] = sizes
        self.flat = _grown(self.flat, self.used + len(values))
        self.flat[self.used : self.used + len(values)] = values
        self.used += len(values)
        self.index.update(zip(words, range(at, at + len(words))))

    def gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and joined values of the words at ``places``."""
        sizes = self.sizes[places]
        before = np.cumsum(sizes) - sizes
        return sizes, self.flat[np.repeat(self.starts[places] - before, sizes) + np.arange(sizes.sum())]


class SpanMemo:
    """Concatenations of the integers that ``many`` gives for each of a list of words.

    Half of the words and values may be new ones. When they are more, the new become the old and the
    old are forgotten; an old word that comes again is new again. So frequent words stay.
    """

    def __init__(self, many: Callable[[list[str]], list[Sequence[int]]], most: int = 160_000, values: int = 2_500_000):
        self.many, self.most, self.values = many, most // 2, values // 2
        self.new, self.old = _Spans(), _Spans()

    def _learn(self, words: list[str]) -> None:
        again = [w for w in words if w in self.old.index]
        if again:
            places = np.fromiter(map(self.old.index.__getitem__, again), np.int64, len(again))
            self.new.add(again, *self.old.gather(places))
            words = [w for w in words if w not in self.old.index]
        found = self.many(words)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.new.add(words, sizes, np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum())))

    def batch(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The integers of each text, given as its words."""
        if len(self.new.index) > self.most or self.new.used > self.values:
            self.new, self.old = _Spans(), self.new
        words, index = list(chain.from_iterable(texts)), self.new.index
        places = np.fromiter(map(index.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(places < 0).tolist()
        if missing:
            self._learn(list(dict.fromkeys(words[i] for i in missing)))
            places[missing] = [index[words[i]] for i in missing]
        sizes, gathered = self.new.gather(places)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        cuts = ends[np.cumsum([0, *map(len, texts)])].tolist()
        return [gathered[a:b] for a, b in zip(cuts, cuts[1:])]
