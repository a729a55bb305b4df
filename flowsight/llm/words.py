"""Words of whole texts, and a bounded memory of what was computed for a word."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import regex

# The letters, numbers and white space among the first 256 code points.
LATIN_CLASSES = {r"\p{L}": "A-Za-zªµºÀ-ÖØ-öø-ÿ", r"\p{N}": "0-9²³¹¼½¾", r"\s": "\\t-\\r \x85\xa0"}


def is_latin(text: str) -> bool:
    """Whether all code points are below 256."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def latin_pattern(pattern: str) -> str:
    """A pattern over Unicode classes, written out for texts of the first 256 code points."""
    parts = re.split(r"(\[[^\]]*\])", pattern)
    for place, part in enumerate(parts):
        for name, members in LATIN_CLASSES.items():
            part = part.replace(name, members if place % 2 else f"[{members}]")
        parts[place] = part.replace(r"\S", f"[^{LATIN_CLASSES[chr(92) + 's']}]")
    return "".join(parts)


class Splitter:
    """All matches of a pattern in a text; texts of the first 256 code points take the faster engine."""

    def __init__(self, pattern: str):
        self.any = regex.compile(pattern, regex.V1).findall
        self.latin = re.compile(latin_pattern(pattern)).findall

    def __call__(self, text: str) -> list[str]:
        return self.latin(text) if is_latin(text) else self.any(text)



LOADED: dict = {}


def forget() -> None:
    """Let go of the vocabulary in use and its words, for work that needs none."""
    LOADED.clear()


def only_loaded(make: Callable, *arguments):
    """What ``make`` gives, kept by the worker until it needs another vocabulary.

    Workers serve one task after another; without this, each stage of a job would leave its words behind.
    """
    key = (make, arguments)
    if key not in LOADED:
        LOADED.clear()
        LOADED[key] = make(*arguments)
    return LOADED[key]


class Memo:
    """Values of words, computed for many unknown words at a time.

    Two generations of about ``limit`` words are kept: a word that is not asked for while a whole
    generation fills up is forgotten and computed again when it comes back. So memory is bounded
    whatever the texts hold, and the results do not depend on what is remembered.
    """

    def __init__(self, compute: Callable[[list[str]], Iterable], limit: int = 120_000):
        self.compute, self.limit = compute, limit
        self.young: dict = {}
        self.old: dict = {}

    def table(self, words: Iterable) -> dict:
        """A mapping that has a value for each of the words (and others), good until the next call."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        unknown = []
        for word in set(words).difference(self.young):
            value = self.old.get(word)
            if value is None:
                unknown.append(word)
            else:
                self.young[word] = value
        if unknown:
            self.young.update(zip(unknown, self.compute(unknown)))
        return self.young


class Numbers(dict):
    """A number for each word, in the order in which words are first asked for."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class IdMemo:
    """32-bit ids of words in two generations, like ``Memo``; texts are held as numbers of their words.

    ``compute`` gives the ids of words one after another, and how many each has. Only one text's words are strings at a time, so
    many texts can share one call of it.
    """

    def __init__(self, compute: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 120_000):
        self.compute, self.limit = compute, limit
        self.young, self.old = Numbers(), Numbers()
        self.ids, self.old_ids = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.edges, self.old_edges = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def packed(self, texts: Iterable[list[str]]) -> list[bytes]:
        """The ids of the words of each text as little-endian 32-bit numbers."""
        if len(self.young) > self.limit:
            self.old, self.old_ids, self.old_edges = self.young, self.ids, self.edges
            self.young, self.ids, self.edges = Numbers(), self.ids[:0], self.edges[:1]
        known, number = len(self.young), self.young.__getitem__
        numbered = [np.fromiter(map(number, words), np.int32, len(words)) for words in texts]
        self.learn(list(islice(self.young, known, None)))
        return [ids_at(self.ids, self.edges, numbers).astype("<i4").tobytes() for numbers in numbered]

    def learn(self, fresh: list[str]) -> None:
        """Ids of the words that were numbered last."""
        before = np.array([self.old.get(word, -1) for word in fresh], np.int64)
        unknown = np.flatnonzero(before < 0)
        made, counts = self.compute([fresh[place] for place in unknown.tolist()])
        # the fresh ones as if both tables were one
        both = np.concatenate([self.old_edges, self.old_edges[-1] + np.cumsum(counts)])
        before[unknown] = len(self.old_edges) - 1 + np.arange(len(unknown))
        self.ids = np.concatenate([self.ids, ids_at(np.concatenate([self.old_ids, made]), both, before)])
        self.edges = np.concatenate([self.edges, self.edges[-1] + np.cumsum(np.diff(both)[before])])


def ids_at(ids: np.ndarray, edges: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The ids from edge to edge at each of the places, one after another."""
    starts = edges[places]
    lengths = edges[places + 1] - starts
    ends = np.cumsum(lengths)
    return ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)]


def blocks(texts: list[str], chars: int = 6_000_000) -> Iterator[range]:
    """Runs of texts with about ``chars`` characters together; a longer text is a run of its own."""
    start = total = 0
    for place, text in enumerate(texts):
        if total and total + len(text) > chars:
            yield range(start, place)
            start, total = place, 0
        total += len(text)
    if start < len(texts):
        yield range(start, len(texts))
