"""Licence texts inside documents.

Words are runs of ASCII letters, digits and non-ASCII characters in lower case; shingles are five words. A template of T
shingles belongs to the class of windows of W shingles, W a power of two of at most 2T/3 (1 for the shortest). A
document's windows of a class start every W/2 shingles, a template's at every shingle, so an unaltered copy holds a
window that equals one of the template's. Windows are sketched by MinHash and cut into bands; `band_setting` takes as
many bands as make two windows of similarity LEAST_ALIKE meet with probability MEET. Where bands meet, the template's
place in the document is known up to its length, and the share of its shingles found there decides.

Around these places the template's shingles are read off in their order: where the order starts again, or after a gap
longer than the template, another copy begins. A copy that holds `containment` of the template's shingles is a match, so
copies side by side are as many matches. Null or empty text has no matches, nor do texts or templates of fewer than five words. Repeated
rows are judged each by itself. Only doc_id and text are read. The templates are kept in each task: their number is
the caller's to bound (a fixed list here).
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eduflow.llm.common import mixed, per_document, shingle_hashes, word_hashes
from eduflow.llm.decontaminate import words_of
from eduflow.llm.license_texts import TEMPLATES

SIZE, ROWS, LEAST_ALIKE, MEET, CONTAINMENT = 5, 2, 0.6, 0.999, 0.75
BLOCK_CHARS = 1_000_000
MATCHES = "matches array<struct<template:string,start:int,end:int,containment:double>>"


def band_setting(alike: float = LEAST_ALIKE, meet: float = MEET, rows: int = ROWS) -> int:
    """Bands of `rows` values so that windows so much alike share one with probability `meet`."""
    return math.ceil(math.log(1 - meet) / math.log(1 - alike**rows))


BANDS = band_setting()
ODD = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)


def window_size(shingles: int) -> int:
    return 1 << max(0, int(math.log2(max(1, 2 * shingles / 3))))


def shingles_of(text: str | None) -> np.ndarray:
    words = word_hashes(words_of(text))
    return shingle_hashes(words, SIZE) if len(words) >= SIZE else np.zeros(0, np.uint64)


def keys(sketch: np.ndarray, size: int) -> np.ndarray:
    """Band keys (bands x windows) of sketches (values x windows)."""
    key = np.repeat(mixed(np.arange(1, len(sketch) // ROWS + 1, dtype=np.uint64) + np.uint64(size << 20))[:, None],
                    sketch.shape[1], 1)
    for i in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + sketch[i::ROWS])
    return key


class Templates:
    """Band keys of all windows of all templates, by class."""

    def __init__(self, texts: dict[str, str], containment: float):
        self.names = sorted(k for k, v in texts.items() if len(shingles_of(v)))
        self.shingles = [shingles_of(texts[k]) for k in self.names]
        self.sets = [np.unique(x) for x in self.shingles]
        self.places = []
        for row in self.shingles:
            at: dict[int, list[int]] = defaultdict(list)
            for place, shingle in enumerate(row.tolist()):
                at[shingle].append(place)
            self.places.append(at)
        self.containment = containment
        self.classes: dict[int, tuple] = {}
        found: dict[int, dict[int, set]] = defaultdict(lambda: defaultdict(set))
        for number, row in enumerate(self.shingles):
            size = window_size(len(row))
            values = row[None, :] * ODD[:, None] if size > 1 else np.repeat(row[None, :], ROWS, 0)
            windows = np.lib.stride_tricks.sliding_window_view(values, size, 1).min(2)
            for key in keys(windows, size).ravel().tolist():
                found[size][key].add(number)
        for size, of in found.items():
            seen = np.zeros(1 << 20, bool)
            seen[np.array(list(of), np.uint64) >> np.uint64(44)] = True
            self.classes[size] = (seen, of)

    def candidates(self, row: np.ndarray) -> set[tuple[int, int, int]]:
        """(template, first shingle, window) of windows that share a band with a template."""
        out: set[tuple[int, int, int]] = set()
        least = None  # of runs of `half` shingles, at every `half`
        half = 1
        for size in sorted(self.classes):
            if size > len(row):
                break
            if size == 1:
                windows, step = np.repeat(row[None, :], ROWS, 0), 1
            else:
                if least is None:
                    least = row[None, :] * ODD[:, None]
                while half < size // 2:
                    even = least.shape[1] // 2 * 2
                    least = np.concatenate([np.minimum(least[:, 0:even:2], least[:, 1:even:2]), least[:, even:]], 1)
                    half *= 2
                windows, step = np.minimum(least[:, :-1], least[:, 1:]), half
            seen, of = self.classes[size]
            key = keys(windows, size)
            for band, at in zip(*np.nonzero(seen[key >> np.uint64(44)]), strict=True):
                for number in of.get(int(key[band, at]), ()):
                    out.add((number, int(at) * step, size))
        return out

    def copies(self, number: int, row: np.ndarray, near: np.ndarray) -> Iterator[tuple[int, int, float]]:
        """(first word, end word, share) of each copy of a template among the shingles marked `near`."""
        reach, places = len(self.shingles[number]) + SIZE, self.places[number]
        spots = np.flatnonzero(near & np.isin(row, self.sets[number])).tolist()
        first = last = at = None
        held: set[int] = set()
        for spot in spots:
            order = places[int(row[spot])]
            on = None if at is None or spot - last > reach else next((p for p in order if p > at), None)
            if on is None:
                if held:
                    yield first, last + SIZE, len(held) / len(self.sets[number])
                first, on, held = spot, order[0], set()
            last, at = spot, on
            held.add(int(row[spot]))
        if held:
            yield first, last + SIZE, len(held) / len(self.sets[number])

    def matches(self, row: np.ndarray) -> list[tuple[str, int, int, float]]:
        """(template, first word, end word, containment) in a document's shingles."""
        near: dict[int, np.ndarray] = {}
        for number, at, size in self.candidates(row):
            reach = len(self.shingles[number]) + SIZE
            marked = near.setdefault(number, np.zeros(len(row), bool))
            marked[max(0, at + size - reach) : at + reach] = True
        return sorted((self.names[k], *copy) for k, marked in near.items() for copy in self.copies(k, row, marked)
                      if copy[2] >= self.containment)


BUILT: dict[tuple, Templates] = {}


def built(texts: dict[str, str], containment: float) -> Templates:
    """The tables, made once in each Python worker."""
    key = (containment, *sorted(texts.items()))
    if key not in BUILT:
        BUILT.clear()
        BUILT[key] = Templates(texts, containment)
    return BUILT[key]


def templates_of(table: DataFrame) -> dict[str, str]:
    """Templates from a table (name, text), which goes to every task: as many as a task can hold."""
    return {r.name: r.text for r in table.where("name is not null and text is not null").select("name", "text").collect()}


def found(docs: DataFrame, keep: list[str], templates: dict[str, str] = TEMPLATES,
          containment: float = CONTAINMENT) -> DataFrame:
    """Struct `row` of the kept columns, and the matches in words, of each document."""

    def judge(texts: list[str | None]) -> list[list]:
        tables = built(templates, containment)
        return [[[dict(zip(("template", "start", "end", "containment"), x, strict=True))
                  for x in tables.matches(shingles_of(text))] for text in texts]]

    return per_document(docs, keep, MATCHES, judge)


def scanned(docs: DataFrame) -> DataFrame:
    """One row per document: number of matches, templates found, share of the best."""
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda x: x["template"])))
    return found(docs, ["doc_id"]).select(
        "row.doc_id", F.size("matches").cast("long").alias("n_matches"), F.array_join(names, ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("matches", lambda x: x["containment"])), F.lit(0.0)).alias("best"))
