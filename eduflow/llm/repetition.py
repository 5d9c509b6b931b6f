"""Quality rules on repetition inside a text, from a suffix array over its words.

Suffixes are sorted by prefix doubling, those of many documents in one go; documents in which no `least_words` words
occur twice have no repeat of that length and need no array. The longest common prefixes of neighbours, found on the way back through the doublings, form intervals; each interval whose suffixes are preceded by
different words is a maximal repeated substring. The union of the repeats' spans gives the covered share of the text's
word bytes. A text is kept when it passes the base rule, `most_covered` bounds the share and `most_words` the longest
repeat.

Words are runs of other than ASCII white space. Null or empty text has no words and fails the base rule. Repeated rows
are judged each by itself; an empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eduflow.llm.common import SPACES, mixed, per_document, word_hashes

SYMBOLS, WHITE = b"#*$%&|<>", SPACES.encode()
LEAST_WORDS, MOST_COVERED, MOST_WORDS = 10, 0.25, 100
LEAST_TEXT, MOST_REPEATED = 10, 20
BLOCK_CHARS = 2_000_000
FIELDS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_repeats long, "
          "longest_repeat long, covered double")


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def grams(words: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in one document where runs of `size` words begin, and the runs' hashes, different across documents."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    places = np.flatnonzero(doc[:n] == doc[size - 1 :])
    out = mixed(doc[places].astype(np.uint64) + np.uint64(size << 40))
    for i in range(size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[places + i])
    return places, out


def repeated(words: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    """Places whose run of words occurs again in the document."""
    places, hashes = grams(words, doc, size)
    _, number, count = np.unique(hashes, return_inverse=True, return_counts=True)
    return places[count[number] > 1]


def covered_places(starts: np.ndarray, sizes, n: int) -> np.ndarray:
    """Which of n places lie in any of the spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + sizes, -1)
    return np.cumsum(edge[:-1]) > 0


def suffixes(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes, sorted within their documents, and each one's common prefix with the one before it (in words)."""
    n, width, levels = len(words), 1, []
    places = np.arange(n)
    order = np.lexsort((words, doc))
    same = (doc[order][1:] == doc[order][:-1]) & (words[order][1:] == words[order][:-1])
    while True:
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(1, ~same))
        levels.append(rank)
        if rank.max() == n:
            break
        ahead = np.minimum(places + width, n - 1)
        second = np.where((places + width < n) & (doc[ahead] == doc), rank[ahead], 0)
        order = np.argsort(rank * (n + 1) + second, kind="stable")
        first, second = rank[order], second[order]
        same = (first[1:] == first[:-1]) & (second[1:] == second[:-1])
        width *= 2
    order = np.argsort(levels[-1])
    left, right = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, np.int64)
    for level in range(len(levels) - 2, -1, -1):
        inside = np.maximum(left, right) < n
        step = np.where(inside & (levels[level][np.minimum(left, n - 1)] == levels[level][np.minimum(right, n - 1)]),
                        1 << level, 0)
        common, left, right = common + step, left + step, right + step
    return order, np.append(0, common)


SEVERAL = object()


def maximal(common: list[int], before: list, size: int) -> list[tuple[int, int]]:
    """(number in the array of a suffix, length) of each interval whose suffixes follow different words."""
    out: list[tuple[int, int]] = []
    held: list[list] = []  # the open intervals: length, the word before all their suffixes so far
    for i in range(1, len(before) + 1):
        length, word = common[i] if i < len(before) else 0, before[i - 1]
        while held and held[-1][0] > length:
            top = held.pop()
            word = word if top[1] == word else SEVERAL
            if word is SEVERAL:
                out.append((i - 1, top[0]))
        if length >= size:
            if held and held[-1][0] == length:
                held[-1][1] = word if held[-1][1] == word else SEVERAL
            else:
                held.append([length, word])
    return out


def measured(texts: list[str | None], least_words: int) -> list[list]:
    """FIELDS of each text."""
    raw = [(x or "").encode() for x in texts]
    split = [x.split() for x in raw]
    count = np.array([len(x) for x in split], np.int64)
    words = word_hashes([w for x in split for w in x])
    sizes = np.array([len(w) for x in split for w in x], np.int64)
    doc = np.repeat(np.arange(len(texts)), count)
    n = len(words)
    short = repeated(words, doc, 5)
    windows = covered_places(short, 5, n)
    places = repeated(words, doc, least_words)
    repeats, longest, covered = np.zeros(len(texts), int), np.zeros(len(texts), int), np.zeros(len(texts))
    if len(places):
        some = np.isin(doc, doc[places])
        words, of, sizes_of = words[some], doc[some], sizes[some]
        ordered, common = suffixes(words, of)
        reach = np.maximum(common, np.append(common[1:], 0))
        reach[reach < least_words] = 0
        np.maximum.at(longest, of[ordered], reach)
        inside = covered_places(ordered, reach, len(words))
        covered = np.bincount(of, inside * sizes_of, len(texts)) / np.maximum(1, np.bincount(doc, sizes, len(texts)))
        before = words[ordered - 1].tolist()
        for i in np.flatnonzero((ordered == 0) | (of[ordered - 1] != of[ordered])).tolist():
            before[i] = -1  # begins its document
        for i, _ in maximal(common.tolist(), before, least_words):
            repeats[of[ordered[i]]] += 1
    return [
        count.tolist(), [len(x or "") - (len(b) - len(b.translate(None, WHITE))) for x, b in zip(texts, raw, strict=True)],
        [len(b) - len(b.translate(None, SYMBOLS)) for b in raw], [duplicate_lines(x or "") for x in texts],
        np.bincount(doc, windows, len(texts)).astype(int).tolist(), repeats.tolist(), longest.tolist(), covered.tolist()]


def blocks(texts: list[str | None], least_words: int) -> list[list]:
    """FIELDS of any number of texts, some at a time."""
    out: list[list] = [[] for _ in FIELDS.split(", ")]
    at = 0
    while at < len(texts):
        end, chars = at, 0
        while end < len(texts) and (end == at or chars < BLOCK_CHARS):
            chars += len(texts[end] or "")
            end += 1
        for column, part in zip(out, measured(texts[at:end], least_words), strict=True):
            column += part
        at = end
    return out


def judged(docs: DataFrame, least_words: int = LEAST_WORDS, most_covered: float = MOST_COVERED,
           most_words: int = MOST_WORDS) -> DataFrame:
    """One row per document: the measures, the base rule, and the verdict."""
    rows = per_document(docs, ["doc_id"], FIELDS, lambda texts: blocks(texts, least_words))
    failed = (F.col("n_words") < LEAST_TEXT) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    fine = (F.col("covered") <= most_covered) & (F.col("longest_repeat") <= most_words)
    return rows.select("row.doc_id", *[x.split()[0] for x in FIELDS.split(", ")], failed.alias("base_failed"),
                       (~failed & fine).alias("kept"))
