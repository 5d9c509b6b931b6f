"""The language of whole texts by cross-parsing entropy.

For each language a bounded sample of labelled text becomes a suffix automaton. A text is parsed from left to right
into the longest phrases that occur in the sample; the number of phrases times the bits that point into the sample,
per symbol, is the text's entropy against that language, and the least wins. Symbols are lower-case letters, and one
space for whatever stands between them; every letter of the samples is a symbol of its own, of any script. An automaton
numbers the symbols of its own sample by frequency: steps over the first DENSE lie in a table, those over rarer ones in
a sorted list, so its size follows the sample, not the alphabet. Texts are parsed in segments of SEGMENT symbols, side
by side, and all of a text's segments count.

The sample: `sample_rows` labelled documents a language (those of least hash of their id), `sample_chars` of each. Ties
go to the first language by name. The score is the runner-up's entropy over the sum of both: 0.5 for a tie, 1 where
only one language is learned. Null text, and text without a letter, is `und` with score 0, as is every text where
nothing was learned. Null labels and null ids teach nothing. Repeated rows are judged each by itself.
"""

from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eduflow.llm.common import per_document

SEGMENT, DENSE, BLOCK_CHARS = 1024, 64, 4_000_000
UNSEEN, SPACE, NEW = 0, 1, -1


class Symbols:
    """Code points to small numbers: 0 for letters that no sample has, 1 for non-letters, the rest by frequency."""

    def __init__(self, samples: list[str]):
        seen = Counter(c for text in samples for c in text.lower() if c.isalpha())
        letters = sorted(seen, key=lambda c: (-seen[c], c))
        self.size = len(letters) + 2
        self.of = np.full(0x110000, NEW, np.int32)
        for number, letter in enumerate(letters, 2):
            self.of[ord(letter)] = number

    def read(self, text: str) -> tuple[np.ndarray, bool]:
        """Symbols of a text with runs of spaces as one, and whether it has a letter."""
        points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
        symbols = self.of[points]
        if (fresh := symbols == NEW).any():
            for point in np.unique(points[fresh]).tolist():
                self.of[point] = UNSEEN if chr(point).isalpha() else SPACE
            symbols = self.of[points]
        space = symbols == SPACE
        keep = np.ones(len(symbols), bool)
        keep[1:] = ~(space[1:] & space[:-1])
        return symbols[keep], not space.all()


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Steps by state and symbol; state 1 is the root and 0 no state."""
    step: list[dict[int, int]] = [{}, {}]
    link, length = [0, 0], [-1, 0]
    last = 1
    for c in symbols:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(1)
        p = last
        while p and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return step


class Automaton:
    """The steps of a sample's suffix automaton, over the sample's own symbols: 0 is none of them."""

    def __init__(self, sample: np.ndarray, size: int):
        kinds, counts = np.unique(sample[sample != UNSEEN], return_counts=True)
        self.own = np.zeros(size, np.int32)
        self.own[kinds[np.argsort(-counts, kind="stable")]] = np.arange(1, len(kinds) + 1)
        step = suffix_automaton(self.own[sample].tolist())
        self.width, self.symbols = min(DENSE, len(kinds) + 1), len(kinds) + 1
        self.table = np.zeros(len(step) * self.width, np.int32)
        self.first = np.zeros(self.symbols, np.int32)
        rare = []
        for state, row in enumerate(step):
            for c, to in row.items():
                if UNSEEN < c < self.width:
                    self.table[state * self.width + c] = to
                elif c != UNSEEN:
                    rare.append((state * self.symbols + c, to))
        for c, to in step[1].items():
            self.first[c] = to if c != UNSEEN else 0
        keys, to = np.array(sorted(rare), np.int64).reshape(-1, 2).T
        self.keys, self.to = keys.copy(), to.astype(np.int32)

    def after(self, states: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The states that follow by symbols of this sample, 0 where none does."""
        far = np.flatnonzero(c >= self.width) if len(self.keys) else c[:0]
        if not len(far):
            return self.table[states * self.width + c]
        to = self.table[states * self.width + np.where(c < self.width, c, 0)]
        key = states[far].astype(np.int64) * self.symbols + c[far]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        to[far] = np.where(self.keys[at] == key, self.to[at], 0)
        return to


class Languages:
    """Automata of all languages, by name."""

    def __init__(self, samples: dict[str, list[str]]):
        self.names = sorted(samples)
        self.symbols = Symbols([x for texts in samples.values() for x in texts])
        self.automata, self.bits = [], []
        for name in self.names:
            read = np.concatenate([np.append(self.symbols.read(x)[0], SPACE) for x in samples[name]])
            self.automata.append(Automaton(read, self.symbols.size))
            self.bits.append(np.log2(max(2, len(read))))

    def phrases(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, steps: Automaton) -> np.ndarray:
        """Phrases of each segment; segments are in falling order of size."""
        flat = steps.own[flat]
        state, count = np.ones(len(starts), np.int32), np.zeros(len(starts), np.int32)
        for t in range(int(sizes[0]) if len(sizes) else 0):
            k = np.searchsorted(-sizes, -t, side="left")  # segments longer than t
            c = flat[starts[:k] + t]
            now = state[:k]
            to = steps.after(now, c)
            at = np.flatnonzero(to == 0)
            first = steps.first[c[at]]
            count[at] += (now[at] != 1).astype(np.int32) + (first == 0)
            to[at] = np.maximum(first, 1)
            state[:k] = to
        return count + (state != 1)

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per symbol by text and language, and which texts have a letter."""
        read = [self.symbols.read(x or "") for x in texts]
        lettered = np.array([b for _, b in read], bool)
        sizes = np.array([len(x) for x, _ in read], np.int64)
        flat = np.concatenate([x for x, _ in read]) if read else np.zeros(0, np.int32)
        parts = -(-sizes // SEGMENT)
        of = np.repeat(np.arange(len(texts)), parts)
        number = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
        starts = np.repeat(np.cumsum(sizes) - sizes, parts) + number * SEGMENT
        each = np.minimum(SEGMENT, np.repeat(sizes, parts) - number * SEGMENT)
        order = np.argsort(-each, kind="stable")
        out = np.zeros((len(texts), len(self.names)))
        for i, (steps, bits) in enumerate(zip(self.automata, self.bits, strict=True)):
            count = self.phrases(flat, starts[order], each[order], steps)
            out[:, i] = np.bincount(of[order], count, len(texts)) * bits / np.maximum(sizes, 1)
        return out, lettered

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not self.names:
            return ["und"] * len(texts), [0.0] * len(texts)
        names, scores, at = [], [], 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars < BLOCK_CHARS):
                chars += len(texts[end] or "")
                end += 1
            bits, lettered = self.entropies(texts[at:end])
            best = bits.argmin(1)
            rows = np.arange(len(best))
            least = bits[rows, best]
            if len(self.names) > 1:
                bits[rows, best] = np.inf
                second = bits.min(1)
                score = second / np.maximum(least + second, 1e-12)
            else:
                score = np.ones(len(best))
            names += [self.names[i] if ok else "und" for i, ok in zip(best.tolist(), lettered, strict=True)]
            scores += np.where(lettered, score, 0.0).tolist()
            at = end
        return names, scores


BUILT: dict[str, Languages] = {}


def built(name: str, shared) -> Languages:
    """The automata, made once in each Python worker."""
    if name not in BUILT:
        BUILT.clear()
        BUILT[name] = Languages(shared.value)
    return BUILT[name]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learned(docs: DataFrame, sample_rows: int = 40, sample_chars: int = 1000) -> dict[str, list[str]]:
    """The sample of each language, from documents with a letter and a label that are not held out.

    Of a longer text, `sample_chars` characters from a place that the hash of its id names.
    """
    taught = docs.where("lang is not null and doc_id is not null").where(~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}"))
    place = F.pmod(F.xxhash64(F.lit(8), "doc_id"), F.greatest(F.lit(1), F.char_length("text") - sample_chars + 1)) + 1
    rows = taught.select("lang", F.xxhash64(F.lit(7), "doc_id").alias("hash"), "doc_id", F.substr(
        "text", place.cast("int"), F.lit(sample_chars)).alias("piece"))
    first = Window.partitionBy("lang").orderBy("hash", "doc_id", "piece")
    found = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= sample_rows).select("lang", "piece")
    out: dict[str, list[str]] = {}
    for lang, piece in sorted(tuple(x) for x in found.collect()):
        out.setdefault(lang, []).append(piece)
    return {k: v for k, v in out.items() if any(c.isalpha() for x in v for c in x)}


def predicted(spark: SparkSession, docs: DataFrame, samples: dict[str, list[str]], keep: list[str]) -> DataFrame:
    """Struct `row` of the kept columns, lang_pred and score of each document; only its text is looked at."""
    shared, name = spark.sparkContext.broadcast(samples), uuid.uuid4().hex
    return per_document(docs, keep, "lang_pred string, score double",
                        lambda texts: built(name, shared).judge(texts))


def languages(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of all documents, learned from those of them that are labelled."""
    rows = predicted(spark, docs, learned(docs), ["doc_id"])
    return rows.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")
