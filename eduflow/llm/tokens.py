"""Token ids of whole texts, as the `tokenizers` library gives them, at the cost of each distinct word once.

White space separates pre-tokens and is dropped by the vocabulary used here, so a text's ids are those of its
white-space-separated words in a row. Words are remembered; new ones of plain letters (with trailing punctuation) are
merged together in numpy, by the file's own merge list: at every step the pair of lowest rank, leftmost first. Every
other word goes to the library. tests/llm holds the ids of both ways against each other.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Letters whose lower case and normal form is one letter, followed by marks that are pre-tokens of their own.
LONGEST, MOST_WORDS, BATCH_CHARS = 48, 900_000, 4_000_000
#: For each line of lower-case words: its letters and its marks, or two empty strings.
PLAIN = re.compile(rf"(?m)^(?:([a-zà-öø-ÿ]{{1,{LONGEST}}})([.,;:!?]{{0,{LONGEST}}})|[^\n]*)$").findall
NEVER = np.int64(1) << np.int64(40)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself where printable, else from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class WordTokens:
    """Ids of words, as bytes of little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.int64)
        self.last = np.array([vocab[x + end] for x in letters], np.int64)
        pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.known: dict[bytes, bytes] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER)

    def merge(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of plain words of any lengths up to LONGEST."""
        out: dict[bytes, bytes] = {}
        words.sort(key=len)
        at = 0
        while at < len(words):
            size = len(words[at])
            end = at
            while end < len(words) and len(words[end]) == size:
                end += 1
            self.merge_equal(words[at:end], size, out)
            at = end
        return out

    def merge_equal(self, words: list[bytes], size: int, out: dict[bytes, bytes]) -> None:
        letters = np.frombuffer(b"".join(words), np.uint8).reshape(-1, size)
        ids = self.inner[letters]
        ids[:, -1] = self.last[letters[:, -1]]
        who, names = np.arange(len(words)), np.array(words, object)

        def give(rows: np.ndarray, numbers: np.ndarray) -> None:
            raw = np.ascontiguousarray(rows, "<u4").view(f"V{4 * rows.shape[1]}").ravel()
            out.update(zip(names[numbers].tolist(), raw.tolist(), strict=True))

        ranks = self.rank(ids[:, :-1], ids[:, 1:])
        while ids.shape[1] > 1 and len(who):
            best = ranks.argmin(1)
            lowest = ranks[np.arange(len(who)), best]
            going = lowest < NEVER
            if not going.all():
                give(ids[~going], who[~going])
                ids, ranks, who, best, lowest = ids[going], ranks[going], who[going], best[going], lowest[going]
            n, width = ids.shape
            if not n:
                return
            rows = np.arange(n)
            ids[rows, best] = self.merged[lowest]
            stay = np.ones((n, width), bool)
            stay[rows, best + 1] = False
            ids = ids[stay].reshape(n, width - 1)
            if width == 2:
                break
            stay = np.ones((n, width - 1), bool)
            stay[rows, best] = False
            ranks = ranks[stay].reshape(n, width - 2)
            left, right = np.flatnonzero(best > 0), np.flatnonzero(best < width - 2)
            ranks[left, best[left] - 1] = self.rank(ids[left, best[left] - 1], ids[left, best[left]])
            ranks[right, best[right]] = self.rank(ids[right, best[right]], ids[right, best[right] + 1])
        if len(who):
            give(ids, who)

    def learn(self, words: list[bytes]) -> None:
        """Remember the ids of words that are new."""
        if not words:
            return
        found = PLAIN(b"\n".join(words).decode().lower())
        letters, marks = [x.encode() for x, _ in found], [x.encode() for _, x in found]
        ids = self.merge(list({*letters, *marks} - {b""}))
        ids[b""] = b""
        self.known.update(zip(words, map(add, map(ids.__getitem__, letters), map(ids.__getitem__, marks)), strict=True))
        other = [word for word, x in zip(words, letters, strict=True) if not x]
        if other:
            for word, seen in zip(other, self.library.encode_batch_fast(
                    [x.decode() for x in other], add_special_tokens=False), strict=True):
                self.known[word] = np.array(seen.ids, "<u4").tobytes()

    def spelled(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and the ids of all words end to end."""
        if len(self.known) > MOST_WORDS:
            self.known.clear()
        self.known[b""] = b""
        self.learn(list(set(words).difference(self.known)))
        raw = list(map(self.known.__getitem__, words))
        return np.fromiter(map(len, raw), np.int64, len(raw)) // 4, np.frombuffer(b"".join(raw), "<u4")

    def forget(self) -> None:
        """Give back what the words took: a worker lives on after its task, beside the next stages'."""
        self.known = {}
        pa.default_memory_pool().release_unused()

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Block by block: the ids of whole texts end to end, and how many each text has; null is empty.

        A block's distinct words are looked up once; its ids are gathered from theirs.
        """
        texts = pc.fill_null(texts, "")
        ends, at = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)), 0
        while at < len(texts):
            done = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, done + BATCH_CHARS, side="right")))
            split = pc.ascii_split_whitespace(texts.slice(at, end - at))
            kinds = split.flatten().dictionary_encode()
            size, ids = self.spelled(kinds.dictionary.cast(pa.binary()).to_pylist())
            spelled = pa.LargeListArray.from_arrays(np.append(0, np.cumsum(size)), pa.array(ids))
            found = spelled.take(kinds.indices)
            bounds = found.offsets.to_numpy()[split.offsets.to_numpy()]
            yield found.flatten().to_numpy(), np.diff(bounds)
            at = end


WORDS: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """One for each file in each Python worker."""
    if path not in WORDS:
        WORDS[path] = WordTokens(path)
    return WORDS[path]
