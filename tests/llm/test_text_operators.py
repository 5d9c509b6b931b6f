"""The training-text operators against SQL, the libraries, and plain brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from checks import compare
from conftest import DATA
from eduflow.llm import (chat_format, common, decontaminate, language_id, license_scan, line_dedup, near_dedup, packing,
                         queries, repetition, token_counts, warc_zstd)
from eduflow.llm.tokens import word_tokens

PATH = public_tokenizers.path(queries.TOKENIZER)
LIBRARY = Tokenizer.from_file(PATH)
LONG = " ".join(f"word{i % 3000}" for i in range(30_000))
CLASH = ["row", "print", "line", "pos", "key", "node", "kept", "length", "n_lines", "hash", "slice", "kinds", "spans"]

EDGE = [
    (1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, LONG, "en"), (5, LONG, "de"), (6, "one two", "en"),
    (6, "one two", "en"), (7, "one two", "fr"), (8, "a b c d e a b c d e", "en"), (None, "one two", "en"),
    (None, None, None), (9, "12 34 !!", "en"), (10, "Éa <|endoftext|> x\x1cy #| don't", "fr"), (6, "other text of an id", "en"),
    *[(100 + i, "x\n  A line that every one of these documents has, in full  \n" + "y" * i, "de") for i in range(6)],
    (106, "a LINE that every one of these documents has, in full", "de"),
    *[(200 + i, " ".join(f"w{j}" for j in range(60)) + f" end{i}", "es") for i in range(5)],
]


@pytest.fixture(scope="module")
def edge(spark):
    schema = "doc_id long, text string, lang string, " + ", ".join(f"{c} string" for c in CLASH)
    return spark.createDataFrame([(*r, *["?"] * len(CLASH)) for r in EDGE], schema)


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text, r.lang) for r in common.table(spark, DATA, "documents").collect()]


def both(spark, edge, docs, run):
    """Results over the edge rows, over no rows, and over the given documents."""
    assert run(edge.limit(0)).count() == 0
    return [(EDGE, run(edge).collect()), (docs, run(common.table(spark, DATA, "documents")).collect())]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    found = compare.differences(spark, compare.open_tables(DATA), DATA, name, queries.queries()[name], queries.SQL[name])
    assert found is None


# chat formatting

def chats(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece string, number int")


def test_chat_edges(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "a\\b <|end|> </s>\n[INST]\\"), (1, 1, "assistant", "😀é"),
            (2, None, None, None), (2, 0, "assistant", ""), (None, 3, "us\ner", "<\\|turn|>"), (1, 2, "system", "z" * 99_999),
            (3, 0, "user", "twice"), (3, 0, "user", "twice")]
    found = {r.conv_id: r for r in chat_format.digests(chats(spark, [(*r, "?", 1) for r in rows])).collect()}
    assert chat_format.digests(chats(spark, [])).count() == 0
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv))
        said = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        loss = "".join(text for _, _, role, text in turns if role == "assistant")
        assert (found[conv].n_turns, found[conv].turns_sha256, found[conv].loss_chars, found[conv].loss_sha256) == (
            len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_roles_are_read_back(spark):
    rows = [(i, 0, role, text) for i, (role, text) in enumerate(
        (role, text) for role in ("as\nsistant", "\n", "a\\\nb", "a\\", "\\\\\n\n", "<|end|>\n<|turn|>", "assistant")
        for text in ("hello", "", "\nx", "\\\n<|end|>\n"))]
    made = chat_format.formatted(chat_format.text_parts(chats(spark, [(*r, "?", 1) for r in rows])))
    got = {r.conv_id: [tuple(x) for x in r.turns] for r in made.select(
        "conv_id", chat_format.read_turns(made["formatted"]).alias("turns")).collect()}
    assert got == {i: [(role, text)] for i, _, role, text in rows}


def test_chat_parts(spark):
    parts = f"array<{chat_format.PART}>"
    text = lambda x: ("text", x, None, None, None, None, None)
    rows = [(1, 0, "user", [text("see "), ("image", None, "a.png", 56, 29, None, None), text(" and <|image|>"),
                            ("audio", None, "b.wav", None, None, 1.5, None)]),
            (1, 1, "assistant", [text("it is "), ("document", None, "c.pdf", None, None, None, 3), text("this")]),
            (1, 2, "user", None), (1, 3, "tool", [("video", None, "d", None, None, None, None)])]
    made = chat_format.formatted(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {parts}")).first()
    assert made.formatted == (
        "<|turn|>user\nsee <|image|> and <\\|image|><|audio|><|end|><|turn|>assistant\nit is <|document|>this<|end|>"
        "<|turn|>user\n<|end|><|turn|>tool\n<|file|><|end|>")
    assert [tuple(a) for a in made.attachments] == [
        ("image", "a.png", 4), ("audio", "b.wav", 38), ("document", "c.pdf", 768), ("video", "d", 1)]
    assert [made.formatted[s.start : s.start + s.length] for s in made.loss_spans] == ["it is ", "this"]


# archives

def test_warc_edges(spark):
    big = "<p>same</p>" * 20
    rows = [(1, "http://a b\n", big), (2, None, big), (2, "http://c", big), (3, "", None), (None, "http://d", big), (4, "x", ""),
            (5, "x", "é" * 50), (6, "x", "é" * 50), (7, "x", "short"), (8, "x", "short"), (9, "x", "z" * 300_000)]
    pages = spark.createDataFrame([(*r, "?") for r in rows], "page_id long, url string, html string, digest string")
    for size in (100, 1 << 20):
        folder = common.shared_folder(spark)
        warc_zstd.write(pages.repartition(2), folder, archive_bytes=size)
        got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                      for r in warc_zstd.read(spark, folder).collect())
        first = {1: None, 2: 1, None: 1, 6: 5}
        want = Counter()
        for page, _, html in rows:
            raw, to = (html or "").encode(), first.get(page)
            want[(page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if to else "response", to)] += 1
        assert got == want
    folder = common.shared_folder(spark)
    warc_zstd.write(pages.limit(0), folder)
    assert warc_zstd.read(spark, folder).count() == 0


def test_warc_dictionary():
    records = [warc_zstd.record(i, "u", f"<html><p>page {i} of the site, with words {i * 7}</p></html>".encode() * 3, "d", None, "t")
               for i in range(400)]
    made = warc_zstd.archive(records)
    assert made[:4] == bytes.fromhex("5d2a4d18") and list(warc_zstd.frames(made)) == records
    assert len(made) < sum(map(len, records)) / 3
    with pytest.raises(ValueError, match="ends inside"):
        list(warc_zstd.frames(made[:-3]))


# tokens

def test_word_tokens_are_the_librarys():
    rng = random.Random(1)
    letters = "abXYtsSéÉßñ.,;:!?'’\"-_019\n\t\r\x0b\x0c\x1c\x1f\x85\xa0 ̧́ªºǅΣςк中İıK²½\U0001d4b3<|endoftext|>"
    texts = ["".join(rng.choice(letters) for _ in range(150)) for _ in range(400)]
    texts += ["", LONG, "x" * 500, "It's WE'LL a.'s é. a<|endoftext|>b <|ENDOFTEXT|>", " ", "ﬁ…„“"]
    got = []
    for ids, sizes in word_tokens(PATH).encode(pa.array([*texts, None])):
        got += [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    assert got == [LIBRARY.encode(x, add_special_tokens=False).ids for x in [*texts, ""]]


def test_token_counts(spark, edge, docs):
    for rows, got in both(spark, edge, docs, lambda d: token_counts.token_counts(d, PATH, block_chars=50_000)):
        want = Counter()
        for doc, text, _ in rows:
            n = len(LIBRARY.encode(text or "", add_special_tokens=False).ids)
            want[(doc, len((text or "").encode()), n, n > 2048)] += 1
        assert Counter(map(tuple, got)) == want


# lines

def kept_lines(rows):
    key = lambda x: x.strip(common.SPACES).translate(str.maketrans(common.UPPER, common.LOWER))
    rank = lambda d: (d is not None, d or 0)
    holders = defaultdict(set)
    for doc, text, _ in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc)
    out = Counter()
    for doc, text, _ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 40 and len(holders[key(x)]) >= 5
                                         and max(holders[key(x)], key=rank) != doc)]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out[(doc, len(lines), len(lines) - len(kept), digest)] += 1
    return out


def test_line_dedup(spark, edge, docs):
    for rows, got in both(spark, edge, docs, line_dedup.digests):
        assert Counter(tuple(r)[:4] for r in got) == kept_lines(rows)


def test_keep_runs(spark):
    rng = random.Random(2)
    for _ in range(20):
        n = rng.randint(1, 30)
        gone = sorted(rng.sample(range(n), rng.randint(1, n)))
        rows = spark.createDataFrame([("\n".join(map(str, range(n))), gone)], "text string, at array<int>")
        marks = line_dedup.runs(rows["at"])
        text, count = rows.select(line_dedup.kept_text(rows["text"], marks), line_dedup.dropped_lines(marks)).first()
        assert (text, count) == ("\n".join(str(i) for i in range(n) if i not in gone), len(gone))


# near duplicates

def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def groups(rows):
    sets = [shingles(t) for _, t, _ in rows]
    root = {d: d for d, _, _ in rows if d is not None}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, (a, _, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            if None not in (a, b) and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return Counter((d, len(s), None if d is None else find(d), d is None or find(d) == d)
                   for (d, _, _), s in zip(rows, sets, strict=True))


def test_near_dedup(spark, edge, docs):
    for rows, got in both(spark, edge, docs, near_dedup.classes):
        assert Counter(map(tuple, got)) == groups(rows)


def test_near_copies_of_one_text(spark):
    """Copies that are often less alike than the limit among themselves, and a chain."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(200)]
    rows = [(0, " ".join(base), "")]
    for i in range(1, 60):
        words = list(base)
        for _ in range(5):
            words[rng.randrange(200)] = f"c{rng.randrange(10**6)}"
        rows.append((i, " ".join(words), ""))
    rng.shuffle(rows)
    rows = [(i, t, x) for i, (_, t, x) in enumerate(rows)]
    chain = [f"d{i}" for i in range(130)]
    rows += [(1000 + k, " ".join(chain[6 * k : 6 * k + 100]), "") for k in range(5)]
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert Counter(map(tuple, near_dedup.classes(made).collect())) == groups(rows)


def far_copies(n, rng):
    """Copies of one text, each so far changed that hardly any two are linked, but most share a bucket."""
    base = [f"b{i}" for i in range(300)]
    rows = [(0, " ".join(base), "")]
    for i in range(1, n):
        words = list(base)
        for at in rng.sample(range(300), 14):
            words[at] = f"c{rng.randrange(10**9)}"
        rows.append((i, " ".join(words), ""))
    return rows


def test_pairs_grow_with_the_group(spark, monkeypatch):
    made, checked = {}, near_dedup.links
    for n in (60, 240):
        rows, seen = far_copies(n, random.Random(n)), []

        def links(docs, nodes, pairs, sets=None):
            seen.append(pairs.count())
            return checked(docs, nodes, pairs, sets)

        monkeypatch.setattr(near_dedup, "links", links)
        got = near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
        made[n] = sum(seen)
        if n == 60:
            assert Counter(map(tuple, got)) == groups(rows)
    assert made[240] < 6 * made[60] and made[240] < 20 * 240


def test_prefixes_meet():
    """Two sets that are linked share a difference to any middle, in both prefixes, unless both are linked to the nearest."""
    rng = np.random.default_rng(11)
    counts, met = rng.integers(0, 50, near_dedup.COUNTERS), 0
    draw = lambda n: rng.integers(0, 2**63, n).astype(np.uint64)
    near = lambda x, y: near_dedup.linked(x.view(np.int64), y.view(np.int64))
    for _ in range(1500):
        base = np.unique(draw(rng.integers(1, 60)))

        def changed(of):
            keep = of[rng.random(len(of)) > rng.random() * 0.4]
            return np.unique(np.concatenate([keep, draw(rng.integers(0, 1 + len(of) // 3))]))

        middle = changed(base)[: rng.integers(0, 80)]
        sets = [x for x in (changed(base), changed(base), changed(changed(base)), base) if len(x)]
        sets += [x for x in map(changed, sets) if len(x)]
        nearest = min(sets, key=lambda x: near_dedup.distance(x, middle))
        for i, x in enumerate(sets):
            for y in sets[:i]:
                if near(x, y) and not (near(x, nearest) and near(y, nearest)):
                    met += 1
                    assert np.intersect1d(near_dedup.prefix(x, middle, counts), near_dedup.prefix(y, middle, counts)).size
    assert met > 300


def test_rows_of_one_id_are_one_document(spark):
    """Whatever texts an id has, its own first ones and none among them, all of them are in one component."""
    other = [" ".join(f"{c}{j}" for j in range(20)) for c in "abcdef"]
    rows = [(6, "one two", ""), (7, "one two", ""), (7, "some other text", ""), (7, "", ""), (7, None, ""),
            (11, other[0], ""), (12, other[1], ""), (13, other[2], ""), *[(14, x, "") for x in other[:4]], (15, other[3], ""),
            (20, other[4], ""), (20, other[5], ""), (21, other[5], ""), (22, "", ""), (None, "one two", ""), (None, "", "")]
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = Counter(map(tuple, near_dedup.classes(made).collect()))
    assert got == groups(rows)
    assert {d: c for d, _, c, _ in got} == {6: 6, 7: 6, 11: 11, 12: 11, 13: 11, 14: 11, 15: 11, 20: 20, 21: 20, 22: 22, None: None}
    assert {d for d, _, _, kept in got if kept} == {6, 11, 20, 22, None}
    assert sorted(r.doc_id or 0 for r in corpus_pipeline.near_duplicates(spark, made, DATA).collect()) == [0, 0, 6, 11, 20, 22]


def test_sketches():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 4000).astype(np.uint64)
    sets = [np.sort(pool[:n]) for n in (1, 3, 100, 1000)] + [np.zeros(0, np.uint64)]
    made = near_dedup.sketches(sets)
    assert (made[:4] != near_dedup.EMPTY).all() and (made[4] == near_dedup.EMPTY).all()
    a, b = near_dedup.sketches([pool[:1200], pool[300:1500]])
    assert abs((a == b).mean() - 0.6) < 0.15


# languages

def test_languages(spark, docs):
    got = {r.doc_id: r for r in language_id.languages(spark, common.table(spark, DATA, "documents")).collect()}
    held = [(got[d], lang) for d, _, lang in docs if zlib.crc32(str(d).encode()) % 3 == 1]
    assert all(r.held_out for r, _ in held) and sum(r.held_out for r in got.values()) == len(held)
    assert sum(r.lang_pred == lang for r, lang in held) >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_edges(spark, edge):
    got = language_id.languages(spark, edge).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, _, _ in EDGE)
    lettered = {d: bool(re.search(r"[^\W\d_]", t or "")) for d, t, _ in EDGE if d is not None}
    assert all((r.lang_pred == "und") != lettered[r.doc_id] for r in got if r.doc_id is not None)
    assert language_id.languages(spark, edge.limit(0)).count() == 0
    none = language_id.predicted(spark, edge, {}, ["doc_id"]).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}


def test_phrases_are_longest_matches():
    rng = random.Random(4)
    samples = {"a": ["".join(rng.choice("abc ") for _ in range(80)) + "a"], "b": ["abcabdabe" * 3]}
    model = language_id.Languages(samples)
    for _ in range(50):
        text = "".join(rng.choice("abcdeq ") for _ in range(60)) + "a"
        bits, _ = model.entropies([text])
        symbols = model.symbols.read(text)[0].tolist()
        for k, name in enumerate(model.names):
            sample = np.append(model.symbols.read(samples[name][0])[0], language_id.SPACE).tolist()
            runs = {tuple(sample[i:j]) for i in range(len(sample)) for j in range(i + 1, len(sample) + 1)}
            at = count = 0
            while at < len(symbols):
                end = at + 1
                while end <= len(symbols) and tuple(symbols[at:end]) in runs and language_id.UNSEEN not in symbols[at:end]:
                    end += 1
                at, count = max(at + 1, end - 1), count + 1
            assert abs(bits[0, k] - count * model.bits[k] / len(symbols)) < 1e-9


def test_languages_of_many_scripts():
    """Every letter counts, however many the samples have: Latin, Cyrillic, kana and two vocabularies in Han."""
    rng = random.Random(8)
    alphabets = {"en": range(97, 123), "ru": range(0x430, 0x450), "ja": [*range(0x3041, 0x3097), *range(0x4E00, 0x4E80)],
                 "yue": range(0x4E00, 0x4F00), "zh": range(0x4E00, 0x4F00)}
    words = {k: ["".join(chr(rng.choice(x)) for _ in range(rng.randint(2, 5))) for _ in range(150)] for k, x in alphabets.items()}
    said = lambda k, n: " ".join(rng.choice(words[k]) for _ in range(n))
    model = language_id.Languages({k: [said(k, n)] for k, n in zip(alphabets, (500, 600, 400, 300, 700), strict=True)})
    wanted = [k for k in alphabets for _ in range(20)]
    assert model.judge([said(k, 20) for k in wanted])[0] == wanted


def test_phrases_over_wide_alphabets():
    rng = random.Random(9)
    letters = [chr(0x4E00 + i) for i in range(150)]
    sample = "".join(rng.choice(letters[: 150 if i % 2 else 4]) for i in range(600))
    model = language_id.Languages({"a": ["plain text"], "zh": [sample]})
    for _ in range(30):
        parts = [sample[i : i + rng.randint(1, 9)] for i in (rng.randrange(600) for _ in range(8))]
        text = "".join(parts) + "plain" + rng.choice(letters) + "é"
        at = count = 0
        while at < len(text):
            end = at + 1
            while end <= len(text) and text[at:end] in sample:
                end += 1
            at, count = max(at + 1, end - 1), count + 1
        assert abs(model.entropies([text])[0][0, 1] - count * model.bits[1] / len(text)) < 1e-9


# benchmark passages

def test_decontaminate_blocks_agree(spark):
    docs, items = (common.table(spark, DATA, x) for x in ("documents", "benchmark"))
    one = sorted(map(tuple, decontaminate.judged(spark, docs, items).collect()))
    many = sorted(map(tuple, decontaminate.judged(spark, docs, items, most_bytes=4000).collect()))
    assert one == many and any(r[-1] for r in one)


def test_one_block_of_items_at_a_time(spark, edge, monkeypatch):
    """The search of a block is stored and its items released before the next block is collected."""
    items, seen = common.table(spark, DATA, "benchmark").where("text is not null"), []
    size = items.selectExpr("sum(octet_length(text) + 16)").first()[0]

    def noted(name, call):
        return lambda *args: (seen.append(name), call(*args))[1]

    broadcast = type(spark.sparkContext.broadcast(0))
    monkeypatch.setattr(type(items), "collect", noted("collect", type(items).collect))
    monkeypatch.setattr(decontaminate, "stored", noted("stored", decontaminate.stored))
    monkeypatch.setattr(broadcast, "destroy", noted("destroy", broadcast.destroy))
    decontaminate.found(spark, edge, items, ["doc_id", "text"], most_bytes=size // 3 + 1)
    assert seen[-7:] == ["collect", "stored", "destroy", "collect", "stored", "destroy", "collect"]


def test_decontaminate_edges(spark, edge):
    items = spark.createDataFrame(
        [(1, "One Two"), (1, "one-two"), (2, None), (3, "..."), (4, " ".join(f"w{j}" for j in range(5, 17))), (None, "éa"),
         (5, "e a")], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.judged(spark, edge, items).collect()}
    assert (got[7].n_words, got[7].n_hit, got[7].n_items, got[7].items_sha256) == (
        2, 2, 1, hashlib.sha256(b"1").hexdigest())
    assert (got[200].n_words, got[200].n_hit, got[200].n_items) == (61, 12, 1)
    assert (got[8].n_hit, got[1].n_words, got[9].contaminated) == (2, 0, False)
    assert decontaminate.judged(spark, edge, items.limit(0)).where("contaminated").count() == 0
    assert decontaminate.judged(spark, edge.limit(0), items).count() == 0


def test_wu_manber_finds_all():
    rng = random.Random(5)
    words = ["a", "bb", "ccc", "é", "7"]
    for _ in range(100):
        items = [(str(i), " ".join(rng.choice(words) for _ in range(rng.randint(0, 6)))) for i in range(5)]
        text = " ".join(rng.choice(words) for _ in range(60))
        search, split = decontaminate.Search(items, 3), text.split()
        hit, found = set(), set()
        for item, wanted in items:
            w = wanted.split()
            for i in range(max(1, len(w) - 2) if w else 0):
                for at in range(len(split)):
                    if split[at : at + len(w[i : i + 3])] == w[i : i + 3]:
                        hit |= set(range(at, at + len(w[i : i + 3])))
                        found.add(item)
        n, spans, got = search.judge(text)
        assert (n, {p for a, b in spans for p in range(a, b)}, got) == (60, hit, found)


# packing

def test_packing(spark, edge, docs):
    run = lambda d: packing.packed(spark, d, PATH)
    for rows, got in both(spark, edge, docs, run):
        want = Counter()
        total = 0
        for doc, text, _ in rows:
            ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]
            total += len(ids)
            for k, at in enumerate(range(0, len(ids), 4096)):
                part = np.array(ids[at : at + 4096], "<u4").tobytes()
                want[(doc, k, at, len(part) // 4, zlib.crc32(part))] += 1
        assert Counter(tuple(r)[:5] for r in got) == want
        sequences = defaultdict(list)
        for r in got:
            sequences[r.sequence_id].append((r.offset, r.length))
        for places in sequences.values():
            ends = [a + n for a, n in sorted(places)]
            assert [0, *ends[:-1]] == [a for a, _ in sorted(places)] and ends[-1] <= 4096
        assert len(sequences) <= -(-total // 4096) * 1.02 + 1


def test_configurations_cover_what_rounding_leaves():
    rng = np.random.default_rng(2)
    counts = Counter(rng.integers(1, 101, 20_000).tolist())
    planned = packing.plan(counts, 100, unit=1)
    used = Counter()
    for times, lengths in planned:
        assert sum(k * n for k, n in lengths) <= 100 and times > 0
        for k, n in lengths:
            used[k] += times * n
    assert used == counts
    assert sum(t for t, _ in planned) <= 1.01 * -(-sum(k * n for k, n in counts.items()) // 100) + 1
    taken = sum(n for n, _ in packing.configurations(counts, 100, 1))
    assert taken > 0.5 * sum(t for t, _ in planned)  # the program decides most sequences


# licences

def test_license_scan(spark, edge, docs):
    tables = license_scan.built(license_scan.TEMPLATES, license_scan.CONTAINMENT)
    for rows, got in both(spark, edge, docs, license_scan.scanned):
        want = Counter()
        for doc, text, _ in rows:
            there = license_scan.shingles_of(text)
            names = sorted(n for n, x in zip(tables.names, tables.sets, strict=True) if np.isin(x, there).mean() >= 0.75)
            want[(doc, ",".join(names))] += 1
        assert Counter((r.doc_id, r.licenses) for r in got) == want


def test_copies_side_by_side_are_counted():
    tables = license_scan.built(license_scan.TEMPLATES, license_scan.CONTAINMENT)
    words = {k: decontaminate.words_of(v) for k, v in license_scan.TEMPLATES.items()}
    text = lambda *parts: b" ".join(b" ".join(p) for p in parts).decode()
    for name in ("MIT/line", "GPL-3.0/line", "ISC/text", "Apache-2.0/notice"):
        for times in (1, 2, 3, 4, 7):
            for gap in ([], [b"and"], [b"so", b"on"] * 40):
                row = license_scan.shingles_of(text(*[x for _ in range(times) for x in (words[name], gap)]))
                found = [m for m in tables.matches(row) if m[0] == name]
                step = len(words[name]) + len(gap)
                assert [m[1:3] for m in found] == [(k * step, k * step + len(words[name])) for k in range(times)]
    # a piece of it before a whole one is no match of its own
    whole = words["ISC/text"]
    row = license_scan.shingles_of(text(whole[10:20], whole, whole[:9]))
    assert [m[1:3] for m in tables.matches(row) if m[0] == "ISC/text"] == [(10, 10 + len(whole))]


def test_licenses_of_a_table(spark):
    table = spark.createDataFrame([("X-1", "one two three four five six seven"), ("X-2", None)], "name string, text string")
    docs = spark.createDataFrame([(1, "so one two three four five six seven end"), (2, "MIT")], "doc_id long, text string")
    got = license_scan.found(docs, ["doc_id"], license_scan.templates_of(table)).collect()
    assert {r.row.doc_id: [m.template for m in r.matches] for r in got} == {1: ["X-1"], 2: []}


def test_edited_licenses_are_found():
    rng = random.Random(6)
    tables = license_scan.built(license_scan.TEMPLATES, license_scan.CONTAINMENT)
    noise = lambda: " ".join(f"w{rng.randrange(9999)}" for _ in range(rng.randrange(200)))
    planted = found = 0
    for name, text in license_scan.TEMPLATES.items():
        for _ in range(20):
            words = decontaminate.words_of(text)
            for _ in range(len(words) // 30):
                words[rng.randrange(len(words))] = b"zz%d" % rng.randrange(99)
            row = license_scan.shingles_of(f"{noise()} {b' '.join(words).decode()} {noise()}")
            if np.isin(tables.sets[tables.names.index(name)], row).mean() >= license_scan.CONTAINMENT:
                planted += 1
                found += name in {m[0] for m in tables.matches(row)}
    assert planted > 100 and found >= 0.99 * planted


# repetition

def repetition_of(text, least):
    words = (text or "").encode().split()
    n, covered, longest = len(words), set(), 0
    for i in range(n):
        best = 0
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and words[i + k] == words[j + k]:
                k += 1
            best = max(best, k)
        if best >= least:
            longest = max(longest, best)
            covered |= set(range(i, i + best))
    runs = defaultdict(list)
    for i in range(n):
        for end in range(i + least, n + 1):
            runs[tuple(words[i:end])].append(i)
    repeats = sum(len(at) > 1 and len({words[i + len(s)] if i + len(s) < n else i for i in at}) > 1
                  and len({words[i - 1] if i else None for i in at}) > 1 for s, at in runs.items())
    windows = Counter(tuple(words[i : i + 5]) for i in range(n - 4))
    twice = {i + k for i in range(n - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return n, len(twice), repeats, longest, sum(len(words[i]) for i in covered) / max(1, sum(map(len, words)))


def test_repetition_measures():
    rng = random.Random(7)
    texts = [None, "", "a", "a b c d e a b c d e"]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(1, 40))) for _ in range(80)]
    texts += [" ".join(rng.choice("abcde") for _ in range(30)) + " x y z" * rng.randint(0, 5) for _ in range(40)]
    for least in (2, 4):
        made = repetition.measured(texts, least)
        for text, *got in zip(texts, *(made[i] for i in (0, 4, 5, 6, 7)), strict=True):
            want = repetition_of(text, least)
            assert tuple(got[:4]) == want[:4] and abs(got[4] - want[4]) < 1e-9


def test_quality_rules(spark, edge, docs):
    for rows, got in both(spark, edge, docs, repetition.judged):
        want = Counter()
        for doc, text, _ in rows:
            text = text or ""
            words = re.findall(r"[^\x20\x09-\x0D]+", text)
            lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
            windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
            twice = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
            failed = len(words) < 10 or 100 * len(twice) > 20 * len(words)
            want[(doc, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
                  len(lines) - len(set(lines)), len(twice), failed)] += 1
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                       for r in got) == want
        assert all(r.kept == (not r.base_failed and r.covered <= 0.25 and r.longest_repeat <= 100) for r in got)


# the pipeline

def test_pipeline_stages(spark, edge, tmp_path):
    """Every stage decides on its whole input, and its decisions take effect."""
    folder = str(tmp_path)
    edge.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"), (2, "other text of an id")],
                          "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    now = common.table(spark, folder, "documents")
    seen = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = common.stored(stage(spark, now, folder))
        assert now.columns == edge.columns
        seen.append(Counter((r.doc_id, r.text) for r in now.collect()))
    lettered = [(d, t) for d, t, _ in EDGE if re.search(r"[^\W\d_]", t or "")]
    assert seen[0] == Counter(lettered)
    assert Counter(d for d, _ in seen[1].elements()) == Counter(d for d, _ in lettered)
    assert "A line" not in dict(seen[1].keys())[100]
    assert seen[1][(106, dict(lettered)[106])] == 1
    assert {200, 4} <= {d for d, _ in seen[2]} and not {201, 202, 203, 204, 5, 7} & {d for d, _ in seen[2]}
    assert not {200, 6} & {d for d, t in seen[3] if t != "one two"}
    packed = corpus_pipeline.STAGES[-1][1](spark, now, folder).collect()
    assert {r.doc_id for r in packed} == {d for d, _ in seen[3]}


def test_pipeline_without_labels(spark):
    """Where no language is told, documents with a letter stay."""
    docs = spark.createDataFrame([(1, "a text", None), (2, "12 !", None), (3, None, None), (4, "п", None)],
                                 "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in corpus_pipeline.known_language(spark, docs, DATA).collect()) == [1, 4]


def test_pipeline_by_brute_force(spark):
    """Every stage of the given documents against plain versions of them, one after the other."""
    now = common.table(spark, DATA, "documents")
    plain = [(r.doc_id, r.text, r.lang) for r in now.collect()]
    # language ID: documents without a letter go
    now = common.stored(corpus_pipeline.known_language(spark, now, DATA))
    plain = [r for r in plain if re.search(r"[^\W\d_]", r[1] or "")]
    assert Counter((r.doc_id, r.text) for r in now.collect()) == Counter(r[:2] for r in plain)
    # line dedup
    want = kept_lines(plain)
    now = common.stored(corpus_pipeline.line_dedup(spark, now, DATA))
    plain = [(r.doc_id, r.text, r.lang) for r in now.collect()]
    digests = Counter((d, hashlib.sha256((t or "").encode()).hexdigest()) for d, t, _ in plain)
    assert digests == Counter({(d, h): n for (d, _, _, h), n in want.items()})
    # near duplicates: the least id of each group, and all texts without words
    kept = {d for d, _, _, k in groups(plain) if k}
    now = common.stored(corpus_pipeline.near_duplicates(spark, now, DATA))
    plain = [r for r in plain if r[0] in kept]
    assert Counter((r.doc_id, r.text) for r in now.collect()) == Counter(r[:2] for r in plain)
    # benchmark passages
    items = [decontaminate.words_of(r.text) for r in common.table(spark, DATA, "benchmark").collect()]
    wanted = {tuple(w[i : i + 10]) for w in items for i in range(max(1, len(w) - 9)) if w}
    sizes = {len(x) for x in wanted}

    def clean(text):
        words = decontaminate.words_of(text)
        return not any(tuple(words[i : i + n]) in wanted for n in sizes for i in range(len(words) - n + 1))

    now = common.stored(corpus_pipeline.without_benchmarks(spark, now, DATA))
    plain = [r for r in plain if clean(r[1])]
    assert Counter((r.doc_id, r.text) for r in now.collect()) == Counter(r[:2] for r in plain)
    # packing
    want = Counter()
    for doc, text, _ in plain:
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], "<u4").tobytes()
            want[(doc, k, at, len(part) // 4, zlib.crc32(part))] += 1
    got = corpus_pipeline.run(spark, DATA).collect()
    assert Counter(tuple(r)[:5] for r in got) == want


def test_pipeline_runs(spark):
    rows = corpus_pipeline.run(spark, DATA)
    assert rows.count() > 0 and rows.where("length > 4096 or offset + length > 4096").count() == 0


def test_workers_give_back_the_words_of_a_task(spark):
    docs = spark.createDataFrame([(i, f"word{i} and more words", "en") for i in range(400)], "doc_id long, text string, lang string")
    common.importable(spark)
    assert packing.pieces(docs.repartition(4), PATH, 4096, 1).count() == 400
    assert near_dedup.sketched(docs.repartition(4)).count() == 400

    def held(batches):
        from eduflow.llm import common, tokens

        n = sum(len(x.known) for x in tokens.WORDS.values()) + len(common.WORD_HASHES)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    assert {r.n for r in spark.range(8).repartition(4).mapInArrow(held, "n long").collect()} == {0}


@pytest.mark.parametrize("batch", [1, 3, 10_000])
def test_keys_of_one_node_are_left_behind(spark, batch):
    rows = [(k, n, 5) for k in range(200) for n in range(k % 4)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = near_dedup.shared(spark.createDataFrame(rows, "key long, node long, n long")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, got)) == [r for r in rows if r[0] % 4 > 1]
