"""Merkle manifest, quality classifier and embedding whitening against plain brute force."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from conftest import DATA
from eduflow.llm import common, merkle_manifest, quality_classifier, queries, whitening

CLASH = ["g", "n", "idx", "hash", "row", "path", "top", "before", "after", "height", "difference", "short", "entries", "place"]


def clashing(spark, rows, schema):
    return spark.createDataFrame([(*r, *["?"] * len(CLASH)) for r in rows], schema + "".join(f", {c} string" for c in CLASH))


# Merkle manifest

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + arity]) for i in range(0, len(out[-1]), arity)])
    return out


def way(tree, at, arity):
    for level in tree[:-1]:
        first = at - at % arity
        yield level[first:at], level[at + 1 : first + arity]
        at //= arity


def expected(rows, arity):
    """rows: doc_id, text, lang, source, n_chars."""
    langs = defaultdict(list)
    for doc, text, lang, source, chars in rows:
        own = leaf([doc, source, lang, chars, text])
        hit = doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0 and chars is not None
        langs[lang].append(((doc is not None, doc or 0), own, leaf([doc, source, lang, chars + 1, text]) if hit else own, doc))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = [levels([r[1] for r in sorted(langs[x])], arity) for x in order]
    upper = levels([t[-1][0] for t in trees], arity)
    root = upper[-1][0]
    for k, x in enumerate(order):
        for at, (_, own, changed, doc) in enumerate(sorted(langs[x])):
            sides = [*way(trees[k], at, arity), *way(upper, k, arity)]
            node = changed
            for before, after in sides:
                node = H(*before, node, *after)
            yield (doc, own, trees[k][-1][0], root, H(*[h for b, a in sides for h in [*b, *a]]), node, node == root)


MANIFEST = [(i, f"text {i} é", "en" if i % 3 else None, f"s{i % 4}", i * 7) for i in range(40)] + [
    (3, "another row of one id", "en", "s", 1), (3, "another row of one id", "en", "s", 1), (None, None, "en", None, None),
    (None, "no id", "", "s", 5), (100, None, "é", None, None), (101, "", "é", "", 0), (102, "x" * 200_000, "z", "s", 200_000),
    *[(200 + i, "w", "de", "s", None if i % 2 else 2**63 - 1) for i in range(27)]]
FIELDS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_manifest(spark, arity):
    rows = clashing(spark, MANIFEST, FIELDS).repartition(3)
    found = [tuple(r) for r in merkle_manifest.verified(rows, arity=arity).collect()]
    assert sorted(found, key=repr) == sorted(expected(MANIFEST, arity), key=repr)
    assert {r[-1] for r in found} == {True, False}


def test_manifest_of_few(spark):
    assert merkle_manifest.verified(clashing(spark, [], FIELDS)).count() == 0
    for some in (MANIFEST[:1], MANIFEST[:2], MANIFEST[40:43]):
        found = [tuple(r) for r in merkle_manifest.verified(clashing(spark, some, FIELDS)).collect()]
        assert sorted(found, key=repr) == sorted(expected(some, 2), key=repr)


def test_manifest_sql(spark):
    from checks import compare
    name = "op13_merkle"
    assert compare.differences(spark, compare.open_tables(DATA), DATA, name, queries.queries()[name], queries.SQL[name]) is None


# embedding whitening

def whitened_plainly(vectors):
    """Exact sums with Python numbers, components from numpy."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    n, width = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(width)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in x]
    u = np.array([[(n * c - s) / n for c, s in zip(r, sums, strict=True)] for r in x])
    return n, deviation, u, u.T @ u / n


def held(found, vectors, ids, most=32):
    n, deviation, u, cov = whitened_plainly(vectors)
    values = np.linalg.eigvalsh(cov)[::-1]
    most = min(most, len(vectors[0]))
    by = defaultdict(dict)
    for r in found:
        by[r.component].setdefault(r.vec_id, []).append(r)
    assert sorted(by) == list(range(1, most + 1))
    for k in by:
        rows = [r for i in by[k] for r in by[k][i]]
        assert len(rows) == len(vectors) and {r.n for r in rows} == {n}
        assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-8
        assert rows[0].explained == pytest.approx(max(values[k - 1], 0) / cov.trace(), rel=1e-9, abs=1e-12)
    where = {i: [j for j, x in enumerate(ids) if x == i] for i in set(ids)}
    for i, rows in by[1].items():
        assert sorted(r.deviation for r in rows) == sorted(deviation[j] for j in where[i])
    unique = [(i, w[0]) for i, w in where.items() if len(w) == 1]
    made = np.array([[by[k][i][0].whitened for k in range(1, most + 1)] for i, _ in unique])
    rank = values[:most] > cov.trace() * 1e-12
    assert np.all(made[:, ~rank] == 0)
    # distances do not depend on signs, and projections of the whitening agree with the plain covariance's inverse
    back = np.linalg.lstsq(u[[j for _, j in unique]], made[:, rank], rcond=None)[0]
    assert np.allclose(back.T @ cov @ back, np.eye(int(rank.sum())), atol=1e-6)
    assert np.allclose(cov @ back, back * values[:most][rank], atol=1e-6 * values[0])


def test_whitening_given(spark):
    rows = common.table(spark, DATA, "embeddings").collect()
    held(queries.op12_whitening(spark, DATA).collect(), [r.embedding for r in rows], [r.vec_id for r in rows])


def test_whitening_edges(spark):
    rng = random.Random(4)
    fine = [(i, [rng.gauss(0, 1) * 3**j - 5 for j in range(6)]) for i in range(50)]
    fine += [(7, [1.5] * 6), (7, [1.5] * 6), (None, [-0.25, 0.0, 1e4, -3.0, 2.0, -0.0]), *[(90 + i, [0.5] * 6) for i in range(9)]]
    bad = [(60, None), (61, []), (62, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (63, [math.nan] * 6), (64, [math.inf] + [0.0] * 5),
           (65, [-math.inf] * 6), (66, [1.0] * 5), (67, [2.0**41] * 6)]
    rows = clashing(spark, fine + bad, "vec_id long, embedding array<float>")
    held(whitening.components(rows, "vec_id", "embedding").collect(), [v for _, v in fine], [i for i, _ in fine])
    for none in (rows.limit(0), clashing(spark, bad[:2], "vec_id long, embedding array<float>")):
        assert whitening.components(none, "vec_id", "embedding").count() == 0
    for same in ([(1, [2.0, 3.0])], [(i, [2.0, 3.0]) for i in range(9)]):
        found = whitening.components(clashing(spark, same, "vec_id long, embedding array<float>"), "vec_id", "embedding").collect()
        assert len(found) == 2 * len(same) and {(r.deviation, r.whitened, r.explained, r.identity_error) for r in found} == {(0, 0, 0, 0)}
    far = clashing(spark, [(1, [1e12, 0.0]), (2, [-1e12, 0.5])], "vec_id long, embedding array<float>")
    assert {r.deviation for r in whitening.components(far, "vec_id", "embedding").collect()} == {None}  # beyond a long
    wide = [(i, [float(i * j % 7) for j in range(40)]) for i in range(20)]  # more dimensions than rows, and of low rank
    held(whitening.components(clashing(spark, wide, "vec_id long, embedding array<float>"), "vec_id", "embedding").collect(),
         [v for _, v in wide], [i for i, _ in wide])


def test_block_products():
    rng = np.random.default_rng(1)
    for low, high, n in ((0, 2, 1), (-900, 900, 130), (-(1 << 45), 1 << 45, 70)):
        z = rng.integers(low, high, (n, 5))
        sums, products = whitening.block_products(z)
        plain = z.astype(object)
        assert list(sums) == list(plain.sum(axis=0))
        assert (products == np.triu(plain.T @ plain)).all()


# quality classifier

def test_quality_held_out(spark):
    folder = DATA.replace("sf0.001", "sf0.1")
    found = {r.doc_id: r for r in queries.op11_quality(spark, folder).collect()}
    docs = {r.doc_id: r.text for r in common.table(spark, folder, "documents").collect()}
    assert found.keys() == docs.keys()
    right = {0: [], 1: []}
    for r in common.table(spark, folder, "labels").collect():
        one = found[r.doc_id]
        assert one.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= one.score <= 1
        assert one.predicted == (one.score >= 0.3)
        if one.held_out:
            right[r.quality].append(one.predicted == r.quality)
    assert np.mean(right[1]) >= 0.98 and np.mean(right[0]) >= 0.9


def test_quality_learns_from_the_rest_only(spark):
    """Labels of held-out documents change nothing."""
    docs, labels = common.table(spark, DATA, "documents"), common.table(spark, DATA, "labels")
    turned = labels.withColumn("quality", F.when(quality_classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(
        F.col("quality")))
    first, second = ({r.doc_id: r.score for r in quality_classifier.judged(docs, x).collect()} for x in (labels, turned))
    assert first == second


def test_quality_edges(spark):
    rng = random.Random(2)
    good = [" ".join(rng.choice(["the", "river", "of", "stone", "went", "by", "slowly"]) for _ in range(60)) for _ in range(40)]
    bad = [" ".join(rng.choice(["###", "$$$", "BUY!!", "NOW!!", "%%%"]) for _ in range(60)) for _ in range(40)]
    rows = [(i, x) for i, x in enumerate(good + bad)] + [(900, None), (901, ""), (None, good[0]), (902, good[1]), (902, bad[1]),
                                                         (903, good[2] * 600), (904, bad[2] * 600), (905, "the")]
    docs = clashing(spark, rows, "doc_id long, text string")
    labels = [(i, int(i < 40), 0) for i in range(80)] + [(5, 0, 0), (None, 1, 0), (6, None, 1), (7, 9, 0), (901, 1, 0), (5000, 1, 0)]
    taught = clashing(spark, labels, "doc_id long, quality int, toxic int")
    found = quality_classifier.judged(docs, taught).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    by = defaultdict(list)
    for r in found:
        by[r.doc_id].append(r.predicted)
    assert by[903] == [1] and by[904] == [0] and sorted(by[902]) == [0, 1] and by[None] == [1]
    assert [r.held_out for r in found if r.doc_id is None] == [False]
    assert quality_classifier.judged(docs.limit(0), taught).count() == 0
    assert {r.score for r in quality_classifier.judged(docs, taught.limit(0)).collect()} == {0.5}
    only = quality_classifier.judged(docs, taught.where("quality = 1")).collect()
    assert len(only) == len(rows) and {r.predicted for r in only} == {1}


def test_quality_difference():
    """The sizes are the library's, piece by piece."""
    good, bad = (quality_classifier.dictionary([f"{w} {i} {w * 3} sample".encode() * 4 for i in range(400)]) for w in ("ab", "#!"))
    text = "ab ab 7 #! é" * 300
    data = text.encode()
    sizes = []
    for d in (bad, good):
        made = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False,
                                        write_checksum=False, write_dict_id=False)
        sizes.append(sum(len(made.compress(data[i : i + 512])) for i in range(0, len(data), 512)))
    found, short = quality_classifier.difference(text, good, bad)
    assert abs(found - (sizes[0] - sizes[1]) / len(data)) < 0.01 and not short
    assert quality_classifier.difference(None, good, bad) == quality_classifier.difference("", good, bad) == (None, True)


def test_quality_curve():
    counts = [(-0.2, 0, 50), (-0.1, 1, 20), (0.0, 1, 40), (0.1, 30, 31), (0.2, 99, 100)]
    xs, ys = quality_classifier.curve(counts, 0.5)
    assert xs == sorted(xs) and ys == sorted(ys) and ys[0] < 0.02 and ys[-1] > 0.95
    assert quality_classifier.curve([], 0.25) == ([0.0], [0.25])
