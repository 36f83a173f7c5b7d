"""Operators 11 to 13: quality classifier, Merkle manifest, whitening."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from admart.llm import merkle, quality_pu, whitening
from admart.llm.queries import QUERIES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# Quality classifier

def good_text(rng):
    words = ["".join(rng.choices("aeioulnrst", k=rng.randint(2, 8))) for _ in range(rng.randint(8, 60))]
    return " ".join(words).capitalize() + "."


def bad_text(rng):
    return rng.choice([lambda t: " ".join(w + "###" for w in t.split()), lambda t: t.upper().replace(" ", "!! "),
                       lambda t: " ".join([t.split()[0]] * 40)])(good_text(rng))


@pytest.fixture(scope="module")
def graded(spark):
    rng = random.Random(3)
    truth = {i: int(rng.random() < 0.7) for i in range(900)}
    docs = [(i, good_text(rng) if truth[i] else bad_text(rng), i) for i in truth] + [(9000, None, 1), (9001, "", 1), (9002, " \n ", 1), (None, "A good text.", 1)]
    labels = [(i, q, 0) for i, q in truth.items() if i % 2]
    return (spark.createDataFrame(docs, "doc_id long, text string, levels long").repartition(5),
            spark.createDataFrame(labels, "doc_id long, quality int, levels long"), truth)


def test_positives_and_unlabelled_text_are_enough(graded):
    docs, labels, truth = graded
    found = {r["doc_id"]: r for r in quality_pu.score_quality(docs, labels).collect()}
    assert len(found) == 904
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items() if i is not None)
    assert found[9000]["score"] == found[9001]["score"] == found[9002]["score"]
    held = [i for i in truth if found[i]["held_out"]]
    assert len(held) > 100 and np.mean([found[i]["predicted"] == truth[i] for i in held]) >= 0.97
    negative = docs.sparkSession.createDataFrame([(i, 0, 0) for i, q in truth.items() if i % 2 and not q], labels.schema)
    again = quality_pu.score_quality(docs, labels.where("quality = 1")).collect()
    assert {(r["doc_id"], round(r["score"], 9)) for r in again} == {(i, round(r["score"], 9)) for i, r in found.items()}  # no negative label is read
    assert {r["score"] for r in quality_pu.score_quality(docs, negative).collect()} == {0.5}


def test_held_out_labels_are_not_read(graded):
    docs, labels, truth = graded
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = ({r["doc_id"]: r["score"] for r in quality_pu.score_quality(docs, x).collect()} for x in (labels, flipped))
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-9 for k in one)


def test_prior_comes_near_the_share_of_positives(graded, spark):
    docs, labels, truth = graded
    rows = quality_pu.levels(docs, "doc_id", "text").where("doc_id < 900")
    good = spark.createDataFrame([(i,) for i, q in truth.items() if q and i % 2], "good_id long")
    counts = rows.join(good, F.col("doc_id") == F.col("good_id"), "left").groupBy("levels").agg(
        F.count(F.lit(1)).alias("n"), F.count("good_id").alias("n_pos"))
    w = quality_pu.fit(counts, 0.5)
    assert abs(quality_pu.estimate_prior(counts, w) - np.mean(list(truth.values()))) < 0.1


def test_risk_is_the_non_negative_one_and_fit_its_least(spark):
    rng = np.random.default_rng(5)
    keys = [bytes(rng.integers(0, 10, size=len(quality_pu.RATIOS)).astype(np.uint8)) for _ in range(60)]
    n, pos = rng.integers(1, 30, size=60), rng.integers(0, 9, size=60)
    counts = spark.createDataFrame([(bytearray(k), int(a), int(b)) for k, a, b in zip(keys, n, pos)], "levels binary, n long, n_pos long").coalesce(2)
    x = np.array([[float(v > c) for v in k for c in range(quality_pu.CUTS)] + [1.0] for k in keys])

    def plain(w, prior):
        z = x @ w
        loss = lambda t: np.log1p(np.exp(-t))
        bad = (n * loss(-z)).sum() / n.sum() - prior * (pos * loss(-z)).sum() / pos.sum()
        return prior * (pos * loss(z)).sum() / pos.sum() + max(0, bad) + 0.5 * quality_pu.RIDGE * (w[:-1] @ w[:-1]) + 0.5e-9 * w[-1] ** 2

    for prior in (0.3, 0.9):
        w = rng.normal(size=quality_pu.WIDTH) * 0.1
        s = quality_pu.sums_of(counts, w)
        value, slope, _, bad = quality_pu.risk(s, w, prior, 1.0 if quality_pu.risk(s, w, prior)[3] > 0 else 0.0)
        assert abs(value - plain(w, prior)) < 1e-9
        step = rng.normal(size=len(w)) * 1e-6
        assert abs(plain(w + step, prior) - plain(w - step, prior) - 2 * slope @ step) < 1e-9
        if prior == 0.9:
            continue
        best = quality_pu.fit(counts, prior)
        # Convex, so no lower place near by means none at all; the clamp is met to TOUCH.
        assert all(plain(best, prior) <= plain(best + rng.normal(size=len(best)) * size, prior) + 2 * quality_pu.TOUCH
                   for size in (0.001, 0.01, 0.1, 1.0) for _ in range(50))


def test_ratios_of_whole_and_very_long_texts():
    table = quality_pu.classes()
    found = dict(zip(quality_pu.RATIOS, quality_pu.ratios("Ab ab ab 12! #\nx |\nx |", table)))
    assert found["words equal to the one before"] == 1 / 9 and found["lines seen before"] == pytest.approx(1 / 3)
    assert found["bars a word"] == 2 / 9 and found["upper case of letters"] == 1 / 8
    long = "word " * 500_000 + "### " * 500_000
    assert dict(zip(quality_pu.RATIOS, quality_pu.ratios(long, table)))["symbols of characters"] == pytest.approx(3 / 7)


def test_empty_table_gives_no_scores(spark, graded):
    docs, labels, _ = graded
    assert quality_pu.score_quality(docs.where("false"), labels).collect() == []
    assert len(quality_pu.score_quality(docs.limit(3), labels.where("false")).collect()) == 3


# Merkle manifest

def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"])))


def brute_manifest(rows):
    def build(level):
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
        return levels

    def way(levels, p):
        out = []
        for level in levels[:-1]:
            out.append((level[p // 8 * 8:p // 8 * 8 + 8], p % 8))
            p //= 8
        return out

    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, out = {}, []
    for lang in langs:
        trees[lang] = sorted([r for r in rows if r["lang"] == lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
    built = {lang: build([leaf_of(r) for r in trees[lang]]) for lang in langs}
    top = build([built[lang][-1][0] for lang in langs])
    for t, lang in enumerate(langs):
        for p, r in enumerate(trees[lang]):
            steps = way(built[lang], p) + way(top, t)
            changed = dict(r)
            if r["doc_id"] is not None and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                changed["text"] = r["text"].translate(str.maketrans(UPPER, LOWER))
            now = leaf_of(changed)
            for run, i in steps:
                now = sha("".join(run[:i] + [now] + run[i + 1:]))
            proof = sha("".join("".join(run[:i] + run[i + 1:]) for run, i in steps))
            out.append((r["doc_id"], leaf_of(r), built[lang][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return out


def run_manifest(spark, docs, tmp_path, name):
    docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
    return [tuple(r) for r in QUERIES["op12_merkle_manifest"](spark, f"{tmp_path}/{name}").collect()]


@pytest.mark.parametrize("sizes", [[1], [8], [9], [1, 1], [65, 1, 2, 8], [600, 9, 1] + [1] * 9])
def test_manifest_equals_brute_force(spark, make_docs, tmp_path, sizes):
    langs = [None, "de", "en", "es", "fr", "É", "z"] + [f"l{i}" for i in range(20)]
    rows = [(17 * i + 1000 * k, f"Text {i} of {k} Ärger", langs[k]) for k, n in enumerate(sizes) for i in range(n)]
    random.Random(1).shuffle(rows)
    docs = make_docs(rows)
    assert sorted(map(str, run_manifest(spark, docs, tmp_path, "d"))) == sorted(map(str, brute_manifest([r.asDict() for r in docs.collect()])))


def test_manifest_of_hard_rows(spark, make_docs, hard_rows, tmp_path):
    rng = random.Random(2)
    docs = make_docs([(*r[:2], rng.choice(["en", "en", "en", "de", None])) for r in hard_rows] * 2)
    assert sorted(map(str, run_manifest(spark, docs, tmp_path, "d"))) == sorted(map(str, brute_manifest([r.asDict() for r in docs.collect()])))
    assert run_manifest(spark, docs.where("false"), tmp_path, "e") == []


def test_jumps_deal_lower_levels_by_key(spark, make_docs, tmp_path, monkeypatch):
    """Without room for a broadcast, the same rows come from joins by key."""
    rows = [(i, f"Text {i}", "en" if i % 3 else "de") for i in range(900)]
    docs = make_docs(rows)
    one = run_manifest(spark, docs, tmp_path, "a")
    monkeypatch.setattr(merkle, "FEW", 1)
    assert sorted(run_manifest(spark, docs, tmp_path, "b")) == sorted(one)
    assert sum(r[-1] for r in one) == sum(zlib.crc32(str(r[0]).encode()) % 3 != 0 for r in one)


# Whitening

def brute_whitening(x, components=16):
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.astype(object).sum(axis=0)
    centred = ((fit.astype(object) * n - sums) / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    rows = ((x.astype(object) * n - sums) / n).astype(float)
    return n, values, rows @ vectors[:, :components] / np.sqrt(np.abs(values[:components])), ((x.astype(object) * n - sums) ** 2).sum(axis=1)


def vectors_table(spark, vectors, parts=4):
    rows = [(i, [None if c is None else float(c) for c in v] if v is not None else None, 7, "n", 1.0) for i, v in vectors]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, x int, component string, n double").repartition(parts)


def test_whitening_equals_eigenvectors(spark):
    rng = np.random.default_rng(1)
    base = (rng.normal(size=(400, 20)) * np.linspace(2, 0.3, 20)).astype(np.float32)
    vectors = [(i, v) for i, v in enumerate(base)] + [(1000 + i, base[3]) for i in range(50)] + [(None, base[5])]
    bad = [(5000, None), (5001, [None] * 20), (5002, [float("nan")] * 20), (5003, [float("inf")] * 20), (5004, [])]
    found = whitening.whiten(vectors_table(spark, vectors + bad)).toPandas()
    x = np.floor(64 * np.stack([v for _, v in vectors]).astype(float)).astype(np.int64) + 1_000_000
    n, values, white, far = brute_whitening(x)
    assert len(found) == len(vectors) * 16 and set(found.n) == {n} and found.identity_error.max() < 1e-9
    table = found[found.vec_id.notna()].pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    order = np.argsort([i for i, _ in vectors[:-1]])
    for k in range(16):
        want = white[:-1][order, k]
        assert min(np.abs(table[:, k] - want).max(), np.abs(table[:, k] + want).max()) < 1e-8
    assert found[found.vec_id == 1000].deviation.iloc[0] == far[3] and list(found[found.vec_id == 7].deviation) == [far[7]] * 16
    assert np.allclose(found.groupby("component").explained.first(), values[:16] / values.sum(), rtol=1e-9)


def test_whitening_returns_components_that_vary(spark):
    line = [(i, [i / 64, 2 * i / 64, 0.0]) for i in range(10)]
    found = whitening.whiten(vectors_table(spark, line)).toPandas()
    assert set(found.component) == {1} and np.allclose(found.explained, 1) and found.identity_error.max() < 1e-9
    assert whitening.whiten(vectors_table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(vectors_table(spark, line).where("false")).collect() == []
    with pytest.raises(ValueError, match="dimensions"):
        whitening.whiten(vectors_table(spark, [(1, [1.0, 2.0]), (2, [1.0])]))


def test_deviation_is_exact_beyond_doubles():
    x = np.array([[2**40 + 1, 5], [3, 2**40]], dtype=np.int64)
    assert whitening.squares(whitening.deviations(x, 3, [7, 9])) == [sum((3 * int(v) - s) ** 2 for v, s in zip(row, (7, 9))) for row in x]


@pytest.mark.parametrize("make", [
    lambda g: np.triu(g.normal(size=(64, 64))), lambda g: np.diag([3.0, 3, 3, 2, 2, 1, 0, 0]), lambda g: np.triu(g.integers(-2, 3, size=(12, 12)).astype(float)),
    lambda g: np.linalg.qr(np.diag([5.0] * 6 + [3.0] * 6 + list(np.linspace(1, 2, 20))) @ np.linalg.qr(g.normal(size=(32, 32)))[0])[1],
    lambda g: np.linalg.qr(np.diag([2.0] * 3 + [0.0] * 9) @ np.linalg.qr(g.normal(size=(12, 12)))[0])[1], lambda g: np.array([[4.0]])])
def test_singular_values_and_vectors(make):
    r = make(np.random.default_rng(4))
    values, vectors = whitening.singular(r, 16)
    true = np.linalg.svd(r, compute_uv=False)
    assert np.allclose(np.sqrt(np.abs(values)), true, atol=1e-7 * true[0])
    assert np.abs(vectors.T @ vectors - np.eye(vectors.shape[1])).max() < 1e-11
    assert np.abs(r.T @ (r @ vectors) - vectors * values[:vectors.shape[1]]).max() < 1e-11 * true[0] ** 2


def test_small_singular_values_keep_their_digits():
    """A graded bidiagonal whose singular values are known from exact arithmetic on its inverse's entries."""
    a, b = np.array([1.0, 1e-8, 1e-16]), np.array([1e-3, 1e-11])
    values = whitening.dqds(a, b)
    assert abs(np.prod(np.sqrt(values)) / np.prod(a) - 1) < 1e-13  # the determinant
    inverse = np.linalg.inv(np.diag(a) + np.diag(b, 1))
    assert abs(np.sqrt(values[-1]) * np.linalg.norm(inverse, 2) - 1) < 1e-12
