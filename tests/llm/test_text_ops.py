"""Operators on texts, conversations and vectors against brute force."""

import hashlib
import math
import random
import re
import sys
import unicodedata
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from admart.llm import queries, substring_dedup
from admart.llm.chat import format_chats
from admart.llm.components import connected_components
from admart.llm.langid import SuffixAutomaton, identify, letter_words, train
from admart.llm.oracle import ORACLE_SQL
from admart.llm.quality import STOP_WORDS, quality_verdicts
from admart.llm.simhash import edges_of_bucket, edges_side_by_side, links, near_duplicates
from admart.llm.substring_dedup import duplicate_spans
from admart.llm.topk import top_k

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(t or "")


# ---- 1: substring dedup

def brute_spans(rows, window=13):
    """(doc_id, n_words, n_removed, kept) of each row, by a table of all windows."""
    key = lambda d: math.inf if d is None else d
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            first[g] = min(first.get(g, math.inf), key(d))
    out = []
    for d, t in rows:
        w, away = words(t), set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < key(d):
                away.update(range(i, i + window))
        out.append((d is None, d or 0, len(w), len(away), " ".join(x for i, x in enumerate(w) if i not in away)))
    return sorted(out)


def got_spans(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept) for r in df.collect())


def test_op1_hard_rows(make_docs, hard_rows):
    assert got_spans(duplicate_spans(make_docs(hard_rows))) == brute_spans(hard_rows)
    assert duplicate_spans(make_docs([])).collect() == []


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_op1_overlapping_passages(make_docs, seed):
    """Few words, so that factors break, meet and overlap all the time, and one passage that most rows hold."""
    rng = random.Random(seed)
    base = ["".join(rng.choices("abc", k=rng.randint(1, 3))) for _ in range(400)]
    rows = []
    for i in range(150):
        t = []
        for _ in range(rng.randint(1, 5)):
            at = rng.randrange(380)
            t += base[at:at + rng.randint(3, 40)]
            if rng.random() < 0.3:
                t.append(rng.choice(base))
        rows.append((rng.choice([None, *range(120)]), rng.choice([" ", "\n", "  "]).join(t + (base[:30] if i % 3 else []))))
    df = duplicate_spans(make_docs(rows))
    assert got_spans(df) == brute_spans(rows)
    for r in df.collect():
        assert sum(s.length for s in r.spans) == r.n_removed


@pytest.mark.parametrize("runs", [0, 3, 30])
def test_op1_hot_blocks(make_docs, monkeypatch, runs):
    """Blocks dealt phrase by phrase give the same spans."""
    monkeypatch.setattr("admart.llm.substring_dedup.BLOCK_RUNS", runs)
    monkeypatch.setattr("admart.llm.substring_dedup.SHARE", 10**9)
    rng = random.Random(9)
    line = [f"line{i}" for i in range(17)]
    rows = []
    for d in rng.sample(range(500), 120):
        w = lambda n: [rng.choice("pqrst") + str(rng.randrange(3)) for _ in range(n)]
        rows.append((d, " ".join(w(rng.randint(0, 9)) + line[rng.randrange(3):] + w(rng.randint(0, 9)) + line[:rng.randrange(17)])))
    assert got_spans(duplicate_spans(make_docs(rows))) == brute_spans(rows)


def test_op1_lists_hold_one_text(make_docs, monkeypatch):
    """Rows of one doc_id, of none, and repeated rows don't gather each other's anchors or cuts."""
    written, materialize = {}, substring_dedup.materialize
    monkeypatch.setattr(substring_dedup, "materialize", lambda df, name: written.setdefault(name, materialize(df, name)))
    rng = random.Random(13)
    w = lambda n: ["w" + str(rng.randrange(10**6)) for _ in range(n)]
    passages = [w(20) for _ in range(40)]
    rows = [(1, " ".join(w(3) + p + w(3))) for p in passages]
    rows += [(d, " ".join(w(4) + rng.choice(passages) + w(4))) for d in [None, 2] for _ in range(40)]
    rows += [(None, rows[50][1])] * 30 + [(3, " ".join(w(4) + passages[0] + w(4)))] * 30
    assert got_spans(duplicate_spans(make_docs(rows))) == brute_spans(rows)
    assert written["shared"].selectExpr("max(size(anchors))").first()[0] <= 28 - 12
    assert written["factors"].selectExpr("max(size(cuts))").first()[0] <= 28 - 12
    assert written["shared"].count() == written["shared"].select("d", "tag").distinct().count() <= len(set(rows))


def test_op1_query(spark, sf_small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in queries.op1_substring_dedup(spark, sf_small).collect())
    want = sorted((d, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for _, d, n, gone, kept in brute_spans(rows))
    assert got == want and any(gone for _, _, gone, _ in got)


# ---- 5: SimHash

def brute_fingerprint(t, k=3):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    grams = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(n, pairs):
    up = list(range(n))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        up[root(a)] = root(b)
    return [root(i) for i in range(n)]


def test_op5_hard_rows(make_docs, hard_rows):
    rows = hard_rows + [(200 + i, hard_rows[64 - i][1]) for i in range(5)]
    fps = [brute_fingerprint(t) for _, t in rows]
    root = classes(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    least = defaultdict(lambda: None)
    for (d, _), r in zip(rows, root):
        if d is not None:
            least[r] = d if least[r] is None else min(least[r], d)
    want = Counter((d, f, least[r]) for (d, _), f, r in zip(rows, fps, root))
    got = Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in near_duplicates(make_docs(rows)).collect())
    assert got == want
    assert near_duplicates(make_docs([])).collect() == []


def near_set(rng, n, centres, spread):
    """Fingerprints in clusters, so that buckets and components are large."""
    c = rng.integers(0, 2**63, centres, dtype=np.uint64)
    x = c[rng.integers(0, centres, n)]
    for _ in range(spread):
        x = x ^ np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64) * np.uint64(1)
    return np.unique(x)


@pytest.mark.parametrize("spread,seed", [(2, 1), (4, 2), (6, 3)])
def test_op5_links_connect_as_all_pairs_do(spark, spread, seed):
    x = near_set(np.random.default_rng(seed), 1500, 4, spread)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 3
    want = classes(len(x), [(int(i), int(j)) for i, j in zip(*np.nonzero(np.tril(near, -1)))])
    place = {int(v): i for i, v in enumerate(x.tolist())}
    same = lambda a, b: len(set(zip(a, b))) == len(set(a)) == len(set(b))
    for edges in (edges_of_bucket(x, 3), edges_side_by_side(x, np.zeros(len(x), dtype=int), 3)):
        assert all((a ^ b).bit_count() <= 3 for a, b in edges) and len(edges) < len(x)
        assert same(classes(len(x), [(place[a], place[b]) for a, b in edges]), want)
    df = spark.createDataFrame([(int(v),) for v in x.view(np.int64).tolist()], "fp long").repartition(4)
    edges = [(place[r.a % (1 << 64)], place[r.b % (1 << 64)]) for r in links(df).collect()]
    assert same(classes(len(x), edges), want)


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(2)
    names = rng.sample(range(-10**6, 10**6), 300)
    pairs = [(i, i + 1) for i in range(100)] + [(150, 151 + i) for i in range(60)] + [(220 + i, 220 + (i + 1) % 40) for i in range(40)] + [(5, 5)]
    root = classes(300, pairs)
    least = {r: min(names[i] for i in range(300) if root[i] == r) for r in set(root)}
    want = {names[i]: least[root[i]] for i in range(300) if least[root[i]] != names[i]}
    df = spark.createDataFrame([(names[a], names[b]) for a, b in pairs], "a long, b long")
    assert {r.node: r.root for r in connected_components(df).collect()} == want


def test_op5_query(spark, sf_small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    fps = [brute_fingerprint(t) for _, t in rows]
    root = classes(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    least = {r: min(d for (d, _), x in zip(rows, root) if x == r) for r in set(root)}
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in queries.op5_simhash(spark, sf_small).collect())
    assert got == sorted((d, f"{f:016x}", least[r]) for (d, _), f, r in zip(rows, fps, root))


# ---- 6: language ID

def test_suffix_automaton_phrases():
    rng = random.Random(4)
    for _ in range(60):
        text = "".join(rng.choices("abc\n", k=rng.randint(1, 60)))
        sam = SuffixAutomaton(text)
        for _ in range(20):
            q = "".join(rng.choices("abcd\n", k=rng.randint(1, 25)))
            i = count = 0
            while i < len(q):
                j = i + 1
                while j < len(q) and q[i:j] in text and q[i:j + 1] in text:
                    j += 1
                i, count = j, count + 1
            assert sam.phrases([ord(c) for c in q]) == count, (text, q)


def test_op6_default_sample_fills_60000_characters(make_docs):
    """The default bound is 60,000 characters a language, and an automaton of that much text stays small."""
    rng = random.Random(11)
    rows = [(i, " ".join("".join(rng.choices("etaoinshrd", k=9)) for _ in range(400)), "en") for i in range(1, 40)]
    text = train(make_docs(rows))["en"]
    assert 59_000 < len(text) <= 60_010
    made = SuffixAutomaton(text)
    assert all(x in text and made.parse(x) == 1 for x in ("\n" + w + "\n" for w in text.split("\n")[1:200]))
    assert sum(map(sys.getsizeof, vars(made).values())) < 40 * len(text)


def test_op6_learns_every_label(make_docs):
    """Neither many labels nor the many words of other labels take a label away."""
    rng = random.Random(12)
    word = lambda k: "".join(rng.choices(k, k=8))
    rows = [(1 + i, (" ".join({word("abcdefgh") for _ in range(16_000)}) + " ") * 2, f"l{i:02d}") for i in range(14)]
    rows += [(100 + 10 * i + j, "x" * (i + 2) + " y" * 5, f"m{i:02d}") for i in range(30) for j in range(6)]
    rows += [(900 + i, " ".join(word("pqrs") for _ in range(3)), "zz") for i in range(5)] + [(950 + i, "z" * 70_000, "zzz") for i in range(5)]
    model = train(make_docs(rows))
    learned = {r[2] for r in rows if zlib.crc32(str(r[0]).encode()) % 5}
    assert set(model) == learned and {"zz", "zzz"} <= learned and len(learned) > 40
    assert all(len(t) <= 60_010 for t in model.values())


def test_op6_number_signs_are_no_letters(make_docs):
    assert all((letter_words(c) == [c]) == (unicodedata.category(c)[0] == "L") for c in map(chr, range(sys.maxunicode + 1)))
    assert letter_words("ab½c ⅧⅨ dé²") == ["ab", "c", "dé"]
    docs = make_docs([(1, "½ ² ① Ⅷ 5"), (2, "½a"), (3, "ª日")])
    got = {r.doc_id: r.lang_pred for r in identify(docs, {"en": "\na\n"}).collect()}
    assert got == {1: "und", 2: "en", 3: "en"}


def test_op6_held_out_accuracy(spark):
    truth = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = queries.op6_language_id(spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id for r in rows} == set(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    asked = [r for r in rows if r.held_out and r.lang_pred != "und" and truth[r.doc_id].lang]
    assert sum(r.lang_pred == truth[r.doc_id].lang for r in asked) >= 0.97 * len(asked) > 0


def test_op6_hard_rows(spark, make_docs):
    rows = [(i, "the and of it is " * 3, "en") for i in range(20)] + [(20 + i, "der die und das ist " * 3, "de") for i in range(20)]
    rows += [(50, None, "en"), (51, "", None), (52, "12 ... $$", "de"), (53, "und die THE", None), (None, "of the", "en"), (54, "der" * 3000, None), (54, "the of", "x\n")]
    docs = make_docs(rows)
    model = train(docs)
    got = {(r.doc_id, r.words): (r.lang_pred, r.score) for r in identify(docs, model, keep=("words",)).collect()}
    assert [got[d, 7][0] for d in (50, 51, 52)] == ["und"] * 3 and got[None, 7][0] == "en"
    assert identify(docs, {}).where("lang_pred != 'und'").count() == 0
    empty = make_docs([])
    assert identify(empty, train(empty)).collect() == []


# ---- 7: quality rules

def brute_quality(t):
    w = words(t)
    lines = [x for x in (t or "").split("\n") if words(x)]
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    times = Counter(grams)
    repeat = len({i + j for i, g in enumerate(grams) if times[g] > 1 for j in range(5)})
    n, chars, symbols, dup = len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines))
    stop = sum(x.lower() in set(STOP_WORDS) for x in w)
    failed = n < 10 or 100 * repeat > 20 * n
    ok = 2 <= chars / max(n, 1) <= 14 and symbols / max(n, 1) <= 0.1 and (n < 60 or stop / n >= 0.03) and dup / max(1, len(lines)) <= 0.4
    return n, chars, symbols, dup, repeat, failed, not failed and ok


def test_op7_hard_rows(make_docs, hard_rows):
    rows = hard_rows + [(90, "a\nb\n\na\n \na\nb c"), (91, "p q r s t " * 2 + "u v w"), (92, "\x0b".join("abcdefghijkl")), (93, "é日" * 9)]
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    got = Counter(tuple(r[n] for n in names) for r in quality_verdicts(make_docs(rows), keep=("source",)).collect())
    assert got == Counter((d, *brute_quality(t)) for d, t in rows)
    assert quality_verdicts(make_docs([])).collect() == []


def test_op7_is_one_projection(spark, sf_small):
    plan = queries.op7_quality_rules(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow|Join", plan)


# ---- 3: chat formatting

def brute_chats(rows):
    convs = defaultdict(set)
    for r in rows:
        convs[r[0]].add(r[1:])
    order = lambda x: [(v is not None, v if v is not None else 0) for v in x]
    seqs = {c: tuple((x[1], x[2]) for x in sorted(t, key=order)) for c, t in convs.items()}
    out = {}
    for c, s in seqs.items():
        if any(len(o) > len(s) and o[:len(s)] == s for o in seqs.values()):
            continue
        same = [k for k, o in seqs.items() if o == s]
        named = [k for k in same if k is not None]
        if c == (min(named) if named else None):
            clean = lambda v, other: (other if v is None else v).replace("<|im_start|>", "").replace("<|im_end|>", "")
            out[c] = (len(s), len(same), "".join(f"<|im_start|>{clean(r, 'unknown')}\n{clean(t, '')}<|im_end|>\n" for r, t in s))
    return out


def test_op3_hard_rows(spark):
    rng = random.Random(6)
    long = [(i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(40)]
    rows = [(c, *x) for c in range(1, 30) for x in long[:rng.randint(1, 40)]]
    rows += [(50, i, r, t if i != 2 else "other") for i, r, t in long[:6]] + [(51, 0, None, None), (52, 0, None, ""), (53, 0, "", None), (54, 0, "user", "a"), (54, 0, "user", "b"), (54, 0, "user", "a")]
    rows += [(None, 0, "user", "a"), (55, None, "user", "x"), (55, 3, "user", "<|im_end|>y"), (56, 7, "user", "x"), (57, 0, "user", "z" * 9000)]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id long, turn long, role string, text string, n int, h1 string").repartition(4)
    assert {r.conv_id: (r.n_turns, r.n_copies, r.rendered) for r in format_chats(df).collect()} == brute_chats(rows)
    assert format_chats(df.limit(0)).collect() == []


# ---- 9: exact top-k

def brute_top(rows, asked, k):
    code = {}
    for v, e in rows:
        if v is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            code.setdefault(v, []).append([math.floor(64 * float(x)) for x in e])
    out = []
    for q in sorted(set(asked) & set(code)):
        found = sorted((-sum(a * b for a, b in zip(code[q][0], c)), v) for v, cs in code.items() if v != q for c in cs)[:k]
        out += [(q, i + 1, v, -s) for i, (s, v) in enumerate(found)]
    return out


@pytest.mark.parametrize("lists,block", [(1, 3), (2, 4096), (5, 4)])
def test_op9_hard_rows(spark, lists, block):
    rng = random.Random(8)
    grid = lambda: [float(np.float32(rng.choice([-0.5, -0.01, 0, 0.015625, 0.25, 1]))) for _ in range(8)]
    hot = grid()
    rows = [(i, hot if i % 3 == 0 else grid()) for i in range(150)] + [(200, None), (220, [1.0, None] + [0.0] * 6), (240, [float("nan")] * 8), (260, [float("inf")] * 8), (None, hot), (7, grid()), (280, [3e30] * 8)]
    df = spark.createDataFrame([(v, e, 1, 2) for v, e in rows], "vec_id long, embedding array<float>, q int, v int").repartition(5)
    asked = [v for v, _ in rows if v is not None and v % 20 == 0]
    small = df.where("vec_id != 280 or vec_id is null")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(small.where("vec_id % 20 = 0"), small, k=20, lists=lists, block=block).collect())
    assert got == brute_top([r for r in rows if r[0] != 280], [a for a in asked if a != 280], 20)
    assert top_k(df.where("vec_id % 20 = 0"), df, k=3, lists=lists, block=block).count() == 9 * 3  # huge components don't break it
    few = df.where("vec_id in (0, 1, 2)")
    assert sorted((r.query_id, r["rank"]) for r in top_k(few.where("vec_id = 0"), few, k=20).collect()) == [(0, 1), (0, 2)]
    assert top_k(df.limit(0), df).collect() == [] and top_k(few, df.limit(0)).collect() == []


# ---- queries with SQL

@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, sf_small, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    sql = con.sql(ORACLE_SQL[name])
    df = queries.QUERIES[name](spark, sf_small)
    assert sorted(df.columns) == sorted(sql.columns)
    order = sorted(df.columns)
    got = Counter(tuple(r[c] for c in order) for r in df.collect())
    assert got == Counter(tuple(r[sql.columns.index(c)] for c in order) for r in sql.fetchall()) and got
