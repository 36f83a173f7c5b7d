"""The pipeline against brute-force versions of its stages, and what every stage promises."""

import random
import re

import corpus_pipeline
import pytest
from .test_text_ops import brute_fingerprint, brute_quality, brute_spans, classes
from .test_tokens_ops import check_pieces

DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def brute_stages(rows):
    """(doc_id, text) of what is left after each of the four filtering stages."""
    rows = [(d, t) for d, t in rows if t and re.search(r"[^\W\d_]", t)]
    yield rows
    rows = [(d, t) for d, t in rows if brute_quality(t)[-1]]
    yield rows
    fps = [brute_fingerprint(t) for _, t in rows]
    root = classes(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    least = {}
    for (d, _), r in zip(rows, root):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    rows = [(d, t) for (d, t), r in zip(rows, root) if d is None or d == least[r]]
    yield rows
    kept = {(None if none else d, n): (gone, text) for none, d, n, gone, text in brute_spans(rows)}
    out = []
    for d, t in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t))
        gone, text = kept[d, n]
        if gone < n or not gone:
            out.append((d, text if gone else t))
    yield out


def rows_of(df):
    return sorted(((r.doc_id is None, r.doc_id or 0, r.text) for r in df.collect()), key=str)


def test_stages_and_run_on_the_small_tables(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    want = list(brute_stages([(r.doc_id, r.text) for r in docs.collect()]))
    for (name, stage), left in zip(corpus_pipeline.STAGES, want):
        docs = corpus_pipeline.materialize(stage(spark, docs, sf_small), "test")
        assert docs.columns == DOC_COLUMNS, name
        assert rows_of(docs) == sorted(((d is None, d or 0, t) for d, t in left), key=str), name
        assert docs.where("n_chars != length(text)").count() == 0, name
    packed = corpus_pipeline.run(spark, sf_small).collect()
    lengths = {}
    for r in packed:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert set(lengths) == {d for d, _ in want[-1]} and all(lengths[r.doc_id] == r.doc_tokens for r in packed)


def test_clean_documents_stay(spark, sf_small):
    """Documents labelled good, of ten words or more, pass the language and quality stages."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("quality = 1").select("doc_id")
    good = docs.join(labels, "doc_id")
    left = corpus_pipeline.quality_rules(spark, corpus_pipeline.language_id(spark, good, ""), "")
    long = good.where("size(split(text, '[ \\n\\t]+')) >= 12").count()
    assert left.count() >= 0.97 * long


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_hard_and_empty_tables(spark, make_docs, hard_rows, name, stage):
    rows = [(d, t, "en" if (d or 0) % 2 else None) for d, t in hard_rows]
    made = stage(spark, make_docs(rows), "")
    assert made.columns == DOC_COLUMNS or name == "packing"
    made.collect()
    assert stage(spark, make_docs([]), "").collect() == []


def test_near_dedup_keeps_one_of_each_group(spark, make_docs):
    text = "alpha beta gamma delta epsilon zeta eta theta " * 4
    rows = [(5, text), (3, text), (3, text), (9, text), (None, text), (11, "other words entirely here"), (12, None)]
    left = corpus_pipeline.near_dedup(spark, make_docs(rows), "")
    assert rows_of(left) == sorted([(False, 3, text), (True, 0, text), (False, 11, "other words entirely here"), (False, 12, None)], key=str)


def test_near_dedup_keeps_one_of_each_group_where_ids_repeat_or_lack(spark, make_docs):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(40)) for _ in range(5)]
    copy = [t.upper() for t in texts]  # another text of the same fingerprint
    rows = [(5, texts[0]), (1, texts[1]), (5, copy[1]),  # 5 is the first of its own group and a copy of 1
            (7, texts[2]), (7, copy[2]), (7, copy[2]), (8, texts[2]),  # two texts of one group under one id
            (None, texts[3]), (None, copy[3]), (None, texts[3]), (9, texts[4])]
    left = rows_of(corpus_pipeline.near_dedup(spark, make_docs(rows), ""))
    assert len(left) == len({(no, d, t.lower()) for no, d, t in left}) == 5
    assert [x for x in left if x[1] in (1, 5, 9)] == sorted([(False, 5, texts[0]), (False, 1, texts[1]), (False, 9, texts[4])], key=str)
    assert {(no, d, t.lower()) for no, d, t in left} >= {(False, 7, texts[2]), (True, 0, texts[3])}


def test_packed_ids_are_the_documents_ids(spark, make_docs, hard_rows):
    from admart.llm.packing import pack
    rows = [(d, t) for d, t in hard_rows if d is not None]
    packed = pack(make_docs(rows), corpus_pipeline.public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=128)
    check_pieces(packed.collect(), rows, 128)
