import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words long, n_words string, kept string, d int, tag int, fp string, row int, ids int"


def documents(spark, rows, schema=SCHEMA, parts=3):
    """A table of documents from (doc_id, text[, lang]) with extra columns whose names operators use inside."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or ""), 7, "x", "y", 1, 2, "z", 3, 4) for r in rows]
    return spark.createDataFrame(full, schema).repartition(parts)


@pytest.fixture(scope="session")
def make_docs(spark):
    return lambda rows, **kw: documents(spark, rows, **kw)


@pytest.fixture(scope="session")
def hard_rows():
    """Nulls, empty and long texts, copies, shared passages, ties and repeated rows."""
    rng = random.Random(7)
    vocab = ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(60)] + ["The", "of", "Of", "$5", "x|y", "日本", "<|endoftext|>", "don't"]
    text = lambda n: "".join(w + rng.choice([" ", " ", " ", "  ", "\n", "\t", ". "]) for w in rng.choices(vocab, k=n))
    passage, tail = text(40), text(15)
    rows = [(i, text(rng.randint(0, 60))) for i in range(1, 40)]
    rows += [(i, text(10) + passage + text(5)) for i in range(40, 50)]
    rows += [(i, tail + " " + text(8)) for i in range(50, 56)]
    rows += [(60, None), (61, ""), (62, "  \n "), (63, "one"), (64, "a" * 5000), (65, text(4000)), (66, passage + tail), (67, passage),
             (68, passage), (3, text(30)), (70, "12 34 5!"), (None, passage), (None, None), (None, text(20)), (71, "▁ ▁a  b ")]
    rows += [(80, rows[0][1])] * 3 + [rows[5], rows[5], (0, rows[41][1]), (81, "la " * 40), (82, "x y z " * 12)]
    return rows
