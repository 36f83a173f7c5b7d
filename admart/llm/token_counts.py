"""Token counts without materialising ids: pieces are counted once per distinct pre-token.

A pre-token is a run of spaces and the connected characters after it (see pieces.Model): no piece of the model
reaches across two of them, so their counts add up.

1. Every input partition counts its pre-tokens; Spark sums these to corpus frequencies.
2. The library encodes each distinct pre-token once, and only the number of pieces is kept.
3. The ``dictionary`` most frequent pre-tokens (a fixed bound) with their counts go to every task, which
   sums them at once; the other pre-tokens of a document become (doc, pre-token, frequency) rows, joined
   to the counts by key. Frequent pre-tokens, which would be hot keys, never reach the join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_columns, materialize

from .pieces import load

#: Frequencies are told apart by a factor of about 1.09 when the most frequent pre-tokens are chosen.
STEPS = 8


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, dictionary: int = 200_000,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``).

    Null and empty texts have 0 bytes and 0 tokens. Null doc_ids stay null. Repeated rows are each counted;
    rows are told apart by a row number, so rows that share a doc_id keep their own counts.
    """
    spark = docs.sparkSession
    base = doc_columns(docs, id_col, text_col)

    def count_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        pretokens = load(model_path).pretokens
        for batch in batches:
            for text in batch.column(0):
                seen.update(pretokens(text.as_py()))
            if len(seen) > 300_000:
                yield pa.RecordBatch.from_pydict({"pretoken": list(seen), "freq": list(seen.values())})
                seen.clear()
        if seen:
            yield pa.RecordBatch.from_pydict({"pretoken": list(seen), "freq": list(seen.values())})

    def count_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        if any("\n" in p for p in model.ids):
            raise ValueError(f"{model_path}: a piece holds a line feed, which is to part pre-tokens from the library's mark")
        before = len(model.library.encode("\n"))  # the mark and the line feed: no piece reaches across it
        for batch in batches:
            for low in range(0, batch.num_rows, 5000):
                some = batch.slice(low, 5000)
                made = model.library.encode(["\n" + t for t in some.column(0).to_pylist()], num_threads=1)
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array([len(m) - before for m in made], type=pa.int32())],
                                                 names=["pretoken", "freq", "pieces"])

    freq = (base.select("text").mapInArrow(count_partition, "pretoken string, freq long")
            .groupBy("pretoken").agg(F.sum("freq").alias("freq")))
    counts = materialize(freq.mapInArrow(count_pieces, "pretoken string, freq long, pieces int"), "pieces")

    # At most ``dictionary`` rows, by their counts: the bound of what is broadcast.
    level = F.floor(F.log2("freq") * STEPS)
    least, held = None, 0
    for row in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # 8 rows for each power of two
        held += row["count"]
        if held > dictionary:
            break
        least = row["level"]
    top = counts.where(level >= least if least is not None else F.lit(False)).select("pretoken", "pieces").toPandas()
    known = spark.sparkContext.broadcast(dict(zip(top["pretoken"].tolist(), top["pieces"].tolist())))

    def count_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, pretokens = known.value, load(model_path).pretokens
        for batch in batches:
            rows, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for low in range(0, batch.num_rows, 500):
                out: dict[str, list] = {"row": [], "doc_id": [], "n_bytes": [], "n": [], "pretoken": []}
                for row, doc, text in zip(rows[low:], ids[low:], batch.column(2)[low:low + 500]):
                    text, sure = text.as_py(), 0
                    for word, times in Counter(pretokens(text)).items():
                        if word in pieces:
                            sure += times * pieces[word]
                        else:
                            for k, v in zip(out, (row, None, None, times, word)):
                                out[k].append(v)
                    for k, v in zip(out, (row, doc, len(text.encode()) if text else 0, sure, None)):
                        out[k].append(v)
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n", pa.int64()), ("pretoken", pa.string())]))

    numbered = base.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    parts = materialize(numbered.mapInArrow(count_docs, "row long, doc_id long, n_bytes long, n long, pretoken string"), "frequencies")
    rest = (parts.where(F.col("pretoken").isNotNull()).select("row", "pretoken", "n")
            .join(counts.select("pretoken", "pieces"), "pretoken")
            .select("row", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_bytes"), (F.col("n") * F.col("pieces")).alias("n")))
    own = parts.where(F.col("pretoken").isNull()).select("row", "doc_id", "n_bytes", "n")
    # Each row number has one row with doc_id and n_bytes; max() takes them from it.
    return (own.unionByName(rest).groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("n").alias("n_tokens"))
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
