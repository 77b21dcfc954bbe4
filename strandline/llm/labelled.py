"""Bounded samples of labelled rows for training, and held-out folds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import hash_spans, text_bytes


def remainder(n: int) -> Column:
    """crc32 of doc_id as text, modulo n; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def held_out(n: int, fold: int) -> Column:
    """True for the fold that training never sees; a null doc_id is in no fold."""
    return F.coalesce(remainder(n) == fold, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, n: int, fold: int, max_docs: int, max_chars: int) -> DataFrame:
    """(doc_id, text, label) of at most max_docs documents outside the fold, chosen by hash of doc_id, in order of doc_id.

    Documents longer than max_chars code points aren't learned from.  Repeated labels of a document
    count as the rounded mean; null labels and null texts are skipped; of rows that repeat a doc_id the
    least text counts, so that a table gives one sample however it is partitioned.  The choice is made on ids
    alone, before any text is moved.
    """
    marks = labels.where(F.col(label).isNotNull()).groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    usable = docs.where(F.col("text").isNotNull() & (F.length("text") <= max_chars) & (remainder(n) != fold))
    chosen = marks.join(usable.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    return usable.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label")).orderBy("doc_id")


def distinct_texts(rows: pa.Table) -> tuple[pa.Array, np.ndarray]:
    """Texts and labels of a sample, copies counted once."""
    texts = pa.concat_arrays(rows.column("text").chunks)
    data, offsets = text_bytes(texts)
    single = np.sort(np.unique(hash_spans(data, offsets[:-1], offsets[1:]), return_index=True)[1])
    return texts.take(pa.array(single)), rows.column("label").to_numpy()[single]
