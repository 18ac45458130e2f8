"""Substring deduplication: repeated lines and sentences go, their first occurrence stays.

Units are lines, cut further at sentence ends, so that a passage that was pasted
into the middle of a line still shares its units with other copies.  A unit's
digest is taken over its normalised words.  Digests are counted globally, the
earliest occurrence in the order of document id and offset keeps its place, and
every later one of at least ``min_words`` words is removed.  Shorter units
repeat by chance; they are removed only where they adjoin a removed one, as
inside a copied passage, or where adjoining repeats come to ``MIN_RUN`` words, as
in a list or a poem.  Units without words, such as blank lines, part no run.

Only units that occur twice or more are joined back to their documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from marketlane.llm.common import every_column, plainly_named, row_key, slices, written

MIN_WORDS = 8
#: A run of adjoining repeats of so many words in all goes too, however short its units are.
MIN_RUN = 16
#: A line, or a sentence of it: up to and with its end mark or newline and the white space after it.
UNIT = re.compile(r"[^\n.!?]*(?:[.!?]+(?![\s])[^\n.!?]*)*(?:[.!?]+[^\S\n]*\n?|\n|$)")

UNITS = "key long, doc_id long, unit int, start int, stop int, words int, digest binary"


def units(text: str) -> Iterator[tuple[int, int, int, bytes]]:
    """``start, stop, words, digest`` of each unit; together the units are the whole text."""
    for found in UNIT.finditer(text):
        start, stop = found.span()
        if start == stop:
            continue
        words = text[start:stop].lower().split()
        yield start, stop, len(words), xxhash.xxh3_128_digest(" ".join(words).encode())


def unit_rows(docs: DataFrame) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[list] = [[] for _ in range(7)]
            for key, doc_id, text in zip(*(batch.column(n).to_pylist() for n in ("key", "doc_id", "text"))):
                worded = (u for u in units(text or "") if u[2])  # blank lines don't part what they stand between
                for number, (start, stop, words, digest) in enumerate(worded):
                    for column, value in zip(out, (key, doc_id, number, start, stop, words, digest)):
                        column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
            names = ["key", "doc_id", "unit", "start", "stop", "words", "digest"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    rows = docs.select(row_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(cut, UNITS)


def spans_to_remove(repeats: list[tuple[int, int, int, int]], min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """Merged spans of one document's repeated units ``unit, start, stop, words``; units are numbered without the wordless."""
    repeats = sorted(set(repeats))
    gone: list[tuple[int, int]] = []
    run: list[tuple[int, int, int, int]] = []
    for u in [*repeats, None]:
        if run and (u is None or u[0] != run[-1][0] + 1):
            if any(x[3] >= min_words for x in run) or sum(x[3] for x in run) >= MIN_RUN:
                gone.append((run[0][1], run[-1][2]))
            run = []
        if u:
            run.append(u)
    return gone


def removed_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``key, spans``: what goes from each document row, as merged character spans ``start, stop`` of its original text."""
    rows = unit_rows(docs)
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key", "start")
    repeated = rows.groupBy("digest").agg(F.count("*").alias("n"), F.min(rank).alias("first")).where("n > 1")
    later = rows.join(written(repeated.select("digest", "first"), "substring-repeats"), "digest").where(
        (F.col("first.key") != F.col("key")) | (F.col("first.start") != F.col("start"))
    )
    # a set, since rows that repeat id and text bring the same units
    own = later.groupBy("key").agg(F.collect_set(F.struct("unit", "start", "stop", "words")).alias("repeats"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        for batch in batches:
            spans = [
                [{"start": a, "stop": b} for a, b in spans_to_remove([tuple(r.values()) for r in own], min_words)]
                for own in batch.column("repeats").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(spans, kind)], names=["key", "spans"])

    return own.mapInArrow(merge, "key long, spans array<struct<start:int,stop:int>>").where(F.size("spans") > 0)


def without_spans(docs: DataFrame, spans: DataFrame, keep_spans: bool = False) -> DataFrame:
    """``docs`` with the spans cut out of ``text``; ``__spans`` tells them if asked for."""
    named = spans.select(F.col("key").alias("__key"), F.col("spans").alias("__spans"))
    joined = docs.withColumn("__key", row_key()).join(named, "__key", "left").drop("__key")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("__spans").to_pylist()):
                if gone:
                    ends = [0, *(x for s in gone for x in (s["start"], s["stop"])), len(text)]
                    text = "".join(text[a:b] for a, b in zip(ends[::2], ends[1::2]))
                out.append(text)
            columns = [pa.array(out, batch.schema.field("text").type) if n == "text" else batch.column(n) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    plain = plainly_named(joined, "text", "__spans")
    done = plain.mapInArrow(cut, plain.schema).toDF(*joined.columns)
    return done if keep_spans else done.select(*every_column(docs))


def dedup_documents(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated units cut out of ``text``; all rows and other columns stay.

    Missing texts stay missing and have no units; units are compared in lower
    case and with white space folded.  Ties of id and offset cannot occur but
    for rows that repeat both id and text: these count as one document and keep
    the same text.  Rows without an id rank last.  A document all of whose units
    are repeats keeps an empty text.  An empty table stays empty.
    """
    return without_spans(docs, removed_spans(docs, min_words))


def dedup_report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, text, n_removed, removed``: the remaining text and what went, as spans of the original text."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = without_spans(own, removed_spans(own, min_words), keep_spans=True)
    kind = "array<struct<start:int,stop:int>>"
    removed = F.coalesce("__spans", F.array().cast(kind))
    return rows.select("doc_id", "text", F.size(removed).alias("n_removed"), removed.alias("removed"))
