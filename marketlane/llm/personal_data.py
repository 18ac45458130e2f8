"""Personal data: fixed expressions give seeds, and patterns learnt from their surroundings find further identifiers.

1. One pass over the texts finds e-mail addresses, IP addresses, card and phone numbers
   by their expressions (the base), and besides them every other token that holds a
   digit or an at sign (a candidate), each with its lexical contexts: the two words
   before it, and the word before with the word after.  Only these mentions go on; the
   texts are not read again.
2. Mentions make a graph of contexts and values.  A context is a pattern of a kind if
   enough of its distinct values are known to be of that kind: ``known / (all + PRIOR)``
   is its confidence, so sixteen distinct values without an exception are needed for
   0.8.  A value of unknown kind is scored over its patterns as ``1 - prod(1 - confidence)``.
   Values that reach ``LEAST`` and look like the kind at all become known, which raises
   patterns in turn; this goes on until a round adds nothing.  Every round is a handful
   of joins and sums in Spark over the edges, summed per context and value beforehand.
3. All mentions of a value found are spans of its documents, beside the base.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from marketlane.llm.common import slices, to_batch, written

KINDS = ("email", "ip", "card", "phone")
#: Values a pattern must outweigh; least confidence of a discovery; least confidence of a pattern that counts at all.
PRIOR = 4
LEAST = 0.8
WEAK = 0.5
#: Characters before and after a mention in which its context words are looked for.
REACH = 64

# Fixed expressions of the base kinds.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: A token with a digit or an at sign, and groups of digits that follow it one space apart.
TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?:\x20[(]?[0-9][0-9().-]*+(?!\S))*+")
EDGES = " \t\r\n.,;:!?\"'`*#|<>()[]{}=&%$"
WORD = re.compile(r"\S+")

SPAN = "struct<kind:int,start:long,stop:long>"
MENTION = "struct<kind:int,start:long,stop:long,value:string,before:string,around:string>"
ROW = f"doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans array<{SPAN}>, mentions array<{MENTION}>"


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, at sign and domain; found from the at signs, in linear time."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            free = domain.end()
        # an at sign is no part of either side, so none can be skipped
        free = max(free, at + 1)
        at = text.find("@", free)
    return out


def luhn(digits: str) -> bool:
    odd = sum(int(c) for c in digits[-1::-2])
    return (odd + sum(d - 9 if (d := 2 * int(c)) > 9 else d for c in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``kind, start, stop`` of the base, by kind and start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """Base spans and candidates of one text with their contexts, by place."""
    found = [(a, b, k) for k, a, b in base]
    taken = sorted((a, b) for _, a, b in base)
    place = 0
    for m in TOKEN.finditer(text):
        a, b = m.span()
        while a < b and text[a] in EDGES and not (text[a] == "(" and text.find(")", a, b) > 0):
            a += 1
        while b > a and text[b - 1] in EDGES and not (text[b - 1] == ")" and text.find("(", a, b) >= 0):
            b -= 1
        while place < len(taken) and taken[place][1] <= a:
            place += 1
        if b - a >= 4 and not (place < len(taken) and taken[place][0] < b):
            found.append((a, b, None))
    out = []
    for a, b, kind in sorted(found, key=lambda f: (f[0], f[1], -1 if f[2] is None else f[2])):
        left = WORD.findall(text[max(0, a - REACH) : a])[-2:]
        right = WORD.findall(text[b : b + REACH])[:1]
        left = [w.lower() for w in left]
        out.append(
            {
                "kind": kind,
                "start": a,
                "stop": b,
                "value": text[a:b].lower(),
                "before": " ".join(left) if len(left) == 2 else None,
                "around": f"{left[-1]} _ {right[0].lower()}" if left and right else None,
            }
        )
    return out


def extracted(docs: DataFrame) -> DataFrame:
    """Per row the base and all mentions; the one pass over the texts."""
    place = [("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())]
    words = [("value", pa.string()), ("before", pa.string()), ("around", pa.string())]
    lists = [("spans", pa.list_(pa.struct(place))), ("mentions", pa.list_(pa.struct(place + words)))]
    counts = [(f"n_{k}", pa.int64()) for k in KINDS]
    schema = pa.schema([("doc_id", pa.int64()), *counts, ("base_sha256", pa.string()), *lists])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            base, all_mentions, digests = [], [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                own = base_spans(text)
                base.append(own)
                all_mentions.append(mentions(text, own))
                digests.append(hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in own).encode()).hexdigest())
            yield to_batch(
                schema,
                doc_id=batch.column("doc_id"),
                **{f"n_{name}": [sum(1 for s in own if s[0] == k) for own in base] for k, name in enumerate(KINDS)},
                base_sha256=digests,
                spans=[[{"kind": k, "start": a, "stop": b} for k, a, b in own] for own in base],
                mentions=all_mentions,
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ROW)


def plausible() -> Column:
    """Whether ``value`` looks like ``kind`` at all; fixed rules."""
    digits = F.length(F.regexp_replace("value", "[^0-9]", ""))
    return (
        F.when(F.col("kind") == 0, F.col("value").rlike(r"^[^@]+@[^@]+$|[(\[]at[)\]]"))
        .when(F.col("kind") == 1, F.col("value").rlike(r"^[0-9a-f.:]+$") & (F.length(F.regexp_replace("value", "[^.:]", "")) >= 3))
        .when(F.col("kind") == 2, F.col("value").rlike("^[0-9 -]+$") & digits.between(12, 19))
        .otherwise(F.col("value").rlike("^[0-9 ().+/-]+$") & digits.between(7, 15))
    )


def edges(places: DataFrame, least_values: int) -> DataFrame:
    """Distinct ``context, value, n``; ``n`` is the number of distinct values of the context.

    Contexts of fewer than ``least_values`` can't gain the confidence of a pattern, however many of their values
    become known; they are left out.
    """
    each = places.select(
        "value", F.explode(F.array(F.concat(F.lit("b "), "before"), F.concat(F.lit("a "), "around"))).alias("context")
    )
    each = written(each.where(F.col("context").isNotNull()).distinct(), "personal-edges")
    sizes = each.groupBy("context").agg(F.count("*").alias("n")).where(F.col("n") >= least_values)
    return each.join(sizes, "context")


def discovered(places: DataFrame, prior: float = PRIOR, least: float = LEAST) -> DataFrame:
    """``value, kind`` of the identifiers that patterns find, until a round finds no more.

    ``places`` has ``kind`` (missing for candidates), ``value``, ``before``, ``around``.  A value that any base
    expression matched is never found anew; of several kinds the highest score wins, ties in the order of ``KINDS``.
    """
    spark = places.sparkSession
    seeds = places.where(F.col("kind").isNotNull()).groupBy("value").agg(F.min("kind").alias("kind"))
    graph = written(edges(places, math.ceil(prior * WEAK / (1 - WEAK))), "personal-graph")
    known = written(seeds, "personal-known")
    found = known.limit(0)
    while True:
        named = graph.join(known, "value", "left")
        per_kind = [F.count(F.when(F.col("kind") == k, 1)).alias(f"k{k}") for k in range(len(KINDS))]
        contexts = named.groupBy("context").agg(F.first("n").alias("n"), *per_kind)
        best = F.array(*[F.struct((F.col(f"k{k}") / (F.col("n") + prior)).alias("confidence"), F.lit(k).alias("kind")) for k in range(len(KINDS))])
        patterns = contexts.select("context", F.explode(best).alias("p")).select("context", "p.*").where(F.col("confidence") >= WEAK)
        fresh = named.where(F.col("kind").isNull()).select("value", "context")
        doubt = F.sum(F.log1p(-F.col("confidence")))
        scored = fresh.join(patterns, "context").groupBy("value", "kind").agg((1 - F.exp(doubt)).alias("score"))
        scored = scored.where((F.col("score") >= least - 1e-9) & plausible())
        new = scored.groupBy("value").agg(F.max(F.struct("score", -F.col("kind"))).alias("s")).select("value", (-F.col("s.col2")).alias("kind"))
        new = written(new, "personal-new")
        if not new.limit(1).count():
            return found
        found = found.unionByName(new)
        known = known.unionByName(new)


def personal_data(docs: DataFrame, prior: float = PRIOR, least: float = LEAST) -> DataFrame:
    """Per row ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found``.

    The counts and the digest are those of the base; ``spans`` lists ``kind:start:end`` of
    base and discoveries by kind and start, in code points, and ``n_found`` the number of
    discoveries.  Missing and empty texts have no spans.  Every input row gives one row,
    repeated rows and rows without an id too; extra columns are ignored.  An empty table
    gives no rows.  A text is read whole, however long; only contexts are looked for in
    the ``REACH`` characters beside a mention.
    """
    rows = written(extracted(docs).withColumn("uid", F.monotonically_increasing_id()), "personal-mentions")
    places = rows.select("uid", F.explode("mentions").alias("m")).select("uid", "m.*")
    found = discovered(places, prior, least)
    added = (
        places.where(F.col("kind").isNull())
        .drop("kind")
        .join(found, "value")
        .groupBy("uid")
        .agg(F.collect_list(F.struct("kind", "start", "stop")).alias("added"))
    )
    every = F.array_sort(F.concat("spans", F.coalesce("added", F.array().cast("array<struct<kind:int,start:long,stop:long>>"))))
    names = F.array(*map(F.lit, KINDS))
    line = F.transform(every, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"]))
    return rows.join(added, "uid", "left").select(
        "doc_id",
        *(f"n_{k}" for k in KINDS),
        "base_sha256",
        F.array_join(line, ",").alias("spans"),
        F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_found"),
    )
