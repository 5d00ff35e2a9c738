"""License scans: where texts hold license phrases and license notices.

Method. Diagonal voting. Every rolling k-gram of a text's words is hashed and
joined, by Spark, to the k-gram positions of the templates. A match of text
position p with template position t votes for the diagonal p - t: a copy of
the template puts all its votes on one diagonal, an inserted or lost word moves
the rest to one close by. Votes are aggregated by diagonal, neighbouring
diagonals that touch in the text are merged, and each span is verified on the
text itself: a phrase must stand there word by word, a notice must share
``LEAST_SHARE`` of its words, in order (longest common subsequence).

Scale. Hashing is a map, and the join is one too: the template table is
broadcast, its size is known and checked (``MOST_GRAMS`` rows; beyond it
Spark joins by shuffle). Only matches are shuffled, as sets of template
positions by diagonal that are combined in the task first. Rows meet their
spans again by a digest of the text, so copies of a text share one set of
spans and no row needs an id. A task holds one text and its spans.

Defined results: a null text is empty; an empty text has no words and no
spans; places may overlap and count each; repeated rows give repeated results;
several notices of one label give one span each; an empty table gives an empty
result; other columns are not read. Hashes only propose: a collision cannot
add a span.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qtrail.llm.common import BYTE_LOWER, by_bytes, hash_runs, local_rows, materialize, mix, slices, text_column

SHORT, LONG = 2, 5  # words of a k-gram: of phrases, of notices
SLICE = 1 << 16  # words of one row of hashes
SEGMENT = 1 << 19  # bytes hashed at once
MOST_GRAMS = 1_000_000  # template positions that are broadcast
DRIFT = 8  # words that merged diagonals may lie apart, and that may lie between their spans
LEAST_VOTES = 0.2  # share of a notice's k-grams that a span needs
LEAST_SHARE = 0.6  # share of a notice's words that a span must hold
U64 = np.uint64


@dataclass(frozen=True)
class Template:
    """A phrase (``exact``: it counts where its words stand consecutively) or
    a notice. ``base`` marks those of the plain phrase list."""
    label: str
    text: str
    exact: bool = False
    base: bool = False


# Phrases and the labels they give.
BASE_PHRASES = (
    Template("gpl", "gnu general public license", exact=True, base=True),
    Template("apache", "apache license", exact=True, base=True),
    Template("cc-by", "cc by", exact=True, base=True),
    Template("mit", "mit license", exact=True, base=True),
)
# Labels of the method: versions and variants, and notices as their licenses
# ask to print them.
MORE_TEMPLATES = (
    Template("gpl-2", "gnu general public license version 2", exact=True),
    Template("gpl-3", "gnu general public license version 3", exact=True),
    Template("lgpl", "gnu lesser general public license", exact=True),
    Template("apache-2.0", "apache license version 2 0", exact=True),
    Template("cc-by-nc", "cc by nc", exact=True),
    Template("cc-by-sa", "cc by sa", exact=True),
    Template("cc-by-nd", "cc by nd", exact=True),
    Template("bsd", "bsd license", exact=True),
    Template("mpl", "mozilla public license", exact=True),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
             "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
             "(at your option) any later version."),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except "
             "in compliance with the License. You may obtain a copy of the License at"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
             "associated documentation files (the Software), to deal in the Software without restriction"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
             "provided that the following conditions are met"),
    Template("cc-by", "This work is licensed under the Creative Commons Attribution 4.0 International License"),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
             "MPL was not distributed with this file, You can obtain one at"),
)
TEMPLATES = BASE_PHRASES + MORE_TEMPLATES

# Digits, letters and bytes from 0x80 make words; A-Z become a-z.
_WORD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_GRAM = np.random.default_rng(20240611).integers(1, 2**63, LONG, dtype=np.uint64) * U64(2) + U64(1)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD).split()


def word_hashes(plain: bytes) -> tuple[np.ndarray, np.ndarray]:
    """``(start, hash)`` of each word of a translated text."""
    starts, hashes, at = [], [], 0
    while at < len(plain):
        stop = len(plain)
        if stop - at > SEGMENT:
            gap = plain.find(b" ", at + SEGMENT)
            stop = gap if gap >= 0 else stop
        buf = np.frombuffer(plain, np.uint8, stop - at, at)
        word = buf != 32
        word[1:] &= ~word[:-1]
        first = np.flatnonzero(word)
        if first.size:
            starts.append(first + at)
            hashes.append(hash_runs(buf, first, BYTE_LOWER))
        at = stop
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """A hash, never 0, of the k-gram at each word; 0 at the last k - 1."""
    out = np.zeros(words.size, np.uint64)
    if words.size >= k:
        n = words.size - k + 1
        total = words[:n] * _GRAM[0] + U64(k)
        for j in range(1, k):
            total += words[j:n + j] * _GRAM[j]
        out[:n] = mix(total) | U64(1)
    return out


def gram_size(template: Template) -> int:
    return SHORT if template.exact else LONG


def template_grams(templates: tuple[Template, ...]) -> list[tuple[int, int, int]]:
    """``(hash, template, position)`` of every k-gram of the templates."""
    out = []
    for i, template in enumerate(templates):
        k = gram_size(template)
        words = word_hashes(template.text.encode().translate(_WORD))[1]
        if words.size < k:
            raise ValueError(f"a template needs {k} words: {template.text!r}")
        out += [(h, i, p) for p, h in enumerate(grams(words, k).view(np.int64).tolist()[:words.size - k + 1])]
    return out


def rolling_hashes(docs: DataFrame) -> DataFrame:
    """``a, b, base, n, hashes`` of rows ``a, b, text``: of each ``SLICE``
    words from ``base`` on, the ``n`` short k-grams and then the long ones."""
    schema = "a long, b long, base long, n int, hashes array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = text_column(b)
            for lo, hi in by_bytes([len(t) + 1 for t in texts], SEGMENT):
                plain = b" ".join(texts[lo:hi]).translate(_WORD)
                starts, hashes = word_hashes(plain)
                ends = np.cumsum([len(t) + 1 for t in texts[lo:hi]])
                cut = np.concatenate([[0], np.searchsorted(starts, ends)])
                row, base, size, flat = [], [], [], []
                for i in range(hi - lo):
                    mine = hashes[cut[i]:cut[i + 1]]
                    for at in range(0, mine.size, SLICE):
                        part = mine[at:at + SLICE + LONG - 1]
                        n = min(SLICE, mine.size - at)
                        row.append(lo + i)
                        base.append(at)
                        size.append(n)
                        flat += [grams(part, SHORT)[:n], grams(part, LONG)[:n]]
                if row:
                    offsets = np.concatenate([[0], np.cumsum(np.array(size) * 2)])
                    values = pa.array(np.concatenate(flat).view(np.int64))
                    take = pa.array(row, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(take), b.column(1).take(take), pa.array(base, pa.int64()),
                         pa.array(size, pa.int32()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)],
                        names=["a", "b", "base", "n", "hashes"])

    return docs.select("a", "b", "text").mapInArrow(run, schema)


def candidate_spans(docs: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """``a, b, spans`` of the texts with matches; a span has its template, its
    first word and the word after its last."""
    spark = docs.sparkSession
    rows = template_grams(templates)
    known = local_rows(spark, rows, "hash long, template int, t int")
    known = F.broadcast(known) if len(rows) <= MOST_GRAMS else materialize(known, "template-grams")
    each = rolling_hashes(docs).select("a", "b", "base", "n", F.posexplode("hashes").alias("at", "hash"))
    votes = each.join(known, "hash").select(
        "a", "b", "template", "t", (F.col("base") + F.col("at") % F.col("n")).alias("p"))
    # Sets of positions: copies of a text, which share a digest, do not add up.
    diagonals = votes.groupBy("a", "b", "template", (F.col("p") - F.col("t")).alias("diagonal")).agg(
        F.min("p").alias("first"), F.max("p").alias("last"), F.collect_set("t").alias("ts"))
    about = local_rows(spark, [(i, t.exact, 0 if t.exact else gram_size(t), len(words_of(t.text.encode())) - gram_size(t) + 1)
                               for i, t in enumerate(templates)], "template int, exact boolean, k int, grams int")
    order = Window.partitionBy("a", "b", "template").orderBy("first", "diagonal")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = (F.col("exact") | before.isNull() | (F.col("first") > before + F.col("k") + DRIFT)
             | (F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) > DRIFT))
    merged = (diagonals.join(F.broadcast(about), "template").withColumn("new", apart.cast("int"))
              .withColumn("span", F.sum("new").over(order))
              .groupBy("a", "b", "template", "span", "exact", "k", "grams")
              .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.min("diagonal").alias("diagonal"),
                   F.size(F.array_distinct(F.flatten(F.collect_list("ts")))).alias("votes")))
    enough = F.when(F.col("exact"), F.col("votes") == F.col("grams")).otherwise(F.col("votes") >= F.col("grams") * LEAST_VOTES)
    span = F.struct(F.col("template"), F.when(F.col("exact"), F.col("diagonal")).otherwise(F.col("first")).alias("first"),
                    (F.col("last") + F.col("k")).alias("after"))
    return merged.where(enough).groupBy("a", "b").agg(F.sort_array(F.collect_list(span)).alias("spans"))


def in_order(text: list[bytes], template: list[bytes]) -> int:
    """Length of the longest common subsequence of words."""
    code = {w: i for i, w in enumerate(dict.fromkeys(template))}
    wanted = np.array([code[w] for w in template])
    best = np.zeros(wanted.size + 1, np.int64)
    for w in text:
        if w in code:
            step = best.copy()
            step[1:] = np.maximum(step[1:], best[:-1] + (wanted == code[w]))
            best = np.maximum.accumulate(step)
    return int(best[-1])


SPANS = T.ArrayType(T.StructType([
    T.StructField("label", T.StringType()), T.StructField("base", T.BooleanType()),
    T.StructField("first", T.LongType()), T.StructField("words", T.LongType()), T.StructField("share", T.DoubleType())]))


def verified(rows: DataFrame, templates: tuple[Template, ...], key: str) -> DataFrame:
    """``key, n_words, spans`` of rows ``key, text, spans``."""
    schema = T.StructType([rows.schema[key], T.StructField("n_words", T.LongType()), T.StructField("spans", SPANS)])
    wanted = [words_of(t.text.encode()) for t in templates]
    kind = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("first", pa.int64()), ("words", pa.int64()),
                               ("share", pa.float64())]))

    def check(words: list[bytes], span: dict) -> dict | None:
        template, pattern = templates[span["template"]], wanted[span["template"]]
        first, after = span["first"], span["after"]
        if template.exact:
            after = first + len(pattern)
            share = float(first >= 0 and words[first:after] == pattern)
        else:
            first, after = max(0, first - DRIFT), min(len(words), after + DRIFT)
            share = in_order(words[first:after], pattern) / len(pattern)
        if share < (1.0 if template.exact else LEAST_SHARE):
            return None
        return {"label": template.label, "base": template.base, "first": first, "words": after - first, "share": share}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            counts, found = [], []
            for text, spans in zip(text_column(b), b.column(2).to_pylist()):
                plain = text.translate(_WORD)
                if spans:
                    words = plain.split()
                    counts.append(len(words))
                    found.append([s for s in (check(words, span) for span in spans) if s])
                else:
                    word = np.frombuffer(plain, np.uint8) != 32
                    counts.append(int((word[1:] & ~word[:-1]).sum() + word[:1].sum()))
                    found.append([])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(found, kind)],
                                             names=schema.names)

    return rows.select(key, "text", "spans").mapInArrow(run, schema)


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """``key``, ``n_words`` and ``spans`` (label, base, first word, words,
    share of the template's words) of every row."""
    text_of = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`"), text_of.alias("text"), F.xxhash64(text_of).alias("a"),
                       F.xxhash64(F.lit("license"), text_of).alias("b"))
    spans = materialize(candidate_spans(rows, templates), "license-spans")
    return verified(rows.join(spans, ["a", "b"], "left"), templates, key)
