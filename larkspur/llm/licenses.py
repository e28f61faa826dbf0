"""License scan by diagonal voting: word k-grams of all texts are joined to the places of templates, and hits on one diagonal vote for a place.

The diagonal of a hit is its place in the text less its place in the template. Neighbouring diagonals are one candidate,
as edits within a notice shift what follows them; candidates are verified word by word.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import GOLDEN, Powers, bound_batches, cut, mix
from larkspur.llm.shingles import PIECE, WORDS, pieces
from larkspur.llm.urls import MAX_BLOCKS, _block, _mask, bloom_blocks

#: Words of a gram: two for phrases, which are found as they are, five for notices.
SHORT, LONG = 2, WORDS
#: Share of a notice's words that may be edited.
EDITS = 0.2
#: Grams of a text in a row at most, and template grams up to which they are broadcast.
ROW_GRAMS, MAX_BROADCAST_GRAMS = 1 << 16, 200_000

# Bytes of words: digits, letters (A-Z lower-cased) and all beyond ASCII; others end a word.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_powers = Powers(0x2545F4914F6CDD1D)


class Template(NamedTuple):
    label: str
    text: str
    #: A base phrase: its words must stand there without any edit.
    base: bool = False


# The phrases of the contract.
PHRASES = [
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
]

# Short lines and the openings of the published notices of common licenses.
NOTICES = [
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template(
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied.",
    ),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software "
        "Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("mit", "Released under the MIT License"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the "
        "Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def _hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of folded bytes."""
    raw = np.frombuffer(data + b" ", np.uint8)
    gap = raw == 32
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        edge = np.concatenate([[0], edge])
    return edge[0::2], _powers.spans(_powers.prefix(raw), edge[0::2], edge[1::2])


def word_hashes(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The hashes of the words of each text; up to PIECE bytes are hashed at once, a longer text in parts that end between words."""
    data = [(t or "").encode().translate(_FOLD) for t in texts]
    for a, b in pieces(data):
        if b - a == 1 and len(data[a]) > PIECE:
            found, start = [], 0
            while start < len(data[a]):
                end = data[a].find(b" ", start + PIECE)
                end = len(data[a]) if end < 0 else end
                found.append(_hashes(data[a][start:end])[1])
                start = end
            yield np.concatenate(found)
        else:
            start, h = _hashes(b" ".join(data[a:b]))
            yield from np.split(h, np.searchsorted(start, np.cumsum([len(x) + 1 for x in data[a:b]])[:-1]))


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """The rolling hashes of each ``k`` consecutive words; those of different ``k`` differ."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    turns = mix(np.arange(1, k + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)
    h = np.full(n, k, np.uint64) * GOLDEN
    for i in range(k):
        h += words[i : n + i] * turns[i]
    return mix(h).view(np.int64)


def _rolling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, key, at, grams): rows of up to ROW_GRAMS grams of a text, the first of them at word ``at``."""
    for b in batches:
        row, at, found = [], [], []
        for i, h in enumerate(word_hashes(b.column("text").to_pylist())):
            for k in (SHORT, LONG):
                g = grams(h, k)
                for start in range(0, len(g), ROW_GRAMS):
                    row.append(i)
                    at.append(start)
                    found.append(g[start : start + ROW_GRAMS])
        if row:
            offsets = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found)))
            at_ = pa.array(row)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(at_), b.column("key").take(at_), pa.array(at, pa.int32()), lists], names=["doc_id", "key", "at", "grams"])


class _Plan(NamedTuple):
    label: str
    base: bool
    words: list[bytes]
    k: int
    edits: int
    votes: int


def _plans(templates: Sequence[Template]) -> list[_Plan]:
    """Words, gram length, edit budget and least votes of each template: n - k + 1 grams, of which an edit spoils k at most."""
    out = []
    for t in templates:
        words = words_of(t.text)
        k = SHORT if t.base or len(words) < LONG else LONG
        if len(words) < k:
            raise ValueError(f"a template needs {SHORT} words: {t.text!r}")
        edits = 0 if t.base else int(EDITS * len(words))
        out.append(_Plan(t.label, t.base, words, k, edits, max(1, len(words) - k + 1 - k * edits)))
    return out


def edits_within(template: np.ndarray, text: np.ndarray) -> int:
    """The fewest edits of words that turn the template into some part of the text."""
    at = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, w in enumerate(template, 1):
        step = np.minimum(row + 1, i)
        step[1:] = np.minimum(step[1:], row[:-1] + (text != w))
        row = np.minimum.accumulate(step - at) + at
    return int(row.min())


def candidates(docs: DataFrame, plans: list[_Plan]) -> DataFrame:
    """(doc_id, key, template, low, high): runs of neighbouring diagonals with enough votes. ``docs``: (doc_id, key, text)."""
    spark = docs.sparkSession
    # rows of one id and text vote once, so that repeated rows give what one gives
    rolled = docs.mapInArrow(_rolling, "doc_id long, key string, at int, grams array<long>").select("doc_id", "key", "at", F.posexplode("grams").alias("nth", "gram"))
    places = [(int(g), i, at) for i, p in enumerate(plans) for at, g in enumerate(grams(next(word_hashes([b" ".join(p.words).decode()])), p.k))]
    table = spark.createDataFrame(places, "gram long, template int, place int")
    hits = rolled.join(F.broadcast(table) if len(places) <= MAX_BROADCAST_GRAMS else table, "gram")
    by = ["doc_id", "key", "template"]
    hits = hits.select(*by, (F.col("at") + F.col("nth")).alias("pos"), (F.col("at") + F.col("nth") - F.col("place")).alias("diagonal")).distinct()
    voted = hits.groupBy(*by, "diagonal").agg(F.count("*").alias("votes"))
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("template") + 1)
    along = Window.partitionBy(*by).orderBy("diagonal")
    opens = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > pick([p.edits for p in plans]), F.lit(True))
    runs = voted.withColumn("opens", opens.cast("int")).withColumn("run", F.sum("opens").over(along))
    runs = runs.groupBy(*by, "run").agg(F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.sum("votes").alias("votes"))
    return runs.where(F.col("votes") >= pick([p.votes for p in plans])).drop("run", "votes")


_VERIFIED = {
    "name": pa.string(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(),
}


def _verifier(plans: list[_Plan]):
    def said(text: str, spans: list[dict]) -> tuple | None:
        words = words_of(text)
        starts, base, labels, score = [], set(), set(), 0.0
        for span in spans:
            p, low, high = plans[span["template"]], span["low"], span["high"]
            if p.edits == 0:
                good = float(words[low : low + len(p.words)] == p.words)
            else:
                ids = {w: i for i, w in enumerate(dict.fromkeys(p.words))}
                part = words[max(0, low - p.edits) : high + len(p.words) + p.edits]
                cost = edits_within(np.array([ids[w] for w in p.words]), np.array([ids.get(w, -1) for w in part]))
                good = 1 - cost / len(p.words) if cost <= p.edits else 0.0
            if good:
                score = max(score, good)
                labels.add(p.label)
                if p.base:
                    base.add(p.label)
                    starts.append(low)
        if labels:
            return len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(n, *row) for n, *x in zip(*(b.column(c).to_pylist() for c in ("name", "text", "spans"))) if (row := said(*x))]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), _VERIFIED.values())], names=list(_VERIFIED))

    return verify


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = (*PHRASES, *NOTICES)) -> DataFrame:
    """What each document says of its license, one row for each: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts the places of all base phrases, first_word and last_word are their smallest and largest start, and score is
    the best similarity of a verified template: 1 for phrases, at least 0.8 for notices. Null and empty texts have no
    words and no labels; rows that are repeated get a row each, also without an id; more columns don't matter; an empty table
    gives an empty table. All grams of all texts are joined to the templates; only texts with a candidate, which pass a Bloom filter of
    bounded size, are dealt for verification. The candidates of one text meet in one row.
    """
    plans = _plans(templates)
    bound_batches(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text).alias("key"), text.alias("text"))
    name = F.concat_ws(" ", "doc_id", "key")
    spans = cut(candidates(docs, plans).groupBy("doc_id", "key").agg(F.collect_list(F.struct("template", "low", "high")).alias("spans")).withColumn("name", name))
    blocks = min(MAX_BLOCKS, max(64, spans.count() // 4))
    bloom = F.broadcast(bloom_blocks(spans, "name", blocks))
    mine = docs.withColumns({"name": name, "block": _block(name, blocks)})
    possible = mine.join(bloom, "block").where(F.col("word").bitwiseAND(_mask(F.col("name"))) == _mask(F.col("name"))).select("name", "text")
    schema = "name string, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    found = possible.join(spans.select("name", "spans"), "name").select("name", "text", "spans").mapInArrow(_verifier(plans), schema).dropDuplicates(["name"])
    all_ = docs.select("doc_id", name.alias("name"), F.regexp_count("text", F.lit(_WORD)).cast("long").alias("n_words")).join(found, "name", "left")
    none = lambda c, v: F.coalesce(c, F.lit(v)).alias(c)
    return all_.select(
        "doc_id", "n_words", none("n_base", 0), "first_word", "last_word", none("base_labels", ""), none("labels", ""), none("score", 0.0),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
