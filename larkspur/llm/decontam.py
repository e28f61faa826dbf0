"""Benchmark decontamination by the q-gram lemma: diagonal bands with enough shared q-grams, then banded alignment."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import bound_batches, cut

#: Characters of a q-gram at most; short items take fewer, so that the lemma asks for one shared q-gram at least.
Q = 8
#: Edits that a passage may have, as a share of its item's characters.
BUDGET = 0.1
#: Bytes of benchmark text in a block. Each block is one broadcast and one pass over the documents.
BLOCK_BYTES = 4 << 20
#: Blocks that one plan passes the documents through; then they are written.
CHAIN = 8
#: Bits of the table that screens q-grams before the exact look-up.
SCREEN_BITS = 20
#: Pairs of equal q-grams, of a text and of items, that are counted at once.
SLICE = 1 << 20

SPREAD = np.uint64(0x9E3779B97F4A7C15)


def normalized(text: str | None) -> str:
    """Lower case, runs of white space as one blank, none at the ends."""
    return " ".join(text.lower().split()) if text else ""


def codes_of(data: str) -> np.ndarray:
    return np.frombuffer(data.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def grams(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """The q-gram at each position as a number: a polynomial of its characters, put together from parts of 8, 4, 2 and 1."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    part, power, parts = codes, SPREAD, {1: (codes, SPREAD)}
    size = 1
    while 2 * size <= q:
        part = part[:-size] * power + part[size:]
        with np.errstate(over="ignore"):
            power = power * power
        size *= 2
        parts[size] = part, power
    out, at = part[:n], size
    while size > 1:
        size //= 2
        if q & size:
            part, power = parts[size]
            out = out * power + part[at : at + n]
            at += size
    return out


@dataclass
class Item:
    item_id: int
    data: str
    #: Edits allowed.
    edits: int
    #: Shared q-grams that a passage within the edits has at least: m - q + 1 - q * edits.
    least: int
    #: Diagonals of half a band, as a power of two: more than twice the edits, so that two neighbouring halves hold every path.
    shift: int


class Grams:
    """The q-grams of items of one q, with the items and positions of each."""

    def __init__(self, q: int, items: list[Item]):
        self.q, self.items = q, items
        codes = [grams(codes_of(i.data), q) for i in items]
        item = np.repeat(np.arange(len(items)), [len(c) for c in codes])
        at = np.concatenate([np.arange(len(c)) for c in codes])
        code = np.concatenate(codes)
        order = np.argsort(code, kind="stable")
        self.codes, self.first, self.many = np.unique(code[order], return_index=True, return_counts=True)
        self.item, self.at = item[order].astype(np.int32), at[order].astype(np.int32)
        self.shift = np.array([i.shift for i in items], np.int32)[self.item]
        self.longest, self.thinnest = max(len(i.data) for i in items), min(i.shift for i in items)
        self.least = np.array([i.least for i in items], np.int64)
        self.screen = np.zeros(1 << SCREEN_BITS, bool)
        self.screen[(self.codes * SPREAD) >> np.uint64(64 - SCREEN_BITS)] = True

    def bands(self, codes: np.ndarray) -> Iterator[tuple[Item, int]]:
        """(item, half band) whose q-grams, with the next half's, are enough."""
        code = grams(codes, self.q)
        if not len(code):
            return
        at = np.flatnonzero(self.screen[(code * SPREAD) >> np.uint64(64 - SCREEN_BITS)])
        found = np.minimum(np.searchsorted(self.codes, code[at]), len(self.codes) - 1)
        same = self.codes[found] == code[at]
        at, found = at[same].astype(np.int32), found[same]
        many = self.many[found]
        end = np.cumsum(many)
        if not len(end):
            return
        # diagonals from 1 up: the lowest one is minus the longest item
        low = (self.longest >> self.thinnest) + 2
        stride = low + (len(codes) >> self.thinnest) + 2
        total, cells = int(end[-1]), stride * len(self.items)
        few = cells <= 16 * min(total, SLICE) + 4096
        count, keys, sums = np.zeros(cells + 1, np.int64) if few else None, np.zeros(0, np.int64), np.zeros(0, np.int64)
        i = 0
        while i < len(at):
            j = max(i + 1, int(np.searchsorted(end, (end[i - 1] if i else 0) + SLICE, side="right")))
            n = many[i:j]
            post = np.repeat(self.first[found[i:j]] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            half = (np.repeat(at[i:j], n) - self.at[post]) >> self.shift[post]
            key = self.item[post].astype(np.int64) * stride + (half + low)
            if few:
                count += np.bincount(key, minlength=cells + 1)
            else:
                key, n = np.unique(key, return_counts=True)
                if len(keys):
                    key, where = np.unique(np.concatenate([keys, key]), return_inverse=True)
                    n = np.bincount(where, np.concatenate([sums, n])).astype(np.int64)
                keys, sums = key, n
            i = j
        if few:
            both = count[:-1] + count[1:]
            hit = np.flatnonzero(both.reshape(-1, stride) >= self.least[:, None])
        else:
            before = keys - 1
            alone = np.concatenate([[True], before[1:] != keys[:-1]])
            starts = np.sort(np.concatenate([keys, before[alone]]), kind="stable")
            own = lambda k: np.where(keys[p := np.minimum(np.searchsorted(keys, k), len(keys) - 1)] == k, sums[p], 0)
            hit = starts[own(starts) + own(starts + 1) >= self.least[np.maximum(starts, 0) // stride]]
        for k in hit:
            yield self.items[int(k // stride)], int(k % stride) - low


class Index:
    """The items of a block of the benchmark, by the q of their q-grams."""

    def __init__(self, rows: list[tuple[int, str]], budget: float = BUDGET):
        self.short: list[tuple[int, str]] = []
        by_q: dict[int, list[Item]] = {}
        for item_id, text in rows:
            data = normalized(text)
            m = len(data)
            edits = int(budget * m)
            if m < Q and not edits:
                if m:
                    self.short.append((item_id, data))
                continue
            q = max(1, min(Q, m // (edits + 1)))
            by_q.setdefault(q, []).append(Item(item_id, data, edits, m - q + 1 - q * edits, (2 * edits).bit_length()))
        self.grams = [Grams(q, items) for q, items in sorted(by_q.items(), reverse=True)]

    def leaks(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """The best passage for each item that has one: (item_id, start, end, edits), in characters of the normalized text."""
        data = normalized(text)
        codes = codes_of(data)
        found = []
        for g in self.grams:
            # the best of each item's text, whatever other texts its id has
            best: dict[int, tuple[int, int, int]] = {}
            for item, half in g.bands(codes):
                if best.get(id(item), (1,))[0] == 0:
                    continue
                low, high = half << item.shift, ((half + 2) << item.shift) - 1
                if hit := align(item.data, data, low, high, item.edits):
                    if id(item) not in best:
                        found.append((item.item_id, id(item), best))
                    best[id(item)] = min(hit, best.get(id(item), hit))
        passages = [(item_id, s, e, d) for item_id, k, best in found for d, s, e in [best[k]]]
        for item_id, part in self.short:
            if (s := data.find(part)) >= 0:
                passages.append((item_id, s, s + len(part), 0))
        return best_of(passages)


def best_of(passages: Iterable[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """One passage (item_id, start, end, edits) for each item_id, in the order of the ids: the fewest edits, then the first place."""
    best: dict[int, tuple[int, int, int, int]] = {}
    for x in passages:
        if x[0] not in best or (x[3], *x[1:3]) < (best[x[0]][3], *best[x[0]][1:3]):
            best[x[0]] = x
    return [best[k] for k in sorted(best)]


def _rows(item: np.ndarray, text: np.ndarray, low: int, high: int, ends: bool, edits: int) -> tuple[np.ndarray, int]:
    """Last row of the alignment of ``item`` with ``text`` along the diagonals low to high.

    The start is free if ``ends`` is false; else the path starts at position 0 of the text. The least number of a row never
    falls, so the alignment ends early when it is beyond ``edits``.
    """
    m, width = len(item), high - low + 1
    pad = np.full(m + width + abs(low) + 1, -1, np.int32)
    padded = np.concatenate([pad, text, pad])
    base = len(pad) + low
    step = np.arange(width)
    row = np.abs(step + low) if ends else np.zeros(width, np.int64)
    for i in range(m):
        new = row + (padded[base + i : base + i + width] != item[i])
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        row = np.minimum.accumulate(new - step) + step
        if i % 4 == 3 and row.min() > edits:
            break
    return row, low


def align(item: str, data: str, low: int, high: int, edits: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best passage whose path keeps to the diagonals, or None beyond ``edits``."""
    a, b = max(0, low), min(len(data), high + len(item) + edits)
    s = data.find(item, a, b)
    if s >= 0:
        return 0, s, s + len(item)
    if edits == 0:
        return None
    x, y = codes_of(item).astype(np.int32), codes_of(data[a:b]).astype(np.int32)
    row, first = _rows(x, y, low - a, high - a, False, edits)
    where = np.arange(len(row)) + first + len(x)
    row = np.where((where >= 0) & (where <= len(y)), row, 1 << 30)
    k = int(row.argmin())
    if row[k] > edits:
        return None
    end = int(where[k])
    back, _ = _rows(x[::-1], y[:end][::-1], -edits, edits, True, edits)
    length = len(x) + int(back.argmin()) - edits
    return int(row[k]), a + max(0, end - length), a + end


LEAK = ("item_id", "start", "end", "edits")
LEAKS = "array<struct<item_id:bigint,start:int,end:int,edits:int>>"


def find_leaks(docs: DataFrame, benchmark: DataFrame, budget: float = BUDGET, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Adds ``leaks`` to ``docs``: the best passage for each benchmark item that the text holds within its edit budget.

    ``benchmark``: (item_id, text). Texts are compared in lower case with white space collapsed, character by character;
    a passage may have ``budget`` of an item's characters as edits, rounded down. Empty or null items and items with a null
    id match nothing; of an id with several texts the best passage of any counts, whatever blocks they are in. A null or empty text has an empty array. Rows are kept as they are, repeated ones included; a column
    ``leaks`` is replaced. The benchmark comes in blocks of about ``block_bytes``, each broadcast once and held against all
    documents; after CHAIN blocks the documents are written. Equal q-grams are counted in slices, so that a repetitive text
    and a repetitive item take bounded memory.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    out = docs.drop("leaks").withColumn("leaks", F.array().cast(LEAKS))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        index = spark.sparkContext.broadcast(Index([tuple(r) for r in rows], budget))

        def scan(batches: Iterator[pd.DataFrame], index=index) -> Iterator[pd.DataFrame]:
            for b in batches:
                found = [index.value.leaks(x) for x in b["text"]]
                held = [[tuple(x[c] for c in LEAK) for x in a] for a in b["leaks"]]
                b["leaks"] = [[dict(zip(LEAK, x)) for x in best_of([*a, *c])] for a, c in zip(held, found)]
                yield b

        out = out.mapInPandas(scan, schema)
        if k % CHAIN == CHAIN - 1 and k + 1 < blocks:
            out = cut(out)
    return out


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
