"""Removal of long repeated strings with a difference cover of the positions.

Any two positions of any two texts can be moved by the same number of bytes, less than PERIOD, to positions whose
remainders both lie in the cover. So of two equal strings of ``length`` bytes a sampled block of ``length - PERIOD + 1``
bytes is equal at sampled positions. The sampled blocks are sorted and named; the names that occur once go; of the
remaining suffixes, those that have a repeated block in reach, the prefixes of the whole length are named and sorted in
turn, and equal neighbours are the repeated strings. Names are sorted within ranges of their hashes.

The same steps over words in place of bytes find the repeated passages, with a smaller cover.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import Powers, cut
from larkspur.llm.shingles import pieces

#: Bytes of a repeated string.
LENGTH = 400
#: Order of the difference cover: ORDER + 1 of ORDER**2 + ORDER + 1 remainders, each difference once.
ORDER = 11
PERIOD = ORDER * ORDER + ORDER + 1
#: Words of a repeated passage, and the order of its cover: 6 of 31 remainders.
PASSAGE, WORD_ORDER = 51, 5
#: Bytes of text whose positions are named together.
PIECE = 384 << 10
#: Bytes of names in a range of hashes, and ranges at least.
RANGE_BYTES, RANGES = 5 << 20, 64
#: 64-bit words of the Bloom filter that keeps texts without repeated blocks out of the second shuffle, 16 bytes each: one for
#: every four of them, between these bounds. Beyond the upper one (16 MB) it lets more texts pass, none is lost.
BLOOM_WORDS, MAX_BLOOM_WORDS = 1 << 17, 1 << 20

_ONE, _TWO = Powers(0x9E3779B97F4A7C15), Powers(0xD1342543DE82EF95)

PARTS = "batch string, part int, kind int, names binary, at binary, info binary"
SPANS = "array<struct<start:bigint,end:bigint>>"


def difference_cover(p: int = ORDER) -> np.ndarray:
    """A perfect difference set modulo p*p + p + 1 for a prime p: the powers of a primitive element of the cubic field
    that lie in a plane. The first cubic x**3 = a*x*x + b*x + c that gives one is taken."""
    v = p * p + p + 1
    for a in range(p):
        for b in range(p):
            for c in range(1, p):
                x, out = (1, 0, 0), []
                for i in range(v):
                    if x[2] == 0:
                        out.append(i)
                    x = (x[2] * c % p, (x[0] + x[2] * b) % p, (x[1] + x[2] * a) % p)
                if len(out) == p + 1 and len({(s - t) % v for s in out for t in out}) == v:
                    return np.array(out)
    raise ValueError("p must be prime")


#: What stands between words, as spaces.
_SPACES = bytes.maketrans(b"\t\n\v\f\r", b"     ")


def _spaced(x: bytes) -> bytes:
    """The words of a text with one space between them."""
    x = x.translate(_SPACES)
    while b"  " in x:
        x = x.replace(b"  ", b" ")
    return x.strip(b" ")


class Piece:
    """Texts that are named together: one buffer with the start and end of each text."""

    #: Bytes for each unit, about; bytes of text that are named together; texts in a batch.
    factor, piece, rows = 1, PIECE, 256

    def __init__(self, texts: list[bytes]):
        self.size = np.array([len(x) for x in texts], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.raw = np.frombuffer(b"".join(texts), np.uint8)

    def edges(self, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        return at, at + length

    def names(self, at: np.ndarray, length: int, wide: bool) -> np.ndarray:
        """Names of the blocks at positions: 64 bits, or 96 bits as (64, 32)."""
        kind = np.dtype([("a", "<u8"), ("b", "<u4")]) if wide else np.dtype([("a", "<u8")])
        out = np.empty(len(at), kind)
        start, end = self.edges(at, length)
        out["a"] = _ONE.spans(_ONE.prefix(self.raw), start, end)
        if wide:
            out["b"] = _TWO.spans(_TWO.prefix(self.raw), start, end) >> np.uint64(32)
        return out


class Words(Piece):
    """The same with words as units; strings of words are named by their bytes with one space between words."""

    factor, piece, rows = 5, 1 << 20, 512

    def __init__(self, texts: list[bytes]):
        texts = [_spaced(x) for x in texts]
        self.size = np.array([x.count(b" ") + 1 if x else 0 for x in texts], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.raw = np.frombuffer(b" ".join([b"", *filter(None, texts), b""]), np.uint8)
        self.space = np.flatnonzero(self.raw == 32)

    def edges(self, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        return self.space[at] + 1, self.space[at + length]


def _runs(names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorting order, start of each run of equal names, length of each run)."""
    order = np.lexsort((names["b"], names["a"])) if "b" in names.dtype.names else np.argsort(names["a"], kind="stable")
    s = names[order]
    new = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
    return order, new, np.diff(np.concatenate([new, [len(s)]]))


def _dealt(batch: str, names: np.ndarray, at: np.ndarray, info: bytes, ranges: int, home: int) -> Iterator[tuple]:
    """Rows of one piece: for each range the names that occur once (with positions) and those that occur more often (once,
    without), and one row of kind 1 with ``info``, to which the positions known to be repeated are added."""
    order, new, many = _runs(names)
    lone = order[new[many == 1]]
    more = order[new[many > 1]]
    repeated = np.sort(at[order[np.repeat(many > 1, many)]]) if len(new) else np.zeros(0, np.int64)
    lone = lone[np.argsort(at[lone])]
    to_lone, to_more = ((names["a"][x] >> np.uint64(33)) % np.uint64(ranges) for x in (lone, more))
    lone, more = lone[np.argsort(to_lone, kind="stable")], more[np.argsort(to_more, kind="stable")]
    cut_lone, cut_more = (np.concatenate([[0], np.cumsum(np.bincount(t.astype(np.int64), minlength=ranges))]) for t in (to_lone, to_more))
    for r in range(ranges):
        a, b = lone[cut_lone[r] : cut_lone[r + 1]], more[cut_more[r] : cut_more[r + 1]]
        if len(a) or len(b):
            yield batch, r, 0, names[np.concatenate([a, b])].tobytes(), _pack(at[a]), None
    yield batch, home, 1, None, _pack(repeated), info


def _pack(at: np.ndarray) -> bytes:
    """Rising positions as steps, byte by byte apart so that the high bytes compress."""
    return np.diff(at, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(x: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64))


def _frames(rows: Iterator[tuple], most: int = 64) -> Iterator[pd.DataFrame]:
    while part := list(itertools.islice(rows, most)):
        yield pd.DataFrame(part, columns=["batch", "part", "kind", "names", "at", "info"])


def _matched(wide: bool):
    """Within a range of names: positions whose name occurs again go back to their batch; other rows pass."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        own = rows[rows["kind"] == 0]
        kind = np.dtype([("a", "<u8"), ("b", "<u4")]) if wide else np.dtype([("a", "<u8")])
        out = [rows.loc[rows["kind"] == 1, ["batch", "at", "info"]]]
        if len(own):
            parts = [np.frombuffer(x, kind) for x in own["names"]]
            order, new, many = _runs(np.concatenate(parts))
            again = np.zeros(len(order), bool)
            again[order[np.repeat(many > 1, many)]] = True
            ends = np.cumsum([len(x) for x in parts])
            found = []
            for x, a, b in zip(own["at"], ends - [len(x) for x in parts], ends):
                at = _unpack(x)
                found.append(_pack(at[again[a : a + len(at)]]))
            out.append(pd.DataFrame({"batch": own["batch"], "at": found, "info": None}))
        return pd.concat(out)[["batch", "at", "info"]]

    return run


def _gathered(rows: pd.DataFrame) -> tuple[bytes, np.ndarray]:
    """(info of a batch, all its repeated positions, sorted)."""
    info = next(x for x in rows["info"] if x is not None)
    return info, np.unique(np.concatenate([_unpack(x) for x in rows["at"]]))


def _batch_name(seen: int) -> str:
    c = TaskContext.get()
    return f"{c.partitionId() if c else 0}-{seen}"


def _sampled(length: int, ranges: int, cover: np.ndarray, period: int, unit: type[Piece]):
    block = length - period + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = 0
        for b in batches:
            texts = [x.encode() for x in b.pop("text")]
            keys = b["key"].tolist()
            for i, j in pieces(texts, unit.piece):
                p = unit(texts[i:j])
                at = [s + (o := (np.arange(0, n, period)[:, None] + cover).ravel())[o <= n - block] for s, n in zip(p.start, p.size) if n >= length]
                at = np.concatenate(at) if at else np.zeros(0, np.int64)
                info = p.size.astype("<u4").tobytes() + b"".join(bytes(k) for k in keys[i:j])
                rows = _dealt(_batch_name(seen), p.names(at, block, False), at, info, ranges, seen % ranges)
                seen += 1
                yield from _frames(rows)

    return run


def _candidates(rows: pd.DataFrame) -> pd.DataFrame:
    """For each text with repeated blocks: (key, positions of the blocks in the text)."""
    info, at = _gathered(rows)
    n = len(info) // 20
    size = np.frombuffer(info[: 4 * n], "<u4").astype(np.int64)
    start = np.cumsum(size) - size
    keys = [info[4 * n + 16 * i : 4 * n + 16 * (i + 1)] for i in range(n)]
    edge = np.searchsorted(at, np.concatenate([start, [size.sum()]]))
    have = [i for i in range(n) if edge[i] < edge[i + 1]]
    return pd.DataFrame({"key": [keys[i] for i in have], "blocks": [_pack(at[edge[i] : edge[i + 1]] - start[i]) for i in have]})


def _reach(blocks: np.ndarray, n: int, length: int, period: int) -> np.ndarray:
    """Positions from which a string of the whole length reaches a block within a period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.maximum(blocks - period + 1, 0), 1)
    np.add.at(edge, blocks + 1, -1)
    x = np.flatnonzero(np.cumsum(edge[:n]) > 0)
    return x[x <= n - length]


def _whole(length: int, ranges: int, period: int, unit: type[Piece]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = 0
        for b in batches:
            texts = [x.encode() for x in b["text"]]
            keys, blocks, copies = b["key"].tolist(), b["blocks"].tolist(), b["copies"].to_numpy()
            for i, j in pieces(texts, unit.piece):
                p = unit(texts[i:j])
                at = [s + _reach(_unpack(k), n, length, period) for s, n, k in zip(p.start, p.size, blocks[i:j])]
                at = np.concatenate(at) if at else np.zeros(0, np.int64)
                # a text that has copies is repeated as a whole: its positions are told to others, not asked for
                known = (copies[i:j] > 1)[np.searchsorted(p.start, at, side="right") - 1] if len(at) else np.zeros(0, bool)
                names = p.names(at, length, True)
                info = p.size.astype("<u4").tobytes() + (copies[i:j] > 1).tobytes() + b"".join(bytes(k) for k in keys[i:j])
                twice = np.concatenate([np.arange(len(at)), np.flatnonzero(known)])
                rows = _dealt(_batch_name(seen), names[twice], at[twice], info, ranges, seen % ranges)
                seen += 1
                yield from _frames(rows)

    return run


def _removed(length: int):
    """For each text with repeated strings: (key, starts and ends of its maximal runs of units that they cover)."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        info, at = _gathered(rows)
        n = len(info) // 21
        size = np.frombuffer(info[: 4 * n], "<u4").astype(np.int64)
        copied = np.frombuffer(info[4 * n : 5 * n], bool)
        keys = [info[5 * n + 16 * i : 5 * n + 16 * (i + 1)] for i in range(n)]
        edge = np.zeros(size.sum() + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + length, -1)
        gone = np.cumsum(edge[:-1]) > 0
        out = []
        for i, (s, m) in enumerate(zip(np.cumsum(size) - size, size)):
            g = np.ones(m, bool) if copied[i] and m >= length else gone[s : s + m]
            turns = np.diff(g.astype(np.int8), prepend=0, append=0)
            out.append((keys[i], np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)))
        return pd.DataFrame(out, columns=["key", "starts", "ends"])

    return run


def _key():
    return F.unhex(F.md5("text")).alias("key")


def _kept(text, spans):
    """The bytes of a text outside of its spans."""
    n = F.octet_length(text).cast("long")
    gap = lambda a, b: F.struct(a.alias("start"), b.alias("end"))
    gaps = F.zip_with(F.concat(F.array(F.lit(0).cast("long")), spans["end"]), F.concat(spans["start"], F.array(n)), gap)
    piece = lambda raw: lambda g: F.hex(F.substring(raw, (g["start"] + 1).cast("int"), (g["end"] - g["start"]).cast("int")))
    # the bytes are taken from the text once, not for each gap
    cut_out = F.transform(F.array(text.cast("binary")), lambda raw: F.unhex(F.array_join(F.transform(gaps, piece(raw)), "")))[0]
    return F.when(F.size(spans) > 0, cut_out).otherwise(text.cast("binary"))


def _found(base: DataFrame, total: int, length: int, order: int, unit: type[Piece]) -> DataFrame:
    """For each different text of ``total`` bytes in all: (key, its maximal runs that repeated strings of ``length`` units cover)."""
    cover = difference_cover(order)
    period = order * order + order + 1
    first = max(RANGES, math.ceil(total / unit.factor * len(cover) / period * 10 / RANGE_BYTES))
    second = max(RANGES, math.ceil(total / unit.factor * 0.15 * 14 / RANGE_BYTES))
    back = "batch string, at binary, info binary"

    blocks = (
        base.select("text", _key()).mapInPandas(_sampled(length, first, cover, period, unit), PARTS)
        .groupBy("part").applyInPandas(_matched(False), back)
        .groupBy("batch").applyInPandas(_candidates, "key binary, blocks binary")
        .groupBy("key").agg(F.any_value("blocks").alias("blocks"))
    )
    blocks = cut(blocks, unit.rows)

    slot = F.shiftrightunsigned(F.xxhash64("key"), 6)
    word, bit = F.pmod(slot, F.lit(min(MAX_BLOOM_WORDS, max(BLOOM_WORDS, blocks.count() // 4)))).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.xxhash64("key").bitwiseAND(F.lit(63)).cast("int"))
    bloom = blocks.select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    texts = base.select("text", _key()).withColumn("word", word).join(F.broadcast(bloom), "word").where(F.col("bits").bitwiseAND(bit) != 0)
    texts = texts.groupBy("key").agg(F.any_value("text").alias("text"), F.count("*").alias("copies")).join(blocks, "key")
    found = (
        texts.select("key", "text", "blocks", "copies").mapInPandas(_whole(length, second, period, unit), PARTS)
        .groupBy("part").applyInPandas(_matched(True), back)
        .groupBy("batch").applyInPandas(_removed(length), "key binary, starts array<long>, ends array<long>")
        .where("size(starts) > 0").select("key", F.arrays_zip("starts", "ends").cast(SPANS).alias("spans"))
    )
    return cut(found, unit.rows)


def remove_repeated(docs: DataFrame, length: int = LENGTH, passage: int | None = None) -> DataFrame:
    """Each text without its repeated strings: doc_id, text, spans and kept.

    A byte goes if a string of ``length`` bytes that covers it also starts at another position of any text, the same one
    included. ``spans`` holds the maximal runs of bytes that go, rising, as (start, end) in the UTF-8 bytes of the text; ``kept``
    is the bytes that stay, which may cut a character. Texts are UTF-8 bytes, null texts are empty, strings don't cross texts
    and are judged on the input. Equal texts are worked on once and copied; repeated rows are texts of their own; other columns
    are ignored; an empty table gives an empty table. ``length`` must be at least PERIOD + 7. ``docs`` must give the same rows on
    each reading.

    With ``passage``, at least 38, the column ``passages`` tells what is left in but repeats by words (runs of bytes other than
    ASCII white space): the maximal runs of words, from 0, that a string of so many words covers which also starts elsewhere.

    Each batch sends a name once, so that a string in a third of all texts costs a range one name for each batch.
    """
    if length < PERIOD + 7:
        raise ValueError(f"length must be at least {PERIOD + 7}")
    if passage is not None and passage < (least := WORD_ORDER * WORD_ORDER + WORD_ORDER + 8):
        raise ValueError(f"passage must be at least {least}")
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    total = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    none = F.array().cast(SPANS)
    columns = ["doc_id", "text", F.coalesce("spans", none).alias("spans")]
    rows = base.withColumn("key", _key()).join(_found(base, total, length, ORDER, Piece), "key", "left")
    if passage is not None:
        rows = rows.join(_found(base, total, passage, WORD_ORDER, Words).withColumnRenamed("spans", "passages"), "key", "left")
        columns.append(F.coalesce("passages", none).alias("passages"))
    rows = rows.select(*columns)
    return rows.select("doc_id", "text", "spans", _kept(F.col("text"), F.col("spans")).alias("kept"), *rows.columns[3:])


def digests(removed: DataFrame) -> DataFrame:
    """What ``remove_repeated`` has done to each text: doc_id, n_bytes, n_removed, n_spans, kept_sha256, then spans and kept_text.

    In ``kept_text`` characters that lost some of their bytes are U+FFFD; kept_sha256 is of the bytes themselves. With passages
    there are also ``passages`` and ``n_passage_words``, the number of words in them.
    """
    n = F.octet_length("text").cast("long")
    words = F.aggregate("passages", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"]) if "passages" in removed.columns else None
    return removed.select(
        "doc_id", n.alias("n_bytes"), (n - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        "spans", F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"),
        *([] if words is None else ["passages", words.alias("n_passage_words")]),
    )


def repeated_strings(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The figures alone."""
    return digests(remove_repeated(docs, length)).drop("spans", "kept_text")


def query(spark, sf_dir: str) -> DataFrame:
    return digests(remove_repeated(spark.read.parquet(f"{sf_dir}/documents.parquet"), passage=PASSAGE))
