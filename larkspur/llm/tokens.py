"""Token counts by a compiled transducer over bytes.

A byte-pair vocabulary is compiled into one deterministic automaton: its states are the prefixes of tokens, a transition reads
one byte (or the last byte of a word, a letter of its own), and a state knows the tokens that end in it, the longest first.
The encoding of a string is the only sequence of tokens of which each neighbouring pair is what the merges leave of the two
together. So the last token of each prefix follows from the last tokens before it: a transition accepts the one token that
ends there and agrees with the token in front of it, and is annotated with the number of tokens emitted so far. A word takes
time in proportion to its bytes, however long it is; the counts of words that were met are kept as arcs of whole words.

A chunk of a text maps the open word before it to the open word behind it: (head, tokens between, tail). These maps compose
associatively, so that long texts are read chunk by chunk in parallel and put together by a scan over blocks of maps.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a chunk. Longer texts are dealt out in chunks.
CHUNK = 1 << 16
#: Arcs, and pairs of tokens, kept at once; beyond that they are worked out anew. Longer words are not kept.
MAX_ARCS, LONGEST_ARC = 1_000_000, 64
#: Maps of a long text that are composed in one group of the first step of the scan.
SCAN = 64

SPACE = regex.compile(r"\p{White_Space}+")


def byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Transducer(dict):
    """Arcs: word -> number of tokens. Built from a tokenizer file with word-end BPE over byte letters."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path = path
        letters, end = byte_letters(), spec["model"]["end_of_word_suffix"]
        # a symbol is a byte, or 256 more where it ends a word
        symbol = {c: i for i, c in enumerate(letters)} | {c + end: 256 + i for i, c in enumerate(letters)}
        self.token: list[tuple[int, ...]] = []
        number: dict[tuple[int, ...], int] = {}

        def known(text: str) -> int:
            ends = text.endswith(end)
            body = text[: -len(end)] if ends else text
            key = tuple(symbol[c] for c in body[:-1]) + (symbol[body[-1] + end * ends],)
            if key not in number:
                number[key] = len(self.token)
                self.token.append(key)
            return number[key]

        self.single = [known(c) for c in letters] + [known(c + end) for c in letters]
        self.ranks = {(known(a), known(b)): (i, known(a + b)) for i, (a, b) in enumerate(spec["model"]["merges"])}
        self._compile()
        self.agree: dict[tuple[int, int], bool] = {}
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split.replace(r"\s", r"\p{White_Space}")).findall
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.marks = tuple({s[:2] for s in special})

    def _compile(self) -> None:
        """step: state and symbol -> state; longest: state -> the longest token that ends in it; shorter: token -> the next one."""
        self.step, ends, depth = {}, [-1], [()]
        for k, token in enumerate(self.token):
            state = 0
            for i, x in enumerate(token):
                state = self.step.setdefault(state << 9 | x, len(ends))
                if state == len(ends):
                    ends.append(-1)
                    depth.append(token[: i + 1])
            ends[state] = k
        self.fail, self.longest, self.shorter = [0] * len(ends), list(ends), [-1] * len(self.token)
        for state in sorted(range(1, len(ends)), key=lambda q: len(depth[q])):
            x = depth[state]
            if len(x) > 1:
                up = self.fail[self._parent(x)]
                while up and (up << 9 | x[-1]) not in self.step:
                    up = self.fail[up]
                self.fail[state] = self.step.get(up << 9 | x[-1], 0)
            below = self.longest[self.fail[state]]
            if ends[state] < 0:
                self.longest[state] = below
            else:
                self.shorter[ends[state]] = below

    def _parent(self, x: tuple[int, ...]) -> int:
        state = 0
        for y in x[:-1]:
            state = self.step[state << 9 | y]
        return state

    def _merged(self, symbols: tuple[int, ...]) -> list[int]:
        """The tokens that the merges leave of a short string, by definition: the pair of least rank first."""
        parts = [self.single[x] for x in symbols]
        while len(parts) > 1:
            best = min((self.ranks[p] + p for p in zip(parts, parts[1:]) if p in self.ranks), default=None)
            if best is None:
                break
            _, whole, a, b = best
            joined, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and parts[i] == a and parts[i + 1] == b:
                    joined.append(whole)
                    i += 2
                else:
                    joined.append(parts[i])
                    i += 1
            parts = joined
        return parts

    def _agrees(self, before: int, token: int) -> bool:
        """Whether two neighbouring tokens are what the merges leave of them; -1 is the start of a word."""
        key = (before, token)
        if key not in self.agree:
            if len(self.agree) >= MAX_ARCS:
                self.agree.clear()
            own = [token] if before < 0 else [before, token]
            self.agree[key] = self._merged(sum((self.token[k] for k in own), ())) == own
        return self.agree[key]

    def run(self, symbols: list[int]) -> int:
        """Tokens of a string of symbols. Only the last tokens within the longest open prefix are looked up again."""
        step, fail, longest, shorter, token, agrees = self.step, self.fail, self.longest, self.shorter, self.token, self._agrees
        last, emitted, state = [-1] * len(symbols), [0] * (len(symbols) + 1), 0
        for i, x in enumerate(symbols):
            while (state << 9 | x) not in step:
                state = fail[state]
            state = step[state << 9 | x]
            k = longest[state]
            while True:
                at = i + 1 - len(token[k])
                if agrees(last[at - 1] if at else -1, k):
                    break
                k = shorter[k]
            last[i], emitted[i + 1] = k, emitted[at] + 1
        return emitted[-1]

    def __missing__(self, word: str) -> int:
        symbols = list(word.encode("utf-8"))
        symbols[-1] += 256
        n = self.run(symbols)
        if len(word) <= LONGEST_ARC:
            if len(self) >= MAX_ARCS:
                self.clear()
            self[word] = n
        return n

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return sum(map(self.__getitem__, self.words(text.lower())))

    def count(self, text: str) -> int:
        """Tokens of a whole text; special strings are one token each."""
        if self.special is None or not any(m in text for m in self.marks):
            return self.plain(text)
        pieces = self.special.split(text)
        return len(pieces) - 1 + sum(map(self.plain, pieces))

    def chunk(self, text: str) -> tuple[str, int | None, str]:
        """The map of a chunk: the text up to its first white space, the tokens between, the text behind its last.

        Without white space all of it is open: (text, None, '').
        """
        first = SPACE.search(text)
        if first is None:
            return text, None, ""
        last = len(text)
        while not SPACE.match(text, last - 1):
            last -= 1
        return text[: first.start()], self.count(text[first.start() : last]), text[last:]

    def pair(self, a: tuple[str, int | None, str], b: tuple[str, int | None, str]) -> tuple[str, int | None, str]:
        """The map of two neighbouring chunks; associative."""
        if a[1] is None:
            return a[0] + b[0], b[1], b[2]
        if b[1] is None:
            return a[0], a[1], a[2] + b[0]
        return a[0], a[1] + self.count(a[2] + b[0]) + b[1], b[2]

    def compose(self, maps: list[tuple[str, int | None, str]]) -> tuple[str, int | None, str]:
        """The map of neighbouring chunks, composed two and two."""
        while len(maps) > 1:
            maps = [self.pair(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]

    def closed(self, m: tuple[str, int | None, str]) -> int:
        """Tokens of a text from its map."""
        return self.count(m[0]) + (0 if m[1] is None else m[1] + self.count(m[2]))


_loaded: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """The transducer of a file, once for each Python worker."""
    if path not in _loaded:
        _loaded[path] = Transducer(path)
    return _loaded[path]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """Tokens of each whole text: doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens).

    ``tokenizer``: the path of a word-end BPE file, the same on every machine. A null text counts as the empty one
    (0 tokens); repeated rows and null ids give a row each; other columns are ignored; an empty table gives an empty table.
    Texts of up to CHUNK characters are counted where they are read; of longer ones only the chunk maps are shuffled, and
    composed SCAN at a time and then all. Ids that aren't integers must be cast to long by the caller.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = transducer(tokenizer)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_bytes": b["n_bytes"], "n_tokens": [t.count(x) for x in b["text"]]})

    def maps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = transducer(tokenizer)
        for b in batches:
            head, between, tail = zip(*map(t.chunk, b["text"])) if len(b) else ((), (), ())
            yield b.drop(columns="text").assign(head=head, between=pd.array(between, "Int64"), tail=tail)

    def composed(last: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            t = transducer(tokenizer)
            for b in batches:
                found = [t.compose([(m["head"], None if pd.isna(m["between"]) else int(m["between"]), m["tail"]) for m in x]) for x in b["maps"]]
                if last:
                    yield pd.DataFrame({"doc_id": b["doc_id"], "n_bytes": b["n_bytes"], "n_tokens": list(map(t.closed, found))})
                else:
                    head, between, tail = zip(*found) if len(b) else ((), (), ())
                    yield b.drop(columns="maps").assign(head=head, between=pd.array(between, "Int64"), tail=tail)

        return run

    schema = "doc_id long, n_bytes long, n_tokens long"
    short = rows.where(F.length("text") <= CHUNK).mapInPandas(whole, schema)
    at = F.explode(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / CHUNK).cast("int")))
    chunks = (
        rows.where(F.length("text") > CHUNK)
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("at", at)
        .select("row", "at", "doc_id", "n_bytes", F.substring("text", F.col("at") * CHUNK + 1, F.lit(CHUNK)).alias("text"))
    )
    kept = "row long, at int, doc_id long, n_bytes long, head string, between long, tail string"
    in_order = F.array_sort(F.collect_list(F.struct("at", "head", "between", "tail"))).alias("maps")
    blocks = (
        chunks.mapInPandas(maps, kept).groupBy("row", "doc_id", "n_bytes", F.floor(F.col("at") / SCAN).cast("int").alias("block")).agg(in_order)
        .withColumnRenamed("block", "at").mapInPandas(composed(False), kept)
    )
    long = blocks.groupBy("row", "doc_id", "n_bytes").agg(in_order).mapInPandas(composed(True), schema)
    return short.unionByName(long).withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
