"""The pipeline from its first stage on against brute force: groups of near copies, passages, the mix and the shards, on a whole small table."""

import hashlib
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from larkspur.llm import decontam
from larkspur.llm.licenses import edits_within

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


def cells(text):
    w = re.findall(r"[0-9A-Za-z\x80-\U0010FFFF]+", (text or "").lower())
    n = min(5, len(w))
    return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else Counter()


def kept(docs):
    """Documents with the least id of their group: connected by weighted Jaccard similarities of 0.8 or more."""
    bags = {i: cells(r.text) for i, r in docs.items()}
    sums = {i: sum(b.values()) for i, b in bags.items()}
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(docs)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if sums[i] and sums[j] and min(sums[i], sums[j]) >= 0.8 * max(sums[i], sums[j]):
                both = sum((bags[i] & bags[j]).values())
                if both >= 0.8 * (sums[i] + sums[j] - both):
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
    return {i: docs[i] for i in ids if find(i) == i}


def clean(docs, items):
    """Documents without a passage that has up to a tenth of an item's characters as edits."""
    number = lambda x: np.array([ord(c) for c in decontam.normalized(x)])
    items = [x for x in map(number, items) if len(x)]
    return {i: r for i, r in docs.items() if not any(edits_within(x, t) <= int(0.1 * len(x)) for t in [number(r.text)] for x in items)}


def mixed(docs):
    """How often each document is taken: sources share 1.5 times all words by weights of 5, 2 and 1, up to twice their own."""
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for i, r in docs.items()}
    sources = sorted({r.source for r in docs.values()}, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    size = {s: sum(words[i] for i, r in docs.items() if r.source == s) for s in sources}
    target, open_ = {}, set(sources)
    while True:
        left = 1.5 * sum(size.values()) - sum(2 * size[s] for s in sources if s not in open_)
        level = left / max(1, sum(weight[s] for s in open_))
        target = {s: weight[s] * level if s in open_ else 2 * size[s] for s in sources}
        over = {s for s in open_ if target[s] > 2 * size[s]}
        if not over:
            break
        open_ -= over
    out = Counter()
    digest = lambda x: hashlib.md5(x.encode()).hexdigest()
    for s in sources:
        own = sorted((i for i, r in docs.items() if r.source == s), key=lambda i: (digest(str(i)), words[i], digest(docs[i].text or "")))
        epochs, before = int(target[s] // size[s]) if size[s] else 0, 0
        for i in own:
            out[i] = epochs + (words[i] > 0 and before + words[i] / 2 <= target[s] - epochs * size[s])
            before += words[i]
    return +out


def test_pipeline_agrees_with_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    first = {r.doc_id: r for r in corpus_pipeline.STAGES[0][1](spark, docs, DATA).collect()}
    assert 0.9 * docs.count() <= len(first) < docs.count() + 1
    items = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    alone = kept(first)
    rest = clean(alone, items)
    want = mixed(rest)
    rows = corpus_pipeline.run(spark, DATA).collect()
    assert len(first) > len(alone) > len(rest) and Counter(r.doc_id for r in rows) == want
    text = {i: (r.text or "").encode() for i, r in rest.items()}
    assert all(r.size == len(text[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id]) for r in rows)
    shards = {k: sorted(r.slot for r in rows if r.shard == k) for k in range(8)}
    assert all(slots == list(range(len(slots))) for slots in shards.values())
    bytes_ = [sum(r.size for r in rows if r.shard == k) for k in range(8)]
    assert max(bytes_) - min(bytes_) <= 2 * max(r.size * n for r, n in ((r, want[r.doc_id]) for r in rows))
