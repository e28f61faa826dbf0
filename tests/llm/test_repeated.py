"""What op10 gives of its texts: the runs that go and the bytes that stay, against passages planted in texts and against brute force."""

import hashlib
import random
import re

import pytest

from larkspur.llm import suffixes

SCHEMA = "doc_id long, text string, spans string, kept string, key string"


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklm", k=rng.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def planted():
    """(texts by id, passages of over 400 bytes, passages of over 50 words below that, ids of clean texts)"""
    rng = random.Random(31)
    long, short = [words(rng, 90) for _ in range(8)], [" ".join("".join(rng.choices("nopqrstu", k=5)) for _ in range(60)) for _ in range(4)]
    assert min(map(len, long)) > 400 > max(map(len, short))
    texts = {i: words(rng, rng.randint(1, 300)) for i in range(60)}
    for i in range(40):
        texts[100 + i] = f"{words(rng, 40)} {(long + short)[i % 12]} {words(rng, 40)}"
    wide = "é" + "ñ" * 300
    texts |= {200: "a" + wide, 201: "b" + wide[1:] + "ü", 202: None, 203: "", 204: texts[3], 205: "xy" * 900}
    return texts, long, short, [i for i in range(60) if i != 3]


def runs(texts):
    """Brute force: maximal runs of bytes that a repeated string of 400 bytes covers."""
    seen, raw = {}, {i: (t or "").encode() for i, t in texts.items()}
    for x in raw.values():
        for p in range(len(x) - 399):
            seen[x[p : p + 400]] = seen.get(x[p : p + 400], 0) + 1
    out = {}
    for i, x in raw.items():
        out[i] = []
        for p in range(len(x) - 399):
            if seen[x[p : p + 400]] > 1:
                if out[i] and p <= out[i][-1][1]:
                    out[i][-1] = (out[i][-1][0], p + 400)
                else:
                    out[i].append((p, p + 400))
    return raw, out


def without(raw, spans):
    edges = [0, *(e for s in spans for e in s), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


def test_the_operator_gives_runs_and_bytes(spark, planted):
    raw, want = runs(planted[0])
    docs = spark.createDataFrame([(i, t, "clash", "clash", "clash") for i, t in planted[0].items()], SCHEMA).repartition(3)
    rows = suffixes.remove_repeated(docs).collect()
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in rows} == want
    assert {r.doc_id: bytes(r.kept) for r in rows} == {i: without(x, want[i]) for i, x in raw.items()}
    assert {r.doc_id: r.text for r in rows} == {i: t or "" for i, t in planted[0].items()}


def test_planted_passages_go_and_clean_texts_stay(spark, planted, tmp_path):
    texts, long, short, clean = planted
    spark.createDataFrame([(i, t, "clash", "clash", "clash") for i, t in texts.items()], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in suffixes.query(spark, str(tmp_path)).collect()}
    raw, want = runs(texts)
    assert len(got) == len(texts)
    for i, r in got.items():
        rest = without(raw[i], want[i])
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(raw[i]), len(raw[i]) - len(rest), len(want[i]), hashlib.sha256(rest).hexdigest())
        assert [tuple(s) for s in r.spans] == want[i]
    for i in range(100, 140):
        assert not any(p in got[i].kept_text for p in long)
        # under 400 bytes: the contract leaves it
        assert got[i].kept_text == texts[i] or not any(p in texts[i] for p in short)
    assert all(got[i].kept_text == texts[i] for i in clean)
    # the first byte of the last character ends a repeated string, the other stays
    assert got[200].kept_text == "aé" and got[201].kept_text == "b\ufffd" and got[202].kept_text == ""


def test_a_run_that_cuts_a_character(spark):
    """Two characters that share their last byte: the run begins inside of them."""
    same = "m" * 250 + "".join(chr(0x4E00 + i) for i in range(80))
    docs = spark.createDataFrame([(1, "1é" + same), (2, "2ũ" + same + "x")], "doc_id long, text string")
    got = {r.doc_id: r for r in suffixes.digests(suffixes.remove_repeated(docs)).collect()}
    assert [(got[i].n_removed, got[i].kept_text) for i in (1, 2)] == [(len(same.encode()) + 1, "1\ufffd"), (len(same.encode()) + 1, "2\ufffdx")]
    assert [got[i].kept_sha256 for i in (1, 2)] == [hashlib.sha256(x).hexdigest() for x in (b"1\xc3", b"2\xc5x")]


def test_passages_of_over_50_words(spark, tmp_path):
    """Passages under 400 bytes that repeat across texts, with other spaces between their words: told, and left in."""
    rng = random.Random(47)
    items = [words(rng, n) for n in (51, 52, 58)]
    short = " ".join(words(rng, 60).split()[:50])
    assert max(map(len, items)) < 400
    texts = {i: f"{words(rng, 30)}\n{items[i % 3].replace(' ', (' ', '  ', chr(9), chr(10) + ' ')[i % 4])} {words(rng, 30)}" for i in range(12)}
    texts |= {20 + i: f"{words(rng, 30)} {short} {words(rng, 30)}" for i in range(3)}
    texts |= {30: None, 31: "", 32: " \n ", 33: items[0], 34: "a " * 60, 35: "ñ\u00a0" * 60, 36: "  " + items[1] + "\t", 37: items[0] + "x", 38: items[2], 39: items[2]}
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in suffixes.query(spark, str(tmp_path)).collect()}
    cut = {i: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for i, t in texts.items()}
    seen = [tuple(x[k : k + 51]) for x in cut.values() for k in range(len(x) - 50)]
    for i, x in cut.items():
        gone = set()
        for k in range(len(x) - 50):
            if seen.count(tuple(x[k : k + 51])) > 1:
                gone |= set(range(k, k + 51))
        assert {k for a, b in got[i].passages for k in range(a, b)} == gone and got[i].n_passage_words == len(gone)
    assert all(got[i].n_passage_words >= 51 and got[i].n_removed == 0 for i in range(12))
    assert all(got[i].n_passage_words == 0 for i in (20, 21, 22, 30, 31, 32, 35, 37))
    assert len(got) == len(texts) and got[34].n_passage_words == 60
