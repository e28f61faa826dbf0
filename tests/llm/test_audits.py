"""Filter interactions, source divergence and license scans against brute force, with nulls, empty and long texts, ties and repeated rows."""

import collections
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from larkspur.llm import divergence, filters, licenses

DOCS = "doc_id long, text string, lang string, source string, n_chars long, mask string, part string, task string, key string, g string"
LABELS = "doc_id long, quality int, toxic int, n string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, lang, s, 1, *["clash"] * 5) for i, t, lang, s in rows], DOCS).repartition(parts)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    names = ["alpha", "Beta", "gamma", "delta", "éte", "Éte", "ZZ", "x9y", "it's", "$5", "naïve"]
    text = lambda n: " ".join(rng.choices(names, k=n))
    out = [(i, text(rng.randint(0, 80)), rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", "", None])) for i in range(60)]
    copy = " ".join(f"w{i}" for i in range(60))
    out += [(100 + i, copy, "en", rng.choice(["a", "b"])) for i in range(40)]
    out += [(90, copy, "en", None), (90, copy, "en", None), (None, copy, "en", "a"), (None, copy, "en", "a"), (None, "alone", "en", "b")]
    out += [(200, None, None, None), (201, "", "fr", "a"), (202, "", "de", "only"), (203, "ABC " * 200_000, "en", "a"), (7, out[7][1], *out[7][2:])]
    return out


def failed(rows):
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    for i, t, _, s in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        yield i, s or "", {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and least[t] < i,
        }


@pytest.mark.parametrize("partitions", [2, 40])
def test_filter_audit(spark, rows, partitions):
    labels = [(i, i % 2, i % 3 == 0, "clash") for i in range(0, 210, 2)] + [(4, 1, 1, "clash"), (None, 1, 1, "clash"), (6, None, None, "clash")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        masks = filters.failure_masks(frame(spark, rows))
        table = spark.createDataFrame([(i, q, None if t is None else int(t), n) for i, q, t, n in labels], LABELS)
        got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in filters.interactions(filters.mask_counters(masks, table)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    good, toxic = {i for i, q, *_ in labels if q == 1 and i is not None}, {i for i, _, t, _ in labels if t and i is not None}
    want, shares = {}, collections.Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for part, docs in itertools.groupby(sorted(failed(rows), key=lambda x: x[1]), key=lambda x: x[1]):
            left = docs = list(docs)
            for step, f in enumerate(order, 1):
                out, kept = [d for d in left if d[2][f]], [d for d in left if not d[2][f]]
                alone = sum(d[2][f] and sum(d[2].values()) == 1 for d in docs)
                want[part, order, step] = (len(kept), len(out), sum(d[2][f] for d in docs) - len(out), alone, sum(d[0] in good for d in out), sum(d[0] in toxic for d in out))
                shares[part, f] += len(out)
                left = kept
    assert got == {k: (*v, shares[k[0], k[1][k[2] - 1]]) for k, v in want.items()}


def test_filter_audit_of_an_empty_table(spark):
    labels = spark.createDataFrame([], LABELS)
    assert filters.interactions(filters.mask_counters(filters.failure_masks(frame(spark, [])), labels)).count() == 0


def measured(rows, min_docs=3, top=200):
    counts, docs = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for _, t, lang, s in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        counts[lang or "", s or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = set()
    for (lang, s), own in counts.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        n = lambda c: sum(c[t] for t in kept)
        p = lambda c, t: 1 + 10**9 * (c[t] + 1) // (n(c) + len(kept))
        f = lambda a, b: (a - b) ** 2 // b
        all_ = sum((c for (other, _), c in counts.items() if other == lang), collections.Counter())
        pairs = [(o, sum(f(p(own, t), p(c, t)) for t in kept)) for (other, o), c in counts.items() if other == lang and o != s]
        terms = [(t, f(p(own, t), p(all_, t))) for t in kept if own[t] > 0 and p(own, t) > p(all_, t)]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out |= {(lang, s, part, item, value, i) for i, (item, value) in enumerate(found[:most], 1)}
    return out


def test_divergence(spark, rows):
    got = [tuple(r) for r in divergence.divergence(frame(spark, rows)).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got)) and set(got) == measured(rows)


def test_divergence_of_many_groups_and_small_pieces(spark, rows, monkeypatch):
    monkeypatch.setattr(divergence, "MAX_BROADCAST_GROUPS", 1)
    got = {tuple(r) for r in divergence.divergence(frame(spark, rows), top=3).select("lang", "source", "part", "item", "value", "rank").collect()}
    assert got == measured(rows, top=3)
    monkeypatch.setattr(divergence, "PIECE", 7)
    text = "One twö three-four FIVE " * 50
    assert [t for part in divergence.terms_of(text.encode()) for t in part] == "one twö three four five".encode().split() * 50
    assert divergence.divergence(frame(spark, [])).count() == 0


def test_license_scan(spark):
    pad = "lorem ipsum dolor sit amet "
    notice = next(t.text for t in licenses.NOTICES if t.label == "bsd")
    edited = notice.replace("binary", "object").replace("permitted ", "")
    rows = [
        (1, pad + "under the GNU  General-Public\nLicense and MIT license " + pad), (2, "cc by cc BY. cc. by"), (3, pad + notice + " " + pad), (4, pad + edited), (4, pad + edited),
        (5, " ".join(notice.split()[:5]) + " " + pad * 9), (6, None), (7, ""), (8, "!!"), (None, "apache license"), (None, "apache license"), (9, (pad * 9000) + "Apache License"),
        (10, "apachelicense éapache license mit licenseé"),
    ]
    got = collections.defaultdict(list)
    for r in licenses.scan_licenses(frame(spark, [(i, t, None, None) for i, t in rows])).collect():
        got[r.doc_id].append(tuple(r)[1:])
    assert got[1][0][1:] == (2, 7, 12, "gpl,mit", "gpl,mit", 1.0) and got[2][0] == (6, 3, 0, 4, "cc-by", "cc-by", 1.0)
    assert got[3][0][1:] == (0, None, None, "", "bsd", 1.0) and got[4] == got[4][:1] * 2
    assert got[4][0][5] == "bsd" and 0.8 <= got[4][0][6] < 1
    assert got[5][0][5:] == ("", 0.0) and got[6] == got[7] == got[8] == [(0, 0, None, None, "", "", 0.0)]
    assert got[None] == [(2, 1, 0, 0, "apache", "apache", 1.0)] * 2 and got[9][0][:4] == (45002, 1, 45000, 45000)
    assert got[10] == [(5, 0, None, None, "", "", 0.0)]
    assert licenses.scan_licenses(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        licenses.scan_licenses(frame(spark, []), [licenses.Template("x", "one")])


def test_license_scan_against_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(licenses, "ROW_GRAMS", 16)
    vocabulary = "mit license apache cc by gnu general public the of".split()
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 120)))) for i in range(80)]
    got = {r.doc_id: (r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan_licenses(frame(spark, [(i, t, None, None) for i, t in rows])).collect()}
    for i, t in rows:
        w = t.split()
        hits = [(at, p.label) for p in licenses.PHRASES for at in range(len(w)) if w[at : at + len(p.text.split())] == p.text.split()]
        places = [at for at, _ in hits]
        assert got[i] == (len(hits), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in hits})))


def test_word_hashes_of_long_texts(monkeypatch):
    text = "One twö 3 four-five " * 3000
    whole = next(licenses.word_hashes([text]))
    monkeypatch.setattr(licenses, "PIECE", 100)
    assert len(whole) == 15000 and (next(licenses.word_hashes([text])) == whole).all()
    assert [len(h) for h in licenses.word_hashes(["a b", "", None, " c", text, "d"])] == [2, 0, 0, 1, 15000, 1]


def test_edits_within():
    import numpy as np

    def brute(a, b):
        best = len(a)
        for i in range(len(b) + 1):
            for j in range(i, len(b) + 1):
                row = list(range(j - i + 1))
                for x in a:
                    new = [row[0] + 1]
                    for k, y in enumerate(b[i:j], 1):
                        new.append(min(row[k] + 1, new[-1] + 1, row[k - 1] + (x != y)))
                    row = new
                best = min(best, row[-1])
        return best

    rng = random.Random(1)
    for _ in range(60):
        a, b = ([rng.randint(0, 3) for _ in range(rng.randint(1, 6))] for _ in range(2))
        assert licenses.edits_within(np.array(a), np.array(b)) == brute(a, b)
