"""The operators against brute force, and their edge cases: nulls, empty and long texts, ties, repeated rows, more columns."""

import collections
import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm import dartminhash, decontam, hnsw, langid, mixing, sharding, suffixes, tokens, toolcalls, urls
from larkspur.llm.common import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, host string"


def words(rng, n, letters="abcdefghij"):
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    base = [words(rng, 120) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(20 + i, base[0]) for i in range(5)]
    for i in range(6):
        w = base[1].split()
        w[rng.randrange(len(w))] = f"changed{i}"
        rows.append((30 + i, " ".join(w)))
    rows += [(40, None), (41, ""), (42, " \n"), (43, "one two"), (44, "one two"), (45, "x" * 3000), (46, base[2] * 40), (7, base[7]), (None, base[3] + " tail")]
    data = [(i, t, "en" if (i or 0) % 2 else None, None if (i or 0) % 5 == 0 else f"s{(i or 0) % 3}", 1, "clash", "clash") for i, t in rows]
    return spark.createDataFrame(data, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (5, 5), (None, 4), (3, 1), (3, 1)], "a long, b long")
    assert {(r.node, r.root) for r in components(edges).collect()} == {(2, 1), (3, 1), (9, 8)}
    assert components(edges.limit(0)).count() == 0


def test_urls(spark):
    pages = spark.createDataFrame(
        [(1, "http://WWW.Example.com/en/1?q"), (2, "https://a.example.com/en/"), (3, "x://example.com/fr#f"), (4, None), (5, "no"), (6, "h://notexample.com/en/"), (7, "h://m.b.net/es/1"), (7, "h://m.b.net/es/1"), (8, "h://net")],
        "page_id long, url string",
    ).withColumn("host", F.lit("clash"))
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.filter_urls(pages, spark.createDataFrame(urls.RULES, "host string, path string, verdict string")).collect())
    assert [(a, d, e) for a, _, _, d, e in got] == [
        (1, "www.example.com/en/", "allow"), (2, "example.com/en/", "block"), (3, "com/", "allow"), (4, None, "allow"), (5, None, "allow"),
        (6, "com/", "allow"), (7, "net/es/", "block"), (7, "net/es/", "block"), (8, None, "allow"),
    ]
    assert urls.filter_urls(pages, spark.createDataFrame([], "host string, path string, verdict string")).count() == 9


def test_urls_many_rules(spark, monkeypatch):
    monkeypatch.setattr(urls, "MAX_BROADCAST_RULES", 1)
    rules = spark.createDataFrame([(f"h{i}.com", f"/{i}", "block") for i in range(300)], "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, f"http://a.h{i}.com/{i}/x") for i in range(400)], "page_id long, url string")
    assert urls.filter_urls(pages, rules).where("verdict = 'block'").count() == 300


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [(1, 0, "a", "f", '{"n": 1, "a": "x"}', []), (1, 1, "b", "f", '{"n": "1"}', ["a"]), (1, 1, "c", "f", "[1]", ["d"]), (1, 2, "d", "f", '{"n":1}', ["c"]), (1, 3, "a", "g", "{}", None), (2, 0, None, "f", None, None)],
        "conv_id long, turn long, call_id string, name string, arguments string, after array<string>",
    )
    results = spark.createDataFrame([(1, 1, "a", "ok"), (1, 5, "z", "?"), (1, 0, "b", "early"), (2, 1, None, "x")], "conv_id long, turn long, call_id string, content string")
    schemas = spark.createDataFrame([("f", "n", "integer", True, None, None)], "name string, field string, type string, required boolean, least int, most int")
    rows = toolcalls.link_tool_calls(calls, results, schemas).collect()
    got = {(r.kind, r.call_id, r.turn): (r.status, r.level, r.problems) for r in rows}
    assert got[("call", "a", 0)] == ("linked", 0, []) and got[("call", "b", 1)] == ("unanswered", 2, ["n: not integer"])
    assert got[("call", "c", 1)][:2] == ("cycle", None) and got[("call", "a", 3)] == ("duplicate", 0, ["name: unknown tool"])
    assert got[("result", "z", 5)][0] == "orphan" and got[("result", "b", 0)][0] == "early" and got[("call", None, 0)][0] == "unanswered"
    assert next(r.json for r in rows if r.call_id == "a" and r.turn == 0) == '{"arguments":{"a":"x","n":1},"call_id":"a","kind":"call","name":"f","turn":0}'


def test_tool_calls_of_empty_tables_odd_roles_and_long_texts(spark, tmp_path):
    calls = spark.createDataFrame([], "conv_id long, turn long, call_id string, name string, arguments string, after array<string>")
    results = spark.createDataFrame([], "conv_id long, turn long, call_id string, content string")
    schemas = spark.createDataFrame(toolcalls.SCHEMAS, "name string, field string, type string, required boolean, least int, most int")
    assert toolcalls.link_tool_calls(calls, results, schemas).count() == 0
    turns = [(1, 0, "user", "x" * 2_000_000), (1, 1, "assistant", None), (1, 2, "tool", "t"), (1, 3, None, None), (2, 0, "developer", ""), (None, 0, "user", "")]
    path = str(tmp_path)
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumns({"c": F.lit(1), "r": F.lit(2), "level": F.lit(3)}).write.parquet(f"{path}/conversations.parquet")
    got = {(r.conv_id, r.turn): (r.kind, r.status, r.problems) for r in toolcalls.query(spark, path).collect()}
    assert got == {
        (1, 0): ("call", "linked", "prompt: too long"), (1, 1): ("result", "linked", ""), (1, 2): ("result", "orphan", ""), (1, 3): ("result", "orphan", ""),
        (2, 0): ("result", "orphan", ""), (None, 0): ("call", "unanswered", "prompt: too short"),
    }


def test_levels_agree_with_brute_force(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for conv, several in ((1, 0), (2, 1), (3, 3)):
        n = 40
        for i in range(n):
            after = rng.sample(range(i), min(i, rng.randint(0, several))) if several else [i - 1]
            if conv == 3 and i in (30, 31):
                after = [61 - i]
            rows.append((conv, str(i), [str(x) for x in after] + ["unknown"]))
        held = {i: [int(x) for x in a if x.isdigit() and int(x) < n] for c, i, a in ((c, int(i), a) for c, i, a in rows if c == conv)}
        for _ in range(n):
            for i, a in held.items():
                if all((conv, str(x)) in want for x in a):
                    want[conv, str(i)] = max((want[conv, str(x)] + 1 for x in a), default=0)
    frame = spark.createDataFrame(rows + rows[:5], "conv_id long, call_id string, after array<string>")
    got = toolcalls._levels(frame).collect()
    assert len(got) == len(want) and {(r.conv_id, r.call_id): r.level for r in got} == want


def edit(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        p, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (x != y))
    return d[-1]


def test_decontamination(spark, corpus, empty):
    rng = random.Random(2)
    item = words(rng, 30)
    swapped = item.replace(item.split()[7], "qq", 1)
    half = item[: len(item) // 2]
    rows = [(1, words(rng, 50) + " " + item.upper() + " " + words(rng, 20)), (2, words(rng, 40) + "\n" + swapped), (3, half + " " + words(rng, 60)), (4, None), (5, ""), (6, item), (6, item)]
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "zq")], "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("leaks", F.lit("clash"))
    got = [(r.doc_id, x.item_id, x.edits) for r in decontam.find_leaks(docs, bench).collect() for x in r.leaks]
    assert sorted(got) == [(1, 1, 0), (2, 1, edit(item, swapped)), (6, 1, 0), (6, 1, 0)]
    assert sorted((r.doc_id, x.item_id, x.edits) for r in decontam.find_leaks(docs, bench, block_bytes=100).collect() for x in r.leaks) == sorted(got)
    assert decontam.find_leaks(empty, bench).count() == 0 and decontam.find_leaks(corpus, bench.limit(0)).where("size(leaks) > 0").count() == 0


def test_leaks_of_repeated_items_dont_depend_on_blocks(spark):
    rng = random.Random(7)
    long, other, short = words(rng, 30), words(rng, 25), "ab de"
    bench = spark.createDataFrame([(1, long), (1, other), (1, long), (1, short), (2, other), (2, other + " " + words(rng, 9)), (3, short)], "item_id long, text string")
    texts = [long + " " + other, other + " x " + long, long.replace(long[20], "Q", 1) + " " + other, long, other, short, short + " " + long.replace(long[9:11], "", 1), "none"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = [sorted((r.doc_id, *map(tuple, r.leaks)) for r in decontam.find_leaks(docs, bench, block_bytes=n).collect()) for n in (4 << 20, 200, 10)]
    assert seen[0] == seen[1] == seen[2]
    assert all(len({x[0] for x in r[1:]}) == len(r[1:]) for r in seen[0]) and [len(r) - 1 for r in seen[0]][:2] == [2, 2]
    first = {r[0]: {x[0]: x[1:] for x in r[1:]} for r in seen[0]}
    assert first[0][1] == (0, len(long), 0) and first[1][1] == (0, len(other), 0) and first[2][1][2] == 0


def test_alignment_agrees_with_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        item = "".join(rng.choices("abc", k=40))
        x = list(item)
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(x))
            x[k : k + 1] = rng.choice(["", "z", "zz"])
        text = "".join(rng.choices("xyz", k=rng.randint(0, 20))) + "".join(x) + "".join(rng.choices("xyz", k=9))
        want = min(edit(item, text[i:j]) for i in range(len(text)) for j in range(i, min(len(text), i + 46) + 1))
        got = decontam.align(item, text, -10, 40, 8)
        assert got and got[0] == want and edit(item, text[got[1] : got[2]]) == want


def least_edits(item, text):
    """The least number of edits between an item and any passage of a text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_decontamination_agrees_with_brute_force(spark):
    """Items of 1 to 90 characters, passages with about as many edits as the budget has, letters of several bytes."""
    rng = random.Random(11)
    items = ["".join(rng.choices("abcdé日 ", k=n)).strip() or "a" for n in (1, 5, 7, 8, 9, 10, 14, 19, 20, 25, 29, 30, 33, 39, 40, 55, 80, 90)]
    texts = []
    for item in items:
        for edits in (0, 1, 2, 3, 4, 8, 10):
            x = list(item)
            for _ in range(edits):
                k = rng.randrange(max(1, len(x)))
                x[k : k + 1] = rng.choice(["", "z", "zy"])
            texts.append("".join(rng.choices("vwxyz ", k=rng.randint(0, 30))) + "".join(x) + "".join(rng.choices("vwxyz ", k=rng.randint(0, 30))))
    norm = [decontam.normalized(x) for x in items]
    want = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(norm):
            if item and (n := least_edits(item, decontam.normalized(text))) <= int(0.1 * len(item)):
                want[d, i] = n
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for size in (1 << 20, 60):
        found = decontam.find_leaks(docs, bench, block_bytes=size).collect()
        assert {(r.doc_id, x.item_id): x.edits for r in found for x in r.leaks} == want
    norms = [decontam.normalized(x) for x in texts]
    assert all(edit(norm[x.item_id], norms[r.doc_id][x.start : x.end]) == x.edits for r in found for x in r.leaks)
    assert len(want) > 60


def test_repetitive_texts_are_counted_in_slices(monkeypatch):
    item = "-" * 300 + " end"
    index = decontam.Index([(1, item), (2, "-" * 200)])
    text = "x " + "-" * 3000 + " end"
    whole = index.leaks(text)
    monkeypatch.setattr(decontam, "SLICE", 1000)
    assert index.leaks(text) == whole == [(1, 2702, 3006, 0), (2, 2, 202, 0)]


@pytest.mark.parametrize("n", [8, 3, 1])
def test_sharding(corpus, n):
    got = sharding.shard_documents(corpus, n).toPandas()
    texts = {r.doc_id: r.text for r in corpus.collect()}
    assert len(got) == corpus.count()
    for s, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g))) and 0 <= s < n
    known = got.dropna(subset=["doc_id"])
    assert all(zlib.crc32((texts[int(i)] or "").encode()) == c and len((texts[int(i)] or "").encode()) + 1 == z for i, c, z in zip(known.doc_id, known.text_crc32, known["size"]))


def test_sources_of_one_prefix_are_told_apart(spark):
    rows = spark.createDataFrame([(i, "x", None, f"https://h{i % 7}") for i in range(70)] + [(99, "y", "en", None)], "doc_id long, text string, lang string, source string")
    got = sharding.points_of(rows).toPandas()
    assert got.set_index("doc_id").d1.loc[99] == 0 and got["size"].eq(2).all()
    ranks = sharding._ranked(rows, "source", "rank").toPandas().set_index("doc_id")["rank"]
    assert [ranks[i] for i in range(7)] == [1, 2, 3, 4, 5, 6, 7] and ranks[99] == 0


def test_shards_are_those_of_weighted_medians(spark):
    """Each node is cut along its widest dimension where the left weight is nearest to its share."""
    rng = random.Random(31)
    rows = [(i, "x" * rng.randint(1, 4000), rng.choice(["en", "de", None]), f"s{rng.randrange(9)}") for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    points = sharding.points_of(docs)
    data = points.toPandas()
    scale = {d: (data[d].max() - data[d].min()) or 1.0 for d in ("d0", "d1", "d2")}

    def split(part, first, many):
        if many == 1:
            return dict.fromkeys(part.doc_id, first)
        widest = max(scale, key=lambda d: (part[d].max() - part[d].min()) / scale[d])
        part = part.sort_values([widest, "group_key", "row_key"])
        total, need = part["size"].cumsum().to_numpy(), part["size"].sum() * (many // 2) / many
        k = int(np.searchsorted(total, need))
        before = total[k - 1] if k else 0
        k += bool(total[k] - need < need - before)
        return split(part.iloc[:k], first, many // 2) | split(part.iloc[k:], first + many // 2, many - many // 2)

    for n in (8, 5):
        got = {r.doc_id: r.shard for r in sharding.kd_assign(points, n, tolerance=0).collect()}
        assert got == split(data, 0, n)


def test_sharding_is_even(spark, empty):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").otherwise(F.repeat(F.lit("x"), (F.col("id") % 50).cast("int"))).alias("text"), F.lit("a").alias("lang"), F.lit(None).cast("string").alias("source"))
    size = sharding.shard_documents(rows).groupBy("shard").agg(F.sum("size").alias("s")).toPandas().s
    assert len(size) == 8 and size.max() - size.min() < 0.02 * size.mean()
    assert sharding.shard_documents(empty).count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 16))
    x[100:140] = x[0] + rng.normal(size=(40, 16)) * 0.05
    x[140:160] = x[1]
    rows = [(i, [float(z) for z in v]) for i, v in enumerate(x)]
    rows += [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] + [1.0] * 15), (1003, [None] + [1.0] * 15), (1004, []), (None, [1.0] * 16), (1005, [1.0] * 5)]
    got = hnsw.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1))).toPandas().set_index("vec_id")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T) >= 0.9
    assert (got.loc[range(300)].n_links.to_numpy() == near.sum(1) - 1).all()
    assert got.loc[120].component_id == 0 and got.loc[150].component_id == 1 and bool(got.loc[1001].kept)
    assert (got.loc[[1000, 1001, 1002, 1003, 1004, 1005]].n_links == 0).all()
    assert hnsw.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def linked_by_brute_force(x, n=None):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    root = np.arange(len(x))
    while not np.array_equal(up := np.where(near, root, len(x)).min(1, initial=len(x)).clip(max=root), root):
        root = up
    return near @ (np.ones(len(x), int) if n is None else n), root


@pytest.mark.parametrize("noise", [0.05, 0.13])
def test_vectors_in_groups_of_several_sizes(spark, noise):
    """Tight groups are linked by their angles alone, loose ones, of which some pairs are linked and some not, by comparing."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 16))
    at = 0
    for size in (700, 150, 60, 9, 3, 2):
        x[at : at + size] = x[at] + rng.normal(size=(size, 16)) * noise * np.linalg.norm(x[at])
        at += size
    x = x[rng.permutation(1500)]
    rows = spark.createDataFrame([(i, [float(z) for z in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = hnsw.near_vectors(rows.repartition(5)).toPandas().set_index("vec_id").sort_index()
    links, root = linked_by_brute_force(x)
    assert links.max() > 50 and (got.n_links.to_numpy() == links).all()
    assert (got.component_id.to_numpy() == root).all() and (got.kept.to_numpy() == (root == np.arange(1500))).all()


def test_leaders():
    rng = np.random.default_rng(6)
    x = hnsw._unit(rng.normal(size=(1300, 8)))
    lead = hnsw.leaders(x, 0.95)
    assert (lead[lead] == lead).all() and (np.einsum("rd,rd->r", x, x[lead]) >= 0.95 - 1e-9).all()
    first = np.unique(lead)
    assert ((x[first] @ x[first].T >= 0.95) == np.eye(len(first), dtype=bool)).all()


def test_audit_of_vectors_beside_a_large_group(spark, monkeypatch):
    """Beams that miss all sparse links fail the audit, however many links a large group has; then shards are compared."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 16))
    x[:300] = x[0] + rng.normal(size=(300, 16)) * 0.02
    x[450:] = x[300:450] + rng.normal(size=(150, 16)) * 0.02
    real = hnsw._asked

    def blind(threshold):
        def run(graph, ask):
            got = real(threshold)(graph, ask)
            return got[:0] if len(ask) and ask["width"].iloc[0] else got

        return run

    monkeypatch.setattr(hnsw, "_asked", blind)
    monkeypatch.setattr(hnsw, "SHARDS", 2)
    n = np.where(np.arange(600) < 300, 100, 1)
    classes = spark.createDataFrame([(i, int(n[i]), v.tobytes(), 128) for i, v in enumerate(x)], "rep long, n long, v binary, dim int")
    got = hnsw.find_links(classes).toPandas().set_index("rep").sort_index()
    links, root = linked_by_brute_force(x, n)
    assert (got.near.to_numpy() == links).all() and (got.root.to_numpy() == root).all()


def shingle_counts(t):
    w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())
    n = min(5, len(w))
    return collections.Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else None


def test_near_duplicates(corpus, empty):
    rows = [(r.doc_id, shingle_counts(r.text)) for r in corpus.collect()]
    root = list(range(len(rows)))

    def find(i):
        return i if root[i] == i else find(root[i])

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            b = rows[j][1]
            if a and b and sum((a & b).values()) >= 0.8 * sum((a | b).values()):
                root[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i, (d, a) in enumerate(rows):
        groups[find(i)].append(d)
    want = collections.Counter((d, min((x for x in g if x is not None), default=None)) for g in groups.values() for d in g)
    got = collections.Counter((r.doc_id, r.class_id) for r in dartminhash.near_duplicates(corpus).collect())
    assert got == want
    kept = dartminhash.keep_one(corpus)
    assert kept.columns == corpus.columns and kept.count() == len(groups)
    assert dartminhash.near_duplicates(empty).count() == 0 and dartminhash.keep_one(empty).count() == 0


def test_keep_one_keeps_columns_of_any_name(spark):
    rows = [(2, "a b c d e f", 1, 2, 3), (1, "A b c d e f!", 4, 5, 6), (1, "A b c d e f!", 4, 5, 6), (None, "a b c d e f", 7, 8, 9), (5, None, 0, 0, 0), (6, "!", 0, 0, 0), (6, "!", 0, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_same int, stay_id int, stay_key int")
    kept = dartminhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[1], rows[4], rows[5], rows[6]], key=str)


def test_a_large_component_beside_outsiders(spark):
    """Members of the largest component of a bucket meet only those of others; all links are still found."""
    rng = random.Random(4)
    w = words(rng, 60).split()
    copies = [" ".join(w[:i] + [f"x{i}"] + w[i + 1 :]) for i in range(0, 60, 2)]
    docs = spark.createDataFrame(list(enumerate(copies + [words(rng, 60) for _ in range(5)])), "doc_id long, text string")
    assert sorted(r.class_id for r in dartminhash.near_duplicates(docs).collect()) == [0] * 30 + list(range(30, 35))


def test_near_duplicates_that_meet_in_one_band(spark):
    rng = random.Random(1598)
    w = words(rng, 50).split()
    texts = [" ".join(w), " ".join(w[:25] + ["changed"] + w[26:])]
    (_, cell, doc), = dartminhash.cells(texts)
    a, b = dartminhash.band_keys(dartminhash.darts(cell, doc, 2))
    assert (a == b).sum() == 1
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.class_id for r in dartminhash.near_duplicates(docs).collect()} == {0}


def test_near_duplicates_of_just_the_least_similarity(spark):
    rng = random.Random(3)
    w = words(rng, 39).split()
    texts = [" ".join(w), " ".join(w[:32])] + [words(rng, 20) for _ in range(30)]  # 28 of 35 shingles; the rest are for the last round
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.class_id for r in dartminhash.near_duplicates(docs).collect()) == [0, 0, *range(2, 32)]


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 2**63, 400, dtype=np.uint64)
    for share in (0.2, 0.5, 0.9):
        b = a.copy()
        b[: int(len(a) * (1 - share))] = rng.integers(0, 2**63, int(len(a) * (1 - share)), dtype=np.uint64)
        s = dartminhash.darts(np.concatenate([a, b]), np.repeat([0, 1], 400), 2, 2048)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((s[0] == s[1]).mean() - true) < 0.05


def test_mix(corpus, empty, spark):
    got = mixing.plan_mix(corpus).toPandas()
    total, per = got["size"].sum(), got.groupby(["source_null", "source_key"])
    assert len(got) == corpus.count() and abs(per.target.first().sum() - 1.5 * total) < 1e-6 * total
    assert (got.taken <= 2 * got["size"]).all() and (per.target.first() <= 2 * per.source_size.first() + 1e-9).all()
    off = (per.taken.sum() - per.target.first()).abs()
    assert (off <= per["size"].max()).all()
    mixed = mixing.mix_documents(corpus)
    assert mixed.columns == corpus.columns and mixed.count() == got.copies.sum()
    assert mixing.plan_mix(empty).count() == 0 and mixing.mix_documents(empty).count() == 0


def test_mix_takes_what_the_plan_says(spark):
    """Null ids and repeated rows: each row's number of copies in the mix is that of the plan."""
    rng = random.Random(12)
    rows = [(None, words(rng, rng.randint(1, 30)), "a") for _ in range(60)] + [(i, words(rng, rng.randint(1, 30)), "b") for i in range(60)]
    rows += [(7, rows[67][1], "b")] * 9 + [(None, None, "a"), (None, "", None), (900, "x y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"size": F.lit(1), "copies": F.lit(2), "salt": F.lit(3)})
    plan, mixed = mixing.plan_mix(docs).toPandas(), mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    per = mixed.groupBy(F.coalesce("source", F.lit("")).alias("s")).agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).toPandas().set_index("s").n
    assert (per.sort_index() == plan[plan.copies > 0].groupby("source_key").taken.sum().sort_index()).all()
    assert mixed.count() == plan.copies.sum()


def test_mix_of_repeated_and_null_ids(spark):
    """60 rows of one id are cut row by row, and null ids are keyed as in the SQL."""
    duckdb = pytest.importorskip("duckdb")
    rng = random.Random(2)
    rows = [(5, "a b c d e", "hot")] * 60 + [(i, words(rng, 5), "cold") for i in range(100, 400)] + [(None, words(rng, rng.randint(1, 9)), rng.choice(["hot", None])) for _ in range(50)]
    rows += [(5, "a b c d e f", "hot"), (None, None, None), (None, "x", "cold"), (None, "x", "cold")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    plan = mixing.plan_mix(docs, weights=(1, 1), share=0.4)
    one = plan.where("source_key = 'hot'").toPandas()
    assert abs(one.taken.sum() - one.target.iloc[0]) <= 9 and set(one.copies) == {0, 1}
    mixed = mixing.mix_documents(docs, weights=(1, 1), share=0.4)
    got, want = (collections.Counter(map(tuple, x)) for x in (mixed.collect(), docs.collect()))
    assert sum(got.values()) == plan.agg(F.sum("copies")).first()[0] and all(got[k] <= 2 * want[k] for k in got)
    assert 0 < got[5, "a b c d e", "hot"] < 60
    frame = docs.toPandas()
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    con = duckdb.connect()
    con.register("frame", frame)
    con.execute("CREATE TABLE documents AS SELECT doc_id::BIGINT AS doc_id, text, source FROM frame")
    sql = con.execute(mixing.ORACLE_SQL).fetchall()
    found = mixing.plan_mix(docs).select("doc_id", "size", "source_size", "target", "taken").collect()
    shown = lambda x: sorted(f"{a}|{b}|{c}|{t:.6f}|{n}" for a, b, c, t, n in x)
    assert shown(found) == shown(sql)


def test_mix_of_many_sources(spark, monkeypatch, corpus):
    want = sorted(r.doc_id or -1 for r in mixing.mix_documents(corpus).collect())
    monkeypatch.setattr(mixing, "MAX_BROADCAST_SOURCES", 0)
    assert sorted(r.doc_id or -1 for r in mixing.mix_documents(corpus).collect()) == want


def test_tokens(spark, corpus, empty, monkeypatch):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    ref = Tokenizer.from_file(path)
    texts = ["", " ", "it's don't !'s ''s", "a<|endoftext|>b", "İstanbul ΑΣ ΟΔΟΣ", "é e\u0301 １２ ½ 北京 🎉", "x" * 500, "a\x00b\x0bc\x85d", "<|endof text|>", None, "word " * 300]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(corpus.select("doc_id", "text"))
    for chunk in (1 << 16, 23):
        monkeypatch.setattr(tokens, "CHUNK", chunk)
        monkeypatch.setattr(tokens, "SCAN", 3)
        got = collections.Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in tokens.count_tokens(rows, path).collect())
        want = collections.Counter((r.doc_id, len((r.text or "").encode()), len(ref.encode(r.text or "", add_special_tokens=False).ids)) for r in rows.collect())
        assert got == want
    assert tokens.count_tokens(empty, path).count() == 0


def test_tokens_of_strange_words():
    """The automaton against the library, on letters that merge in many ways."""
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    ref, own = Tokenizer.from_file(path), tokens.transducer(path)
    rng = random.Random(1)
    for _ in range(1500):
        alphabet = rng.choice(["ab", "etaoin", "abcdefghijklmnopqrstuvwxyz", "-=_*", "éèñüß", "日本語中国", "aA1. ", "0123456789", "'st'rd", "🎉🙂a"])
        x = "".join(rng.choices(alphabet, k=rng.choice([1, 3, 8, 30, 200])))
        assert own.count(x) == len(ref.encode(x, add_special_tokens=False).ids), x


def test_tokens_of_a_very_long_word():
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    ref, own = Tokenizer.from_file(path), tokens.transducer(path)
    rng = random.Random(7)
    for x in ("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1 << 20)), "-" * (1 << 20)):
        start = time.time()
        n = own.count(x)
        assert time.time() - start < 60 and n == len(ref.encode(x, add_special_tokens=False).ids)


def test_maps_of_chunks_compose_in_any_grouping():
    P = pytest.importorskip("public_tokenizers")
    t = tokens.transducer(P.path("word_bpe_49k.json"))
    rng = random.Random(3)
    for _ in range(50):
        x = "".join(rng.choices("ab \n.", weights=[9, 9, 1, 1, 1], k=200))
        maps = [t.chunk(x[i : i + 11]) for i in range(0, len(x), 11)]
        k = rng.randrange(1, len(maps))
        assert t.closed(t.compose(maps)) == t.closed(t.pair(t.compose(maps[:k]), t.compose(maps[k:]))) == t.count(x)


def test_language(spark, corpus, empty):
    rng = random.Random(9)
    rows = [(i, words(rng, 30, "abcdefg" if i % 2 else "tuvwxyz"), "aa" if i % 2 else "tt") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    got = langid.identify(docs, model).toPandas()
    assert (got.lang == got.lang_pred).all() and got.score.between(0, 1).all()
    mixed = langid.label(rows[1][1] + " " + rows[2][1] + " " + rows[4][1], langid.Scorer(model))
    assert mixed[0] == "tt" and [s[0] for s in mixed[2]] == ["aa", "tt"]
    odd = langid.identify(spark.createDataFrame([(1, None), (2, "123 !"), (3, ""), (4, "Ж")], "doc_id long, text string"), model)
    assert [r.lang_pred for r in odd.orderBy("doc_id").collect()][:3] == ["und"] * 3
    assert langid.identify(empty, model).count() == 0 and langid.identify(corpus, langid.fit(empty)).where("lang_pred <> 'und'").count() == 0


def test_language_of_held_out_documents(spark):
    """Accuracy on documents that were not learned from, clashing columns, ties and repeated rows."""
    rng = random.Random(21)
    letters = {"aa": "abcdefgh", "bb": "ghijklmn", "cc": "абвгде"}
    rows = [(i, words(rng, rng.randint(3, 60), letters[k]), k) for i, k in ((i, rng.choice(list(letters))) for i in range(900))]
    docs = spark.createDataFrame(rows + rows[:50] + [(None, "abc", "bb"), (950, "abc", None), (951, None, "aa")], "doc_id long, text string, lang string")
    docs = docs.withColumns({"lang_pred": F.lit("clash"), "score": F.lit(7), "spans": F.lit(1)})
    model = langid.fit(docs)
    assert model.langs == ["aa", "bb", "cc"]
    got = langid.identify(docs, model).withColumn("held", langid.held_out()).where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").toPandas()
    held = got[got.held]
    assert len(got) == 950 and len(held) > 200 and (held.lang == held.lang_pred).mean() > 0.97
    learned = [i for i in range(20) if zlib.crc32(str(i).encode()) % 3 != 1]
    tie = langid.fit(spark.createDataFrame([(learned[0], "abc", "yy"), (learned[1], "abc", "xx")], "doc_id long, text string, lang string"))
    assert tie.langs == ["xx", "yy"] and tie.usual == 0


def test_viterbi_agrees_with_brute_force():
    import itertools

    rng = np.random.default_rng(0)
    for _ in range(40):
        s = rng.normal(size=(6, 3)) * 6
        cost = lambda p: sum(s[i, k] for i, k in enumerate(p)) - langid.SWITCH * sum(a != b for a, b in zip(p, p[1:]))
        assert abs(cost(langid.viterbi(s)) - max(map(cost, itertools.product(range(3), repeat=6)))) < 1e-9


def test_repeated_strings(spark, corpus, empty):
    rng = random.Random(8)
    a = words(rng, 200)
    extra = [(100, "é" + a + words(rng, 50)), (101, words(rng, 20) + a[30:900]), (102, a[:399]), (103, a[500:900] + "#" + a[500:900]), (104, "ab" * 700)]
    docs = corpus.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    seen = collections.Counter(x[p : p + 400] for _, x in rows for p in range(len(x) - 399))
    want = collections.Counter()
    for i, x in rows:
        gone = np.zeros(len(x), bool)
        for p in range(len(x) - 399):
            if seen[x[p : p + 400]] > 1:
                gone[p : p + 400] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        want[(i, len(x), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(x, np.uint8)[~gone])).hexdigest())] += 1
    path = f"file:///tmp/larkspur-test-{random.random()}"
    docs.write.parquet(path)
    got = collections.Counter(tuple(r) for r in suffixes.repeated_strings(spark.read.parquet(path)).collect())
    assert got == want
    assert suffixes.repeated_strings(empty).count() == 0


def test_difference_cover():
    c = suffixes.difference_cover()
    assert {(a - b) % suffixes.PERIOD for a in c for b in c} == set(range(suffixes.PERIOD))


def test_pipeline(spark, tmp_path, corpus):
    import corpus_pipeline

    path = str(tmp_path)
    rng = random.Random(6)
    item = words(rng, 30)
    docs = spark.createDataFrame([(i, words(rng, 60) + (" " + item if i == 5 else ""), "en", f"s{i % 3}", 1) for i in range(60)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.unionByName(docs.where("doc_id = 7").withColumn("doc_id", F.lit(200).cast("long"))).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, path).toPandas()
    assert not {5, 200} & set(got.doc_id) and set(got.doc_id) <= set(range(60)) and got.groupby("doc_id").size().max() <= 2
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "mixing", "sharding"]


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Null, empty, very long and repeated texts, null ids and sources; then an empty table."""
    import corpus_pipeline

    rng = random.Random(16)
    item = words(rng, 30)
    rows = [(i, words(rng, 40), "en", f"s{i % 2}", 1) for i in range(40)]
    rows += [(50, None, None, None, None), (51, "", "", "", 0), (52, words(rng, 200_000), "en", None, 1), (53, "!!! 123", "en", "s0", 1), (None, words(rng, 40), "en", "s1", 1), rows[3], rows[3]]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, data in (("odd", rows), ("none", [])):
        path = str(tmp_path / name)
        spark.createDataFrame(data, schema).withColumns({"size": F.lit(1), "stay_id": F.lit(2)}).write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
        docs = spark.read.parquet(f"{path}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, path)
            assert out.columns == docs.columns
            out.write.parquet(f"{path}/{stage.__name__}")
            docs = spark.read.parquet(f"{path}/{stage.__name__}")
        got = corpus_pipeline.run(spark, path).toPandas()
        assert sorted(got.doc_id.dropna()) == sorted(r.doc_id for r in docs.collect() if r.doc_id is not None)
        assert got.empty if not data else set(got.doc_id.dropna()) <= {*range(40), 52} and got.groupby("doc_id").size().max() <= 2


def test_a_text_of_over_a_megabyte(spark, tmp_path):
    rng = random.Random(17)
    long = words(rng, 220_000)
    assert len(long) > 1_000_000
    item = " ".join(long.split()[150_000:150_030])
    data = [(1, long, "en", "a"), (2, long[:-4] + "tail", "en", "a"), (3, words(rng, 50), "en", "b")]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    assert {r.doc_id for r in decontam.find_leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).where("size(leaks) > 0").collect()} == {1, 2}
    assert {r.doc_id: r.class_id for r in dartminhash.near_duplicates(docs).collect()} == {1: 1, 2: 1, 3: 3}
    assert mixing.plan_mix(docs).agg(F.sum("size")).first()[0] == sum(len(r[1].split()) for r in data)
    assert sharding.shard_documents(docs, 2).groupBy("shard").count().count() == 2
    assert langid.identify(docs, langid.fit(docs)).where("lang_pred = 'en'").count() == 3
    removed = {r.doc_id: r.n_removed for r in suffixes.repeated_strings(docs).collect()}
    assert removed[3] == 0 and removed[1] >= len(long) - 8 and removed[2] == removed[1]
    pages = spark.createDataFrame([(1, "h://a.b.com/" + "x" * 1_200_000), (2, "h://" + "y" * 1_200_000), (3, "h://" + "a." * 300_000 + "net/es/1")], "page_id long, url string")
    rules = spark.createDataFrame(urls.RULES, "host string, path string, verdict string")
    assert {r.page_id: r.rule for r in urls.filter_urls(pages, rules).collect()} == {1: "com/", 2: None, 3: "net/es/"}
