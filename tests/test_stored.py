"""Tables at rest: merges by bucket, views that are kept up to date, snapshots compared in place, large samples, fuzzy candidates."""

import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from larkspur.operators import diff, merge, search, stats, views
from larkspur.sources import stored

LIVE = "id long, price double, status string"


def files(path):
    return {p.relative_to(path).parts[0]: p.name for p in Path(path).rglob("*.parquet")}


def add(new, live):
    return merge.upsert_by(new.withColumn("seq", F.lit(1)), live, "id")


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "live")
    stored.create(spark.range(200).select("id", F.lit(1.0).alias("price"), F.lit("active").alias("status")), path, "id", 8)
    return path


def test_only_touched_buckets_are_swapped(spark, table):
    before = files(f"{table}/rows")
    new = spark.createDataFrame([(3, 2.0, "active"), (900, 3.0, "new")], LIVE)
    touched = stored.apply_batch(spark, table, 1, new, "id", add)
    after = files(f"{table}/rows")
    assert 1 <= len(touched) <= 2 and len(before) == 8
    assert {k for k in before if before[k] != after[k]} == {f"bucket={b}" for b in touched}
    rows = {r.id: (r.price, r.status) for r in stored.stored(spark, table).collect()}
    assert len(rows) == 201 and rows[3] == (2.0, "active") and rows[900] == (3.0, "new") and rows[4] == (1.0, "active")
    # a rerun changes nothing, whatever it brings
    assert stored.apply_batch(spark, table, 1, new.withColumn("price", F.lit(9.0)), "id", add) == []
    assert files(f"{table}/rows") == after and stored.commits(spark, table).count() == 2
    plan = stored.stored(spark, table, touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan


def test_a_run_that_ended_within_the_swap(spark, table, monkeypatch):
    new, calls = spark.createDataFrame([(5, 7.0, "active"), (None, 1.0, "no id")], LIVE), []

    def count(a, b):
        calls.append(1)
        return b.withColumn("price", F.col("price") + 1).unionByName(a.where("id IS NULL"))

    def broken(*x):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(stored, "_commit", broken)
        with pytest.raises(OSError):
            stored.apply_batch(spark, table, 1, new, "id", count)
    with pytest.raises(RuntimeError):
        stored.apply_batch(spark, table, 2, new, "id", count)
    touched = stored.apply_batch(spark, table, 1, new, "id", count)
    rows = stored.stored(spark, table, touched)
    assert calls == [1] and rows.where("id IS NOT NULL AND price <> 2").count() == 0 and rows.where("id IS NULL").count() == 1
    assert not os.path.exists(f"{table}/next") and stored.apply_batch(spark, table, 2, new.limit(0), "id", count) == []


def test_kept_view_is_the_full_aggregate(spark):
    rng, by = random.Random(4), ["city"]
    row = lambda i: (i, rng.choice(["a", "", None]), rng.choice([None, 1.0, 2.0, 3.5]), rng.choice([None, 10.0, 20.0]), rng.choice(["active", "inactive"]))
    frame = lambda rows: spark.createDataFrame(list(rows.values()), "id long, city string, price double, total_area_m2 double, status string").coalesce(1)
    rows = {i: row(i) for i in range(30)}
    held = views.counted(frame(rows), by)
    for _ in range(3):
        now = rows | {i: row(i) for i in rng.sample(range(40), 12)}
        changed = {i for i in now if now[i] != rows.get(i)}
        change = views.deltas(frame({i: rows[i] for i in changed if i in rows} or {-1: (None,) * 5}).where("id IS NOT NULL"), frame({i: now[i] for i in changed}), by)
        held = spark.createDataFrame(views.combine(change, held).collect(), held.schema)
        rows = now
        whole = stats.property_stats(frame(rows), *by)
        assert sorted(map(str, views.stats_view(held, by).collect())) == sorted(map(str, whole.collect()))
        assert held.where("n <= 0").count() == 0


def test_snapshots_are_compared_without_a_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fields = ["title", "price"]
        new = spark.createDataFrame([(1, "a", 100.0), (2, "b", 100.5), (3, "c", 120.0), (5, None, None)], "id long, title string, price double")
        old = spark.createDataFrame([(1, "a", 100.0), (2, "b", 100.0), (3, "c", 100.0), (4, "d", 1.0), (5, None, None)], "id long, title string, price double")
        got = diff.classify_stored(diff.keep_snapshot(new, "id", fields), diff.keep_snapshot(old, "id", fields), "id", fields)
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
        assert dict(got.collect()) == {1: "unchanged", 2: "unchanged", 3: "updated", 4: "missing", 5: "unchanged"} == dict(diff.classify(new, old, "id", fields).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_large_samples_are_filters(spark, monkeypatch):
    rows = spark.range(3000).withColumn("status", F.lit("active"))
    want = [r.id for r in rows.orderBy(F.md5(F.col("id").cast("string")), "id").limit(700).collect()]
    monkeypatch.setattr(stats, "SORTED", 20)
    monkeypatch.setattr(stats, "HASH_DIGITS", 1)
    got = stats.hash_sample(rows, "id", 700)
    assert sorted(r.id for r in got.collect()) == sorted(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("SinglePartition", "TakeOrdered", "Limit", "Exchange"))
    assert stats.hash_sample(rows, "id", 5000).count() == 3000 and stats.sample_percent(rows, "id", 10).count() == 300
    assert stats.hash_sample(rows.withColumn("id", F.col("id") % 3), "id", 900).count() == 1000


def brute(rows, title, address, metres):
    import math
    import re

    def grams(x):
        return {f"  {w} "[i : i + 3] for w in filter(None, re.split(r"[\W_]+", (x or "").lower())) for i in range(len(w) + 1)}

    def share(x, y):
        a, b = grams(x), grams(y)
        return len(a & b) / len(a | b) if a | b else 0.0

    def far(a, b):
        la, lb = math.radians(a[3]), math.radians(b[3])
        h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(math.radians(b[4] - a[4]) / 2) ** 2
        return 2 * search.EARTH_M * math.asin(math.sqrt(h))

    once = {}
    for r in rows:
        if r[3] is not None and r[4] is not None:
            once[r[1:]] = min(r[0], once.get(r[1:], r[0]))
    reps = [(i, *x) for x, i in once.items()]
    return {(min(a[0], b[0]), max(a[0], b[0])) for k, a in enumerate(reps) for b in reps[:k] if far(a, b) < metres and share(a[1], b[1]) > title and share(a[2], b[2]) > address}


SCHEMA = "id long, title string, address string, lat double, lng double"


@pytest.mark.parametrize(("title", "address"), [(0.8, 0.7), (0.5, 0.2)])
def test_fuzzy_against_brute_force(spark, title, address):
    rng = random.Random(6)
    words = "casa grande azul con patio en centro 3 recámaras toluca nueva".split()
    bases = [" ".join(rng.choices(words, k=6)) for _ in range(8)]
    text = lambda: rng.choice([None, "", "!"]) if rng.random() < 0.05 else rng.choice(bases) + rng.choice(["", "s", " uno", "!", " ya ya"])
    rows = [(i, text(), rng.choice(["calle 5", "calle 55", "av. juárez 3", None]), rng.choice([None, 19.0, 19.0005, 19.001, -0.0003, 89.9999]), rng.choice([-99.0, -99.0004, 0.0002, 179.9999, -179.9999])) for i in range(260)]
    rows += [(1000 + i, *rows[i][1:]) for i in range(40)]
    got = {tuple(r) for r in search.fuzzy_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), title, address).collect()}
    assert got == brute(rows, title, address, 100) and got


def test_many_listings_at_one_point_meet_few_others(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7))
    n = 1500
    rows = [(i, " ".join(word() for _ in range(5)), "calle", 19.4, -99.1) for i in range(n // 3)] + [(i, "casa " + word(), "calle", rng.uniform(10, 30), -99.0) for i in range(n // 3, n)]
    rows += [(n + i, rows[i][1] + "s", "calle", 19.4, -99.1) for i in range(20)]
    frame = spark.createDataFrame(rows, SCHEMA)
    pairs = search.candidate_pairs(frame, 0.8, 100).count()
    assert search.fuzzy_duplicates(frame).count() == 20 and 20 <= pairs < (n / 3) ** 2 / 2 / 100
