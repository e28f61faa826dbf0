"""Tables in which ids of new listings meet live ones, events of a day's last half second, long numbers and cut references."""

import os
import random
import shutil
import time
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from larkspur.functions import text
from larkspur.operators.extract import CARDS, Reader
from larkspur.plans import registry
from tests.test_queries import DATA, canonical

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def met(tmp_path_factory):
    d = str(tmp_path_factory.mktemp("met"))
    for p in Path(DATA).glob("*.parquet"):
        shutil.copyfile(p, f"{d}/{p.name}")
    os.chmod(d, 0o755)
    con = duckdb.connect()
    out = lambda name, sql: con.execute(f"COPY ({sql}) TO '{d}/{name}.parquet' (FORMAT parquet)")
    part = f"'{DATA}/part.parquet'"
    # live listings whose ids are those of new ones: with other kinds, with other titles, and with prices whose thousandths are even
    out("part", f"""SELECT * FROM {part} UNION ALL SELECT * REPLACE (p_partkey + 1000000 AS p_partkey, p_size + 1 AS p_size) FROM {part} WHERE p_partkey % 2 = 0
        UNION ALL SELECT * REPLACE (p_partkey + 1000000 AS p_partkey, 'other' AS p_name, 925.1 AS p_retailprice) FROM {part} WHERE p_partkey % 2 = 1
        UNION ALL SELECT * REPLACE (3000000 AS p_partkey) FROM {part} WHERE p_partkey = 4""")
    out("events", f"SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN date_trunc('day', ts) + INTERVAL '86399.7 seconds' ELSE ts END AS ts) FROM '{DATA}/events.parquet'")
    out("pages", f"SELECT * REPLACE (page_id + 10000 AS page_id, replace(html, '</h1>', '&amp</h1>') AS html) FROM '{DATA}/pages.parquet'")
    for p in Path(d).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return d, con


@pytest.mark.parametrize("name", [
    "classify", "classify_stored", "updated_rows", "field_changes", "merge_live", "merge_stored", "stats_kept", "multi_source_scan", "quality_report", "dashboard",
    "detail_records", "legacy_json", "staging_rows", "manifest_cards", "word_similarity",
])
def test_same_rows_where_ids_meet(spark, met, name):
    d, con = met
    # the SQL of the report says how much advice tables with few duplicates get
    got, want = (x.drop(columns=["advice"], errors="ignore") for x in (registry.QUERIES[name](spark, d).toPandas(), con.execute(registry.ORACLES[name]).df()))
    assert canonical(got) == canonical(want)


@pytest.mark.parametrize("given,address,code", [
    ("Calle 12345, Centro, Toluca", "Calle 12345", None), ("Calle 12345, Centro 50000", "Calle 12345", "50000"), ("97314 Mérida, Yucatán", "Mérida", "97314"), ("Centro 52930", "Centro", "52930"), ("Calle 5, 50000", "Calle 5", "50000"),
])
def test_house_numbers_are_no_postal_codes(spark, given, address, code):
    got = spark.range(1).select(text.location(F.lit(given)).alias("l")).select("l.*").first()
    assert (got.address, got.postal_code) == (address, code)


def test_references_end_with_a_semicolon():
    page = '<li class="property__component"><a href="/a?x=1&copy=2"><b class="title">T &amp; U &#233; &notit; &amp</b></a></li>'
    (card,) = Reader((CARDS,)).read(page)["cards"]
    assert (card["link"], card["title"]) == ("/a?x=1&copy=2", "T & U é &notit; &amp")


def _grams(words):
    return [[f"  {w} "[i : i + 3] for i in range(len(w) + 1)] for w in words]


def _best(x, runs):
    return max((len(x & r) / len(x | r) for r in runs if x | r), default=0.0)


def test_best_runs_against_brute_force(spark):
    rng = random.Random(3)
    name = lambda: " ".join("".join(rng.choice("ab") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(0, 4)))
    rows = [(i, name(), name()) for i in range(300)] + [(300, None, "a"), (301, "a", None), (302, "", "")]
    got = {r.id: (r.w, r.s) for r in spark.createDataFrame(rows, "id int, x string, y string").select("id", text.word_similarity(F.col("x"), F.col("y")).alias("w"), text.strict_word_similarity(F.col("x"), F.col("y")).alias("s")).collect()}
    for i, a, b in rows:
        x, words = {g for w in _grams((a or "").split()) for g in w}, _grams((b or "").split())
        flat = [g for w in words for g in w]
        runs = [set(flat[i:j]) for i in range(len(flat)) for j in range(i + 1, len(flat) + 1)]
        strict = [{g for w in words[i:j] for g in w} for i in range(len(words)) for j in range(i + 1, len(words) + 1)]
        assert got[i] == pytest.approx((_best(x, runs), _best(x, strict)))


def test_long_names_take_a_step_a_run(spark):
    long = " ".join(f"w{i % 37}x{i}" for i in range(50))
    start = time.monotonic()
    rows = spark.range(16).select(text.word_similarity(F.lit(long), F.concat(F.col("id").cast("string"), F.lit(long))).alias("w"))
    assert rows.where("w > 0.9").count() == 16
    assert time.monotonic() - start < 60


def test_search_vectors_are_grouped_where_their_words_lie(spark):
    """Words meet their stems, then go to their rows once; grouping by token and by row moves nothing."""
    plan = registry.QUERIES["search_vector"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" not in plan and ", token#" not in "".join(x for x in plan.splitlines() if "Exchange" in x)
