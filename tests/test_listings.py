"""Golden values (fixed) and edge cases of the listing functions."""

import datetime

import pytest
from pyspark.sql import functions as F

from larkspur.functions import identity, significance, text
from larkspur.operators import diff, extract, merge, quality, search, stats
from larkspur.plans import workflows
from larkspur.streaming import feed


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "given,want",
    [
        ("Beautiful house in downtown area", "house"), ("Modern apartment with great view", "apartment"), ("Spacious departamento near metro", "apartment"),
        ("Large lot for sale", "lot"), ("Villa with pool", "house"), ("Terreno comercial", "lot"), ("", ""), (None, ""),
    ],
)
def test_property_type(spark, given, want):
    assert one(spark, text.property_type(F.lit(given))) == want


@pytest.mark.parametrize(
    "given,want",
    [
        ("House in Ciudad Caucel, Mérida, Yucatán 97314", ("House in Ciudad Caucel", "Mérida", None, "Yucatán", "97314")),
        ("Apartment in Valle Dorado, Tlalnepantla de Baz, Estado de México", ("Apartment in Valle Dorado", "Tlalnepantla de Baz", None, "Estado de México", None)),
        ("Condominium in Bosque Esmeralda, Atizapán de Zaragoza 52930", ("Condominium in Bosque Esmeralda", "Atizapán de Zaragoza", None, None, "52930")),
        (None, (None, None, None, None, None)),
    ],
)
def test_location(spark, given, want):
    assert tuple(one(spark, text.location(F.lit(given)))) == want


@pytest.mark.parametrize("given,want", [("DESCRIPTION: Modern villa", "Modern villa"), ("Description:Luxury condo", "Luxury condo"), ("a   b\n c", "a b c"), ("", ""), (None, "")])
def test_clean(spark, given, want):
    assert one(spark, text.clean_text(F.lit(given))) == want


@pytest.mark.parametrize("given,amount,currency", [("US$1,250,000", 1250000, "USD"), ("$3,500,000", 3500000, "MXN"), ("usd 5", 5, "MXN"), ("€900", 900, "EUR"), ("Contact", None, "MXN"), ("1.234.567", 1.234, "MXN")])
def test_price(spark, given, amount, currency):
    assert one(spark, text.price_amount(F.lit(given))) == amount
    assert one(spark, text.price_currency(F.lit(given))) == currency


@pytest.mark.parametrize("given,want", [("Published 2 hours ago", "2024-03-31"), ("Published 3 weeks ago", "2024-03-10"), ("Published a day ago", "2024-03-30"), ("Published 1 month ago", "2024-03-01"), ("Published 2 years ago", "2022-04-01"), ("now", None)])
def test_listing_date(spark, given, want):
    got = one(spark, text.listing_date(F.lit(given), F.lit("2024-03-31 12:00:00").cast("timestamp")))
    assert got == (datetime.date.fromisoformat(want) if want else None)


def test_amenities(spark):
    items = ["Covered parking", "Garden", "Elevator", "24 hour security", "Pets allowed", "Pool", "Gym", "Pool", "Sea", "Sea"]
    got = one(spark, text.amenity_groups(F.array(*[F.lit(x) for x in items])))
    assert got == {"exterior": ["Covered parking", "Garden"], "general": ["Elevator", "24 hour security", "Sea", "Sea"], "policies": ["Pets allowed"], "recreation": ["Pool", "Gym"]}


def test_identity(spark):
    same = [identity.property_id(F.lit(u)) for u in ("HTTPS://Ex.com/A/b//?q=1#f", "https://ex.com/a/b")]
    assert one(spark, same[0]) == one(spark, same[1])
    assert one(spark, identity.property_id(F.lit(None).cast("string"))) == one(spark, F.substring(F.md5(F.lit("empty")), 1, 16))
    assert one(spark, identity.absolute_url(F.lit("https://a.b/c/d"), F.lit("/e"))) == "https://a.b/e"


@pytest.mark.parametrize("field,new,old,want", [("price", 101.0, 100.0, False), ("price", 102.0, 100.0, True), ("price", 0.0, 0.0, False), ("price", 5.0, 0.0, True), ("price", None, 1.0, True), ("price", None, None, False), ("latitude", 1.00005, 1.0, False), ("latitude", 1.0002, 1.0, True)])
def test_significance(spark, field, new, old, want):
    assert one(spark, significance.differs(field, F.lit(new).cast("double"), F.lit(old).cast("double"))) is want


@pytest.mark.parametrize("old,new,want", [(1e6, 1001001.0, True), (10000.0, 10050.0, False), (10000.0, 10200.0, True), (0.0, 5.0, True), (0.0, 0.0, False)])
def test_price_flag(spark, old, new, want):
    assert one(spark, significance.flags_price(F.lit(old), F.lit(new))) is want


def test_empty_scores(spark):
    rows = spark.createDataFrame([], "id long, title string, price double")
    assert quality.overall_score(rows, quality.errors(rows, "id")).first().score == 1.0
    assert rows.agg(quality.duplicate_rate("id").alias("x")).first().x == 0.0


def test_manifest_dedup(spark):
    rows = spark.createDataFrame([(1, 1, None), (1, 2, 5.0), (2, 1, 3.0), (2, 2, 4.0)], "id long, seq int, price double")
    assert {(r.id, r.price) for r in diff.dedup_manifest(rows).collect()} == {(1, 5.0), (2, 3.0)}


def test_gate_keeps_live(spark):
    live = spark.createDataFrame([(1, "a", 5000.0, "active")], "id long, title string, price double, status string")
    bad = spark.createDataFrame([(1, None, None), (2, None, None)], "id long, title string, price double")
    out = workflows.daily_sync(bad, live, F.current_timestamp(), ["title", "price"])
    assert not out.passed and out.live.collect() == live.collect()


def test_removal(spark):
    v = lambda *a: one(spark, merge.removal_verdict(F.lit(a[0]), F.lit(a[1]), F.lit(a[2]).cast("string")))
    assert [v("", 200, None), v("u", 404, None), v("u", 301, "/search"), v("u", 301, "/home/x"), v("u", 503, None)] == ["removed", "removed", "removed", "kept", "kept"]


def test_cards_of_broken_html():
    read = lambda x: extract.Reader((extract.CARDS,)).read(x)["cards"]
    assert read(None) == [] and read("")  == [] and read("<p>no card</p></p></div>") == []
    half = read("<li class='property__component'><b>x")
    assert half[0]["title"] is None and half[0]["parts"] == []
    got = read('<li class="property__component" data-lat="1"><a href="/a"><h2 class="title">T &amp; U</h2><img src="x"><p>open</li><li class="property__component"><a href="/b"><i class="title">V</i></a></li>')
    assert [(x["title"], x["link"], x["lat"]) for x in got] == [("T & U", "/a", "1"), ("V", "/b", None)]


def test_selectors():
    schema = extract.Schema("r", "div.box[data-k='1'], article", (
        extract.Field("one", "ul li b, i"), extract.Field("all", "ul li", many=True, join=" "), extract.Field("href", "a[href*='msg']", ("href",)), extract.Field("k", "", ("data-k",)),
    ))
    html = "<div class='box'><b>no</b></div><div class='box' data-k=1><b>no</b><ul><li>x <b>y</b></li><li> z</li></ul><a href='/x'></a><a href='/msg/1'></a></div>"
    assert extract.Reader((schema,)).read(html)["r"] == [{"one": "y", "all": ["x y", "z"], "href": "/msg/1", "k": "1"}]


PHONES = [
    ("+52 686 523 1719", ["+52 686 523 1719", "686 523 1719"]), ("+526865231719", ["+526865231719", "5268652317", "526865231719"]), ("(686) 523-1719", ["(686) 523-1719"]),
    ("686.523.1719", ["686.523.1719"]), ("5266865231719", ["5266865231", "5266865231719"]), ("tel 555-0199", []), (None, []), ("", []),
]


@pytest.mark.parametrize("given,want", PHONES)
def test_phones(spark, given, want):
    assert one(spark, text.phones(F.lit(given).cast("string"))) == want


def test_unreadable_numbers_are_compared_as_text(spark):
    differs = lambda f, a, b: one(spark, significance.differs(f, F.lit(a), F.lit(b)))
    assert [differs("price", "abc", "abc"), differs("price", "abc", "1"), differs("latitude", "x", "19.5"), differs("price", "-5", "-1")] == [False, True, True, False]


def test_nested_fields_in_any_order(spark):
    a, b = (F.create_map(*[F.lit(x) for x in xs]) for xs in (("k", 1, "l", 2), ("l", 2, "k", 1)))
    assert one(spark, significance.differs("amenities", a, b, "map<string,int>")) is False
    assert one(spark, significance.differs("features", F.lit('{"b":1,"a":[2]}'), F.lit('{"a": [2], "b": 1}'), "string")) is False
    assert one(spark, significance.differs("image_urls", F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"), F.lit("a")), "array<string>")) is True


def test_confidence(spark):
    sure = lambda f, new, old: float(one(spark, significance.confidence(f, F.lit(new), F.lit(old))))
    assert [sure("price", 120.0, 100.0), sure("price_per_m2", 120.0, 100.0), sure("unknown", "a", "b"), sure("title", "abcdefghijkm", "abcdefghijkl")] == [0.95, 0.9, 0.95, 0.56]


@pytest.mark.parametrize("given,want", [("Nice house !", "Nice house "), ("a !b", "a b"), ("!", "")])
def test_clean_keeps_the_blank_beside_what_goes(spark, given, want):
    assert one(spark, text.clean_text(F.lit(given))) == want


@pytest.mark.parametrize("given,want", [
    ("Published by: Ana López\nCasas Más", ("Ana López", "Casas Más")), ("Casas 24\nAna López", ("Ana López", "Casas 24")), ("Inmobiliaria", (None, "Inmobiliaria")),
    ("Ana López", ("Ana López", None)), ("x" * 70, (None, "x" * 70)), ("a@b.mx", (None, None)), (None, (None, None)),
])
def test_agents(spark, given, want):
    assert tuple(one(spark, text.agent_names(F.lit(given).cast("string")))) == want


def test_word_similarity(spark):
    got = [round(one(spark, f(F.lit("word"), F.lit("two words"))), 6) for f in (text.trigram_similarity, text.word_similarity, text.strict_word_similarity)]
    assert got == [0.363636, 0.8, 0.571429]
    assert one(spark, text.word_similarity(F.lit("a"), F.lit(""))) == 0.0


def test_rules_fall_back(spark):
    assert quality.load_rules(None) == quality.DEFAULT_RULES and quality.load_rules(spark.range(1)) == quality.DEFAULT_RULES


def test_fuzzy(spark):
    rows = spark.createDataFrame([(1, "Casa grande azul", "Calle 5", 20.0, -100.0), (2, "Casa grande azul", "Calle 5", 20.0002, -100.0), (3, "Casa grande azul", "Calle 5", 21.0, -100.0)], "id long, title string, address string, lat double, lng double")
    assert [(r.id1, r.id2) for r in search.fuzzy_duplicates(rows).collect()] == [(1, 2)]


def test_streak(spark):
    rows = spark.createDataFrame([(1, 1, True), (1, 2, False), (1, 3, False)], "id long, session long, present boolean")
    assert stats.miss_streaks(rows).first().misses == 2


def test_feed(spark, tmp_path):
    log = spark.createDataFrame([("created", 1, "p"), ("updated", 2, "q")], "type string, id long, property_id string")
    log.write.parquet(str(tmp_path / "log"))
    seen = []
    feed.drain(feed.notifications(feed.open_log(spark, str(tmp_path / "log"), log.schema)), lambda b, n: seen.extend(r.payload for r in b.collect()), str(tmp_path / "cp"))
    assert sorted(seen) == ['{"type":"created","id":1,"property_id":"p"}', '{"type":"updated","id":2,"property_id":"q"}']
