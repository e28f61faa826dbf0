"""Test tables in the shapes of the feed: the listings, snapshots, queue and runs that the queries work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns_of(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table, column, type, nullable, position) of the given tables: a row for each column."""
    rows = [(name, f.name, f.dataType.simpleString(), f.nullable, i) for name, df in tables.items() for i, f in enumerate(df.schema, 1)]
    return spark.createDataFrame(rows, "table string, column string, type string, nullable boolean, position int")


def keys_of(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, column, rows, nulls, distinct, is_key) of each column, by reading the rows: a column whose values are all there and all
    different identifies the rows. Values are counted by column and value in one pass over a table, hot ones combined before the shuffle."""
    out = None
    for name, df in tables.items():
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in df.columns])
        values = df.select(F.inline(pairs)).groupBy("column", "v").agg(F.count("*").alias("n"))
        found = values.groupBy("column").agg(F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"), F.count("v").alias("distinct"))
        found = found.select(F.lit(name).alias("table"), "column", "rows", "nulls", "distinct", (F.col("distinct") == F.col("rows")).alias("is_key"))
        out = found if out is None else out.unionByName(found)
    return out


def references_of(tables: dict[str, DataFrame], pairs: list[tuple[str, str, str, str]]) -> DataFrame:
    """(table, column, target, target_column, values, missing, holds): how many different values of a column the other table's
    column lacks; a reference holds if it lacks none."""
    out = None
    for name, column, target, key in pairs:
        values = tables[name].select(F.col(column).alias("k")).where("k IS NOT NULL").distinct()
        there = tables[target].select(F.col(key).alias("k"), F.lit(True).alias("there")).distinct()
        missing = F.count_if(F.col("there").isNull())
        found = values.join(there, "k", "left").agg(F.count("*").alias("values"), missing.alias("missing"), (missing == 0).alias("holds"))
        found = found.select(*[F.lit(v).alias(c) for c, v in zip(("table", "column", "target", "target_column"), (name, column, target, key))], "values", "missing", "holds")
        out = found if out is None else out.unionByName(found)
    return out


def markdown(columns: DataFrame) -> DataFrame:
    """(table, document): the columns of each table as a Markdown table."""
    lines = F.array_sort(F.collect_list(F.struct("position", F.concat(F.lit("| "), "column", F.lit(" | "), "type", F.lit(" |")).alias("line"))))
    body = F.transform(lines, lambda x: x["line"])
    return columns.groupBy("table").agg(F.array_join(F.concat(F.array(F.lit("| Column | Type |"), F.lit("| --- | --- |")), body), "\n").alias("document"))


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_retailprice").alias("price"),
        F.col("p_type").alias("property_type"), F.col("p_brand").alias("city"), F.col("p_size").alias("bedrooms"),
        F.when(F.col("p_partkey") % 17 == 0, "inactive").otherwise("active").alias("status"),
        (F.col("p_partkey") % 4).cast("int").alias("misses"),
        F.date_sub(F.lit("2024-02-01").cast("date"), (F.col("p_partkey") % 40).cast("int")).alias("last_seen"),
    )


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = live(spark, sf_dir)
    price = F.when(F.col("id") % 7 == 0, F.col("price") * 1.05).when(F.col("id") % 5 == 1, F.col("price") * 1.005).otherwise(F.col("price"))
    title = F.when(F.col("id") % 11 != 0, F.col("title"))
    kept = base.where("id % 10 <> 0")
    new = base.where("id % 13 = 0").withColumn("id", F.col("id") + 1000000)
    return kept.unionByName(new).select("id", title.alias("title"), price.alias("price"), "property_type", "city", "bedrooms", F.lit("active").alias("status"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, seq, price): staging with a second row for every ninth id; the first of the two has no price."""
    base = staging(spark, sf_dir)
    return base.select("id", F.lit(1).alias("seq"), F.when(F.col("id") % 9 != 0, F.col("price")).alias("price")).unionByName(
        base.where("id % 9 = 0").select("id", F.lit(2).alias("seq"), "price")
    )


def queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("property_id"), F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.when(F.col("o_orderstatus") == "O", "pending").when(F.col("o_orderstatus") == "P", "in_progress")
        .when(F.col("o_orderkey") % 6 == 0, "failed").otherwise("completed").alias("status"),
        F.element_at(F.array(*[F.lit(x) for x in ("new", "price_change", "relisted", "stale", "sample")]), (F.col("o_orderkey") % 5 + 1).cast("int")).alias("reason"),
        F.col("o_orderdate").alias("queued_at"), (F.col("o_orderkey") % 5).cast("int").alias("attempts"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        "event_id", (F.col("event_id") % 4 + 1).cast("int").alias("tier"),
        F.when(F.col("event_type") == "error", "failed").otherwise("completed").alias("status"), F.col("ts").alias("started_at"), F.col("value").alias("duration"),
    )


#: Cards and details of listings, written into a page in front of its end: an expression of page_id that both engines read.
MARKUP = """
'<ul><li class="property__component" data-lat="19.' || CAST(page_id AS STRING) || '" data-long="-99.' || CAST(page_id AS STRING) || '"><div class="property__media"><img data-src="/img/' || CAST(page_id AS STRING)
|| '.jpg"></div><a href="/en/home/' || CAST(page_id AS STRING) || '?ref=1"><span class="title">' || CASE page_id % 3 WHEN 0 THEN 'Casa en preventa' WHEN 1 THEN 'Departamento !' ELSE 'Terreno (plano)' END
|| ' ' || CAST(page_id AS STRING) || '</span></a><span class="location">Calle ' || CAST(page_id AS STRING) || ', Centro, Toluca</span><ul><li class="price">' || CASE WHEN page_id % 2 = 0 THEN 'US$' ELSE '$' END
|| CAST(page_id AS STRING) || ',500 For ' || CASE WHEN page_id % 7 = 0 THEN 'Rent' ELSE 'Sale' END || '</li></ul><div class="features"><div>' || CAST(page_id % 5 AS STRING) || ' Bedrooms</div><div>2 bathrooms</div><div>'
|| CAST(page_id AS STRING) || '.5 m²</div></div><p class="published">Published ' || CAST(page_id % 20 + 1 AS STRING) || ' days ago</p><div class="agent-box">Published by: Ana López</div></li><!--card-->'
|| '<li class="property__component"><a href="https://other.example.com/' || CAST(page_id AS STRING) || '">' || CASE WHEN page_id % 5 = 0 THEN '' ELSE '<b class="title">Lote ' || CAST(page_id AS STRING) || '</b>' END
|| '</a><ul><li class="price">Contact</li></ul></li><!--card--></ul><div class="pagination-summary">Page 1 of ' || CAST(page_id + 1 AS STRING) || ',001</div><h2 class="location">' || CASE WHEN page_id % 2 = 0 THEN 'Casa' ELSE 'Bodega' END
|| ' en venta</h2><div class="text-description"><p>Description: Amplia</p><p>casa &amp; patio ' || CAST(page_id AS STRING) || '</p></div><div class="map-address-info">Av ' || CAST(page_id AS STRING) || ', Centro | Toluca</div>'
|| '<div class="map-container"><div data-lazy-iframe-url="https://maps.example.com/x?z=1&amp;q=19.' || CAST(page_id AS STRING) || '%2C' || CASE WHEN page_id % 11 = 0 THEN 'west' ELSE '-99.5' END || '"></div></div>'
|| '<div class="listing__price"><div class="price"><div class="digits">' || CASE WHEN page_id % 2 = 0 THEN 'US$' ELSE '$' END || CAST(page_id AS STRING) || ',000</div><div class="operation-type">En Venta</div></div></div>'
|| '<div class="listing__features"><div class="feature-icon"><i class="fal fa-bed"></i>Rec<span>' || CAST(page_id % 6 AS STRING) || '</span></div><div class="feature-icon"><i class="fal fa-expand"></i>Lot<span>' || CAST(page_id AS STRING)
|| '.25 m2</span></div></div><div class="listing__amenities"><div class="amenities-group"><div class="amenities-group-title">Recreación</div><div class="amenities-list"><ul><li><span>Alberca</span></li><li><span>Gym</span></li></ul></div></div></div>'
|| '<div class="property__gallery"><div class="picture"><img src="/a/' || CAST(page_id AS STRING) || '.jpg"></div><div class="picture"><img src="/placeholder.png"></div><div class="picture"><img data-src="//cdn.example.com/b.jpg"></div></div>'
|| '<span class="publisher-name">Ana López</span><span class="publisher-organization-name">Casas &amp; Más</span><span class="publisher-phones">686 523 ' || lpad(CAST(page_id % 10000 AS STRING), 4, '0') || '</span></body>'
"""
LISTING_HTML = f"replace(html, '</body>', {MARKUP.strip()})"


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as they are, with cards and details of a listing in them."""
    return read(spark, sf_dir, "pages").select("page_id", "url", F.expr(LISTING_HTML).alias("html"))


#: The same tables as SQL: common table expressions in front of a query.
SQL = f"""
WITH listing_pages AS (SELECT page_id, url, {LISTING_HTML} AS html FROM pages),
live AS (
  SELECT p_partkey AS id, p_name AS title, p_retailprice AS price, p_type AS property_type, p_brand AS city, p_size AS bedrooms,
         CASE WHEN p_partkey % 17 = 0 THEN 'inactive' ELSE 'active' END AS status, (p_partkey % 4)::INTEGER AS misses,
         (DATE '2024-02-01' - (p_partkey % 40)::INTEGER)::DATE AS last_seen
  FROM part
), staged AS (
  SELECT * FROM live WHERE id % 10 <> 0 UNION ALL SELECT * REPLACE (id + 1000000 AS id) FROM live WHERE id % 13 = 0
), staging AS (
  SELECT id, CASE WHEN id % 11 <> 0 THEN title END AS title,
         CASE WHEN id % 7 = 0 THEN price * 1.05::DOUBLE WHEN id % 5 = 1 THEN price * 1.005::DOUBLE ELSE price END AS price,
         property_type, city, bedrooms, 'active' AS status
  FROM staged
), manifest AS (
  SELECT id, 1 AS seq, CASE WHEN id % 9 <> 0 THEN price END AS price FROM staging
  UNION ALL SELECT id, 2, price FROM staging WHERE id % 9 = 0
), queue AS (
  SELECT o_orderkey AS id, o_custkey AS property_id, left(o_orderpriority, 1)::INTEGER AS priority,
         CASE WHEN o_orderstatus = 'O' THEN 'pending' WHEN o_orderstatus = 'P' THEN 'in_progress' WHEN o_orderkey % 6 = 0 THEN 'failed' ELSE 'completed' END AS status,
         (['new', 'price_change', 'relisted', 'stale', 'sample'])[(o_orderkey % 5 + 1)::INTEGER] AS reason,
         o_orderdate AS queued_at, (o_orderkey % 5)::INTEGER AS attempts
  FROM orders
), runs AS (
  SELECT event_id, (event_id % 4 + 1)::INTEGER AS tier, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status,
         ts AS started_at, value AS duration
  FROM events
)
"""
