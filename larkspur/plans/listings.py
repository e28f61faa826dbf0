"""Queries over pages at rest: cards, details and records of listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions import identity, text
from larkspur.operators import extract
from larkspur.plans.base import BARE, at, query
from larkspur.sources import tables as t

BASE = "https://site.example.com/en/"

#: Each card's markup, cut out of the page's text.
_CARDS = """, cards AS (
  SELECT page_id, string_split(c, '<!--card-->')[1] AS c FROM (SELECT page_id, unnest(string_split(html, '<li class="property__component"')[2:]) AS c FROM listing_pages)
), fields AS (
  SELECT page_id, nullif(regexp_extract(c, 'class="title">([^<]*)<', 1), '') AS title, regexp_extract(c, '<a href="([^"]*)"', 1) AS link, regexp_extract(c, 'class="price">([^<]*)<', 1) AS price,
         nullif(regexp_extract(c, 'class="location">([^<]*)<', 1), '') AS location, nullif(regexp_extract(c, 'data-lat="([^"]*)"', 1), '') AS lat, nullif(regexp_extract(c, 'data-long="([^"]*)"', 1), '') AS lng,
         nullif(regexp_extract(c, '<img data-src="([^"]*)"', 1), '') AS image, nullif(regexp_extract(c, '>([0-9]+) Bedrooms<', 1), '')::INTEGER AS beds, nullif(regexp_extract(c, '>([0-9]+) bathrooms<', 1), '')::INTEGER AS baths,
         nullif(regexp_extract(c, '>([0-9.]+) m²<', 1), '')::DOUBLE AS area, nullif(regexp_extract(c, 'Published ([0-9]+) days', 1), '')::INTEGER AS days, nullif(regexp_extract(c, 'Published by: ([^<]*)<', 1), '') AS agent
  FROM cards
)"""
_KEPT = "FROM fields WHERE title IS NOT NULL AND link <> ''"
_LINK = "CASE WHEN link LIKE 'http%' THEN link ELSE 'https://site.example.com' || link END"


@query("html_cards", f"{_CARDS} SELECT page_id, title, link, price, location, image, lat, lng, agent IS NOT NULL AS has_agent {_KEPT}".replace(", cards", ", cards", 1))
def _(s, d):
    return extract.listing_cards(t.listing_pages(s, d)).select("page_id", "title", "link", "price", "location", "image", "lat", "lng", F.col("agent").isNotNull().alias("has_agent"))


@query("manifest_cards", f"""{_CARDS}
SELECT page_id, 'pr-' || left(md5({BARE.format(f"({_LINK})")}), 16) AS property_id, try_cast(nullif(regexp_extract(regexp_replace(price, '[^0-9.]', '', 'g'), '([0-9]+)', 1), '') AS DOUBLE) AS price,
       try_cast(lat AS DOUBLE) AS lat {_KEPT}""")
def _(s, d):
    link = identity.absolute_url(F.lit(BASE), F.col("link"))
    cards = extract.listing_cards(t.listing_pages(s, d), extract.MANIFEST)
    return cards.select("page_id", identity.property_id(link, "pr-").alias("property_id"), text.price_amount(F.col("price")).alias("price"), F.col("lat").try_cast("double").alias("lat"))


_TITLE = r"regexp_replace(trim(title), '[!()]', '', 'g')"


@query("staging_rows", f"""{_CARDS}
SELECT page_id, 'pr-' || left(md5({BARE.format(f"({_LINK})")}), 16) AS property_id, {_TITLE} AS title, {_LINK} AS source_url,
       try_cast(nullif(regexp_extract(regexp_replace(price, '[^0-9.]', '', 'g'), '([0-9]+)', 1), '') AS DOUBLE) AS price, CASE WHEN price LIKE '%US$%' THEN 'USD' ELSE 'MXN' END AS currency,
       coalesce(trim(string_split(location, ',')[1]), NULL) AS address, trim(string_split(location, ',')[2]) AS neighborhood, trim(string_split(location, ',')[3]) AS city,
       nullif(beds, 0) AS bedrooms, baths AS bathrooms, nullif(area, 0) AS total_area_m2, try_cast(lat AS DOUBLE) AS latitude, try_cast(lng AS DOUBLE) AS longitude,
       CASE WHEN title LIKE 'Casa%' THEN 'house' WHEN title LIKE 'Departamento%' THEN 'apartment' ELSE 'lot' END AS property_type, CASE WHEN price LIKE '%Rent%' THEN 'rent' ELSE 'sale' END AS operation_type,
       agent AS agent_name, DATE '2024-03-31' - days AS listing_date {_KEPT}""")
def _(s, d):
    rows = extract.staging_rows(extract.listing_cards(t.listing_pages(s, d)), BASE, at("2024-03-31 12:00:00"), prefix="pr-")
    return rows.select(
        "page_id", "property_id", "title", "source_url", "price", "currency", "address", "neighborhood", "city", "bedrooms", "bathrooms", "total_area_m2", "latitude", "longitude",
        "property_type", "operation_type", "agent_name", "listing_date",
    )


_ENTITY = "replace(replace(replace(replace({}, '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"')"
_CLEANED = rf"regexp_replace(regexp_replace(trim({{}}), '\s+', ' ', 'g'), '[^\p{{{{L}}}}\p{{{{M}}}}\p{{{{N}}}}\p{{{{Pc}}}}\s{text.KEPT}]', '', 'g')"
_DETAILS = f"""
, heads AS (SELECT page_id, html, regexp_extract(html, '<h1>(.*?)</h1>', 1) AS h FROM listing_pages), details AS (
  SELECT page_id, {_CLEANED.format(_ENTITY.format("h"))} AS title, 'Amplia casa  patio ' || nullif(regexp_extract(html, 'patio ([0-9]+)<', 1), '') AS description, nullif(regexp_extract(html, 'map-address-info">([^,]*),', 1), '') AS address,
         nullif(replace(lower(regexp_extract(html, '<h2 class="location">([^ ]*) ', 1)), 'casa', 'house'), '') AS property_type,
         CASE WHEN html LIKE '%2C-99.5%' THEN try_cast(regexp_extract(html, 'q=([0-9.]*)%2C', 1) AS DOUBLE) END AS latitude,
         try_cast(replace(regexp_extract(html, 'class="digits">[^0-9]*([0-9,]*)<', 1), ',', '') AS DOUBLE) AS price, CASE WHEN regexp_matches(html, 'class="digits">US') THEN 'USD' WHEN html LIKE '%class="digits">%' THEN 'MXN' END AS currency,
         try_cast(regexp_extract(html, 'Rec<span>([0-9]*)<', 1) AS INTEGER) AS bedrooms, try_cast(regexp_extract(html, 'Lot<span>([0-9.]*) ', 1) AS DOUBLE) AS total_area_m2,
         'https://site.example.com' || nullif(regexp_extract(html, 'picture"><img src="(/a/[^"]*)"', 1), '') || '|https:' || regexp_extract(html, '<img data-src="(//[^"]*)"', 1) AS images,
         nullif(regexp_extract(html, 'publisher-phones">([^<]*)<', 1), '') AS agent_phone
  FROM heads
)"""


@query("detail_records", f"""{_DETAILS}
SELECT *, CASE WHEN agent_phone IS NOT NULL THEN 'Alberca|Gym' END AS recreation, CASE WHEN agent_phone IS NOT NULL THEN 'sale' END AS operation_type, CASE WHEN agent_phone IS NOT NULL THEN 'Ana López' END AS agent_name,
       CASE WHEN agent_phone IS NOT NULL THEN 'Casas  Más' END AS agency_name FROM details""")
def _(s, d):
    rows = extract.detail_records(t.listing_pages(s, d), "https://site.example.com")
    return rows.select(
        "page_id", "title", "description", "address", "property_type", "latitude", "price", "currency", "bedrooms", "total_area_m2", F.array_join("image_urls", "|").alias("images"), "agent_phone",
        F.array_join(F.try_element_at("amenities", F.lit("recreation")), "|").alias("recreation"), "operation_type", "agent_name", "agency_name",
    )


@query("detail_overlay", f"""{_CARDS}{_DETAILS}
SELECT f.page_id, coalesce(d.price, NULL) AS price, d.bedrooms, baths AS bathrooms, d.property_type, CASE WHEN f.price LIKE '%Rent%' THEN 'rent' ELSE 'sale' END AS operation_type
FROM fields f JOIN details d USING (page_id) WHERE f.title IS NOT NULL AND lat IS NOT NULL""")
def _(s, d):
    """What the detail page says over what the card says; the operation type stays the card's."""
    pages = t.listing_pages(s, d)
    cards = extract.staging_rows(extract.listing_cards(pages).where("lat IS NOT NULL"), BASE, at())
    fields = ["price", "bedrooms", "bathrooms", "property_type"]
    return extract.overlay(cards, extract.detail_records(pages), "page_id", fields).select("page_id", *fields, "operation_type")


@query("site_cards", """
SELECT page_id, 'Loft ' || page_id AS title, CASE WHEN page_id % 2 = 0 THEN '$' ELSE '' END || page_id AS price, '/l/' || page_id AS link, (page_id % 4)::VARCHAR AS bedrooms, CASE WHEN page_id % 2 = 0 THEN 'USD' ELSE 'MXN' END AS currency FROM pages WHERE strpos(html, '</body>') > 0""", False)
def _(s, d):
    """The same reader with another site's list of fields; there every dollar sign is USD."""
    n = F.col("page_id").cast("string")
    card = F.concat(
        F.lit('<article data-qa="posting PROPERTY"><h2>Loft '), n, F.lit('</h2><a href="/l/'), n, F.lit('"></a><b class="posting-price">'), F.when(F.col("page_id") % 2 == 0, "$").otherwise(""), n,
        F.lit('</b><i class="rooms">'), (F.col("page_id") % 4).cast("string"), F.lit("</i></article></body>"),
    )
    pages = t.read(s, d, "pages").select("page_id", "url", F.replace("html", F.lit("</body>"), card).alias("html"))
    return extract.listing_cards(pages, extract.OTHER_SITE).select("page_id", "title", "price", "link", "bedrooms", F.when(F.col("price").contains("$"), "USD").otherwise("MXN").alias("currency"))


@query("legacy_json", f"""{_DETAILS}
SELECT page_id, coalesce(title, '') AS title, coalesce(price, 0) AS price, coalesce(bedrooms, 0) AS beds, coalesce(address, '') AS address, coalesce(images, '') AS images, strpos(upper(coalesce(title, '')), 'PREVENTA') > 0 AS presale FROM details""")
def _(s, d):
    doc = extract.nested_json(extract.detail_records(t.listing_pages(s, d), "https://site.example.com"))
    get = lambda p: F.get_json_object("document", p)
    images = F.array_join(F.from_json(get("$.images"), "array<string>"), "|")
    return doc.select(
        "page_id", get("$.title").alias("title"), get("$.price").cast("double").alias("price"), get("$.features.bedrooms").cast("int").alias("beds"), get("$.place.address").alias("address"),
        images.alias("images"), (get("$.presale") == "1").alias("presale"),
    )


@query("page_totals", """
SELECT page_id, coalesce(try_cast(replace(regexp_extract(html, 'pagination-summary">Page 1 of ([0-9,]+)', 1), ',', '') AS INTEGER), 100) AS summary,
       CASE WHEN page_id % 3 = 0 THEN 100 WHEN page_id % 3 = 1 THEN greatest(page_id % 50, 7) ELSE greatest(page_id % 50, 2) END::INTEGER AS pager FROM listing_pages""")
def _(s, d):
    """The total that a summary says, and on the pages without one the highest number of their pager, else 100."""
    n = (F.col("page_id") % 50).cast("string")
    pager = F.when(F.col("page_id") % 3 == 1, F.concat(F.lit('<nav class="pager"><a href="?page='), n, F.lit('">x</a><a>7</a></nav>'))).when(
        F.col("page_id") % 3 == 2, F.concat(F.lit('<div class="pagination"><a href="?q">2</a> <a href="?a"> '), n, F.lit(" </a></div>"))).otherwise("")
    both = t.listing_pages(s, d).select("page_id", "html").join(t.read(s, d, "pages").select("page_id", F.concat("html", pager).alias("plain")), "page_id")
    return both.select("page_id", extract.page_total(F.col("html")).alias("summary"), extract.page_total(F.col("plain")).alias("pager"))


@query("page_urls", """
SELECT page_id, p AS page, CASE WHEN p <= 1 THEN url WHEN strpos(url, '?') > 0 THEN url || '&page=' || p ELSE url || '?page=' || p END AS address FROM pages, range(1, 4) r(p)""", False)
def _(s, d):
    rows = t.read(s, d, "pages").select("page_id", "url", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(3).cast("long"))).alias("page"))
    return rows.select("page_id", "page", identity.page_url(F.col("url"), F.col("page")).alias("address"))


@query("absolute_urls", r"""
SELECT page_id, regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1) || '/x/' || page_id AS rooted, 'http://h/' || page_id AS whole,
       regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '') || 'y' AS relative FROM pages WHERE regexp_matches(url, '^[a-z]+://[^/?#]+/')""", False)
def _(s, d):
    n = F.col("page_id").cast("string")
    join = lambda p: identity.absolute_url(F.col("url"), p)
    rows = t.read(s, d, "pages").where(F.col("url").rlike("^[a-z]+://[^/?#]+/"))
    return rows.select("page_id", join(F.concat(F.lit("/x/"), n)).alias("rooted"), join(F.concat(F.lit("http://h/"), n)).alias("whole"), join(F.lit("y")).alias("relative"))


@query("operation_from_url", """
SELECT page_id, CASE WHEN strpos(lower(u), 'foreclosure') > 0 THEN 'foreclosure' WHEN strpos(lower(u), 'new-construction') > 0 OR strpos(lower(u), 'construction') > 0 THEN 'new_construction' WHEN strpos(lower(u), 'rent') > 0 THEN 'rent' ELSE 'sale' END AS kind
FROM (SELECT page_id, url || CASE page_id % 4 WHEN 0 THEN '/for-RENT' WHEN 1 THEN '/new-construction' WHEN 2 THEN '/foreclosure-rent' ELSE '' END AS u FROM pages)""", False)
def _(s, d):
    tail = F.when(F.col("page_id") % 4 == 0, "/for-RENT").when(F.col("page_id") % 4 == 1, "/new-construction").when(F.col("page_id") % 4 == 2, "/foreclosure-rent").otherwise("")
    return t.read(s, d, "pages").select("page_id", text.operation_from_url(F.concat("url", tail)).alias("kind"))


@query("agents", r"""
SELECT id, CASE k WHEN 0 THEN n WHEN 1 THEN n WHEN 2 THEN n END AS agent_name, CASE k WHEN 0 THEN 'Grupo ' || i WHEN 1 THEN 'Inmobiliaria' WHEN 3 THEN 'Inmobiliaria' END AS agency_name,
       nullif(regexp_extract(x, '([A-Za-z0-9_.-]+@[A-Za-z0-9_.-]+[.][A-Za-z0-9_]+)', 1), '') AS agent_email,
       nullif(trim(regexp_extract(regexp_replace(regexp_replace(x, '(?i)published\s+by\s*:?\s*', '', 'g'), '(?i)contact\s*:?\s*', '', 'g'), '([+]?[0-9\s()-]{7,15})', 1)), '') AS agent_phone
FROM (SELECT *, CASE k WHEN 0 THEN 'Published by: ' || n || chr(10) || 'Grupo ' || i || chr(10) || '+52 686 523 ' || lpad(i, 4, '0') WHEN 1 THEN 'Contact: Inmobiliaria' || chr(10) || n || chr(10) || 'a' || i || '@b.mx'
                            WHEN 2 THEN 'published by ' || n ELSE 'Inmobiliaria' END AS x
      FROM (SELECT p_partkey AS id, p_partkey % 4 AS k, p_name AS n, (p_partkey % 10000)::VARCHAR AS i FROM part))""", False)
def _(s, d):
    n, i, k = F.col("p_name"), (F.col("p_partkey") % 10000).cast("string"), F.col("p_partkey") % 4
    said = (
        F.when(k == 0, F.concat(F.lit("Published by: "), n, F.lit("\nGrupo "), i, F.lit("\n+52 686 523 "), F.lpad(i, 4, "0")))
        .when(k == 1, F.concat(F.lit("Contact: Inmobiliaria\n"), n, F.lit("\na"), i, F.lit("@b.mx"))).when(k == 2, F.concat(F.lit("published by "), n)).otherwise("Inmobiliaria")
    )
    x = t.read(s, d, "part").select(F.col("p_partkey").alias("id"), said.alias("x"))
    return x.select("id", text.agent_names(F.col("x")).alias("a"), text.agent_email(F.col("x")).alias("agent_email"), text.agent_phone(F.col("x")).alias("agent_phone")).select("id", "a.*", "agent_email", "agent_phone")
