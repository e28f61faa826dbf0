"""Listing cards and detail pages out of HTML at rest: one pass over each page reads the tags that a schema names, columns do the rest."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions import identity, text
from larkspur.operators.diff import one_each

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_STEP = re.compile(r"^([a-z0-9]+)?((?:\.[\w-]+)*)((?:\[[^\]]+\])*)$")
_TEST = re.compile(r"\[([\w-]+)(?:(\*?)=['\"]?([^'\"\]]*)['\"]?)?\]")


@dataclass(frozen=True)
class Field:
    """``where``: selectors, comma-separated, of tags, .classes and [attributes], with blanks between ancestors and
    descendants; '' is the record's own element. ``take``: the first attribute that is there, or nothing for the text."""

    name: str
    where: str
    take: tuple[str, ...] = ()
    many: bool = False
    join: str = ""


@dataclass(frozen=True)
class Schema:
    """Records are the elements that ``card`` selects; '' is the whole page."""

    name: str
    card: str
    fields: tuple[Field, ...]

    def spark_type(self) -> T.ArrayType:
        return T.ArrayType(T.StructType([T.StructField(f.name, T.ArrayType(T.StringType()) if f.many else T.StringType()) for f in self.fields]))

    def arrow_type(self) -> pa.DataType:
        return pa.list_(pa.struct([(f.name, pa.list_(pa.string()) if f.many else pa.string()) for f in self.fields]))


# The classes of a result list, of a manifest's list and of a detail page.
CARDS = Schema("cards", "li.property__component", (
    Field("title", ".title"), Field("price", "li.price"), Field("location", ".location"), Field("link", "a", ("href",)),
    Field("image", ".property__media img", ("src", "data-src")), Field("lat", "", ("data-lat",)), Field("lng", "", ("data-long",)),
    Field("features", ".features"), Field("parts", ".features div", many=True),
    Field("published", ".published, .date, [class*='published'], [class*='date']"),
    Field("agent", ".agent, .contact, [class*='agent'], [class*='contact']"),
    Field("message", "a[href*='message'], a[href*='contact'], .message-btn, .contact-btn", ("href",)),
))
MANIFEST = Schema("cards", CARDS.card, tuple(f for f in CARDS.fields if f.name in ("title", "price", "link", "lat", "lng")))
PAGE = Schema("page", "", (
    Field("title", "h1"), Field("description", ".text-description", join=" "), Field("location", ".map-address-info"),
    Field("kind", "h2.location"), Field("map", ".map-container div[data-lazy-iframe-url]", ("data-lazy-iframe-url",)),
    Field("price", "div.listing__price div.price div.digits"), Field("operation", "div.listing__price div.price div.operation-type"),
    Field("images", "div.property__gallery div.picture img", ("src", "data-src"), many=True),
    Field("agent", ".publisher-name"), Field("agency", ".publisher-organization-name"), Field("phones", ".publisher-phones", many=True),
    Field("listing_id", ".listing-id span"),
))
ICONS = Schema("icons", "div.listing__features div.feature-icon", (Field("icon", "i", ("class",)), Field("value", "", join="|")))
AMENITY_GROUPS = Schema("groups", "div.listing__amenities div.amenities-group", (
    Field("title", "div.amenities-group-title"), Field("items", "div.amenities-list li span", many=True),
))
# The classes of another site's cards.
OTHER_SITE = Schema("cards", ".posting-card, .property-card, article[data-qa='posting PROPERTY']", (
    Field("title", "h2, .posting-title, .property-title"), Field("price", ".price, .posting-price, .property-price"),
    Field("location", ".location, .posting-location, .property-location"), Field("details", ".details, .posting-details, .property-details"),
    Field("link", "a", ("href",)), Field("image", "img", ("src",)), Field("bedrooms", ".bedrooms, .rooms"), Field("bathrooms", ".bathrooms, .baths"),
    Field("area", ".area, .surface"), Field("property_type", ".property-type, .type"),
))


def _selectors(where: str) -> list[list[tuple]]:
    out = []
    for part in filter(None, map(str.strip, where.split(","))):
        steps = []
        for step in re.findall(r"(?:[^\s\[]|\[[^\]]*\])+", part):
            tag, classes, tests = _STEP.match(step).groups()
            steps.append((tag, frozenset(filter(None, classes.split("."))), tuple(_TEST.findall(tests))))
        out.append(steps)
    return out


# What a page is made of: comments and other marks, end tags, and start tags with their attributes. Quotes count after = only; what isn't
# closed goes to the end of the page, so that no character is looked at again and again.
_MARK = re.compile(
    r"""<(?:!--.*?(?:-->|(\Z))|[!?][^>]*(?:>|(\Z))|/([a-zA-Z][^\s/>]*)[^>]*(?:>|(\Z))|([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+)(?:>|(\Z)))""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
#: References end with a semicolon: what only looks like one, as &copy= in an address or a text that was cut off, stays as it is.
_REFERENCE = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|([a-zA-Z][a-zA-Z0-9]*));")
_RAW_END = {tag: re.compile(f"</{tag}", re.I) for tag in ("script", "style")}
#: Pages whose records a task holds at once.
_AT_ONCE = 64
#: Tags with their attributes that a reader remembers, and the longest attributes that it does.
_REMEMBERED, _LONGEST = 20_000, 200


def _unescaped(x: str) -> str:
    return _REFERENCE.sub(lambda m: unescape(m[0]) if m[1] is None or f"{m[1]};" in html5 else m[0], x) if "&" in x else x


class Reader:
    """Records of several schemas in one pass over a page.

    The steps of all selectors are bits of one automaton: of each open element a number tells which steps it and its ancestors
    have reached, so that a tag costs a few operations on integers, whatever the number of fields; tags that no step names
    aren't looked at any closer. Any text is read, without an error: marked sections are skipped, end tags that close
    nothing are ignored, and what a page cuts off inside a tag is left out.
    """

    def __init__(self, schemas: tuple[Schema, ...]):
        self.schemas, self.steps, self.start, self.last = schemas, [], 0, 0
        self.selected: list[tuple[int, tuple]] = []  # bits of last steps, and whose they are: (schema, field or None)
        for s in schemas:
            for f in (None, *s.fields):
                ends = 0
                for steps in _selectors(s.card if f is None else f.where):
                    self.start |= 1 << len(self.steps)
                    self.steps += steps
                    ends |= 1 << (len(self.steps) - 1)
                if ends:
                    self.selected.append((ends, (s, f)))
                    self.last |= ends
        self.plain = {tag for tag, classes, tests in self.steps if not classes and not tests}
        names = {c for _, classes, _ in self.steps for c in classes} | {n for _, _, tests in self.steps for n, *_ in tests}
        self.named = re.compile("|".join(map(re.escape, sorted(names))) or r"(?!)", re.I)
        self.known: dict[tuple[str, str], tuple[int, dict]] = {}
        self.actions: dict[int, list[tuple]] = {}

    def _look(self, tag: str, raw: str) -> tuple[int, dict]:
        """The bits of the steps that an element of its own fits, and its attributes."""
        if tag not in self.plain and "&" not in raw and not self.named.search(raw):
            return self._keep(tag, raw, 0, {})
        attrs: dict[str, str] = {}
        for name, *values in _ATTRIBUTE.findall(raw):
            value = next(filter(None, values), "")
            attrs.setdefault(name.lower(), _unescaped(value))
        own, bits = frozenset(attrs.get("class", "").split()), 0
        for i, (name, classes, tests) in enumerate(self.steps):
            if (name is None or name == tag) and classes <= own and all(n in attrs and (not v or (v in attrs[n] if part else v == attrs[n])) for n, part, v in tests):
                bits |= 1 << i
        return self._keep(tag, raw, bits, attrs)

    def _keep(self, tag: str, raw: str, bits: int, attrs: dict) -> tuple[int, dict]:
        if len(raw) <= _LONGEST:
            if len(self.known) >= _REMEMBERED:
                self.known.clear()
            self.known[tag, raw] = bits, attrs
        return bits, attrs

    def read(self, html: str | None) -> dict:
        """The records of each schema by its name, and ``cut``: whether the page ends inside a tag or a comment."""
        html = html or ""
        found = {s.name: [] for s in self.schemas}
        stack: list[tuple[str, int]] = []
        tags: dict[str, int] = defaultdict(int)
        self.open, self.texts = [], []  # records and texts of open elements with their depth
        for s in self.schemas:
            if not s.card:
                self._record(found, s, 0, {})
        at, reached, cut, known = 0, 0, False, self.known
        while m := _MARK.search(html, at):
            start = m.start()
            if self.texts and start > at:
                self._say(html[at:start])
            at = m.end()
            kind = m.lastindex
            if kind == 6:
                tag, raw = m.group(5, 6)
                tag = tag.lower()
                seen = known.get((tag, raw))
                bits, attrs = self._look(tag, raw) if seen is None else seen
                hit = bits & (reached << 1 | self.start)
                stack.append((tag, reached))
                tags[tag] += 1
                reached |= hit
                if hit & self.last:
                    self._act(found, hit & self.last, len(stack), attrs)
                if tag in VOID or raw.endswith("/"):
                    reached = self._leave(stack, tags)
                elif tag in _RAW_END:
                    end = _RAW_END[tag].search(html, at)
                    stop = end.start() if end else len(html)
                    if self.texts and stop > at:
                        self._say(html[at:stop], False)
                    at = stop
            elif kind == 3:
                tag = m[3].lower()
                if tags[tag]:
                    while stack[-1][0] != tag:
                        reached = self._leave(stack, tags)
                    reached = self._leave(stack, tags)
            elif kind is not None:
                cut = True
        if self.texts and at < len(html):
            self._say(html[at:])
        for records_ in found.values():
            for r in records_:
                for k, v in r.items():
                    if isinstance(v, _Text):
                        r[k] = v.value()
                    elif isinstance(v, list):
                        r[k] = [y for y in (x.value() if isinstance(x, _Text) else x for x in v) if y]
        return found | {"cut": cut}

    def _act(self, found: dict, hit: int, depth: int, attrs: dict) -> None:
        """Fields of the records that are open already, then new records."""
        if hit not in self.actions:
            self.actions[hit] = [what for ends, what in self.selected if ends & hit]
        for s, f in self.actions[hit]:
            if f is not None:
                for _, owner, record, done in self.open:
                    if owner is s and f.name not in done:
                        if not f.many:
                            done.add(f.name)
                        self._take(record, f, depth, attrs)
        for s, f in self.actions[hit]:
            if f is None:
                self._record(found, s, depth, attrs)

    def _record(self, found: dict, schema: Schema, depth: int, attrs: dict) -> None:
        record = {f.name: [] if f.many else None for f in schema.fields}
        found[schema.name].append(record)
        self.open.append((depth, schema, record, set()))
        for f in schema.fields:
            if schema.card and not f.where:
                self._take(record, f, depth, attrs)

    def _take(self, record: dict, f: Field, depth: int, attrs: dict) -> None:
        if f.take:
            value = next((attrs[a] for a in f.take if attrs.get(a)), None)
        else:
            value = _Text(f.join)
            self.texts.append((depth, value))
        if f.many:
            record[f.name].append(value)
        else:
            record[f.name] = value

    def _leave(self, stack: list, tags: dict) -> int:
        tag, reached = stack.pop()
        tags[tag] -= 1
        n = len(stack)
        while self.texts and self.texts[-1][0] > n:
            self.texts.pop()
        while self.open and self.open[-1][0] > n:
            self.open.pop()
        return reached

    def _say(self, data: str, escaped: bool = True) -> None:
        data = _unescaped(data) if escaped else data
        for _, x in self.texts:
            x.parts.append(data)


class _Text:
    """Text nodes of an element, trimmed and joined."""

    def __init__(self, join: str):
        self.join, self.parts = join, []

    def value(self) -> str | None:
        return self.join.join(filter(None, map(str.strip, self.parts))) or None


def records(pages: DataFrame, *schemas: Schema) -> DataFrame:
    """``pages`` without ``html``, with an array of records for each schema under its name and ``cut``, in one pass over each page.

    A page without text has no records; a page that ends inside a tag keeps what was read and is ``cut``. The pass is a
    relation of its own, which no filter above it runs twice.
    """
    kept = [c for c in pages.columns if c != "html"]
    more = [T.StructField(s.name, s.spark_type()) for s in schemas] + [T.StructField("cut", T.BooleanType())]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(schemas)
        for b in (whole.slice(i, _AT_ONCE) for whole in batches for i in range(0, whole.num_rows, _AT_ONCE)):
            found = [reader.read(x.as_py()) for x in b.column("html")]
            arrays = [pa.array([x[s.name] for x in found], s.arrow_type()) for s in schemas] + [pa.array([x["cut"] for x in found], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], *arrays], names=[*kept, *[f.name for f in more]])

    return pages.select(*kept, "html").mapInArrow(parse, T.StructType([*pages.select(*kept).schema.fields, *more]))


def listing_cards(pages: DataFrame, schema: Schema = CARDS) -> DataFrame:
    """(page_id, url, fields) of each card that has a title and a link."""
    cards = records(pages.select("page_id", "url", "html"), schema).select("page_id", "url", F.explode(schema.name).alias("card"))
    return cards.select("page_id", "url", "card.*").where("title IS NOT NULL AND link IS NOT NULL")


def _last(items: Column) -> Column:
    return F.try_element_at(items, F.lit(-1))


def staging_rows(cards: DataFrame, base: str, now: Column, operation: Column | None = None, prefix: str = "") -> DataFrame:
    """Typed records of cards: one row for each, with page_id. ``operation``: the type that the source is known for."""
    link = identity.absolute_url(F.lit(base), F.col("link"))
    parts = F.transform("parts", F.lower)
    beds, baths = (lambda x: x.contains("bedroom")), (lambda x: x.contains("bathroom"))
    count = lambda c: F.nullif(text.first_number(c), F.lit(0)).cast("int")
    lat, lng = F.col("lat").try_cast("double"), F.col("lng").try_cast("double")
    both = lat.isNotNull() & lng.isNotNull()
    sale = F.when(F.lower("price").contains("for sale"), "For Sale").when(F.lower("price").contains("for rent"), "For Rent")
    title = text.clean_text(F.col("title"))
    kind = text.operation_type(sale) if operation is None else operation
    return cards.select(
        "page_id", identity.property_id(link, prefix).alias("property_id"), title.alias("title"), link.alias("source_url"), F.col("image").alias("main_image_url"),
        text.price_amount(F.col("price")).alias("price"), text.price_currency(F.coalesce("price", F.lit(""))).alias("currency"), text.location(F.col("location")).alias("place"),
        count(_last(F.filter(parts, beds))).alias("bedrooms"), count(_last(F.filter(parts, lambda x: ~beds(x) & baths(x)))).alias("bathrooms"),
        F.nullif(text.area(_last(F.filter(parts, lambda x: ~beds(x) & ~baths(x) & x.contains("m²")))), F.lit(0.0)).alias("total_area_m2"),
        F.when(both, lat).alias("latitude"), F.when(both, lng).alias("longitude"),
        text.property_type(F.concat(title, F.lit(" "))).alias("property_type"), kind.alias("operation_type"),
        text.agent_names(F.col("agent")).alias("contact"), text.agent_email(F.col("agent")).alias("agent_email"), text.agent_phone(F.col("agent")).alias("agent_phone"),
        text.listing_date(F.col("published"), now).alias("listing_date"), identity.absolute_url(F.lit(base), F.col("message")).alias("message_url"),
        text.feature_keywords(F.lower("features")).alias("features"), now.alias("scraped_at"),
    ).select("*", "place.*", "contact.*").drop("place", "contact")


# Words of the detail page and what they stand for.
KINDS = {"departamento": "apartment", "casa": "house", "terreno": "lot", "lote": "lot"}
DEALS = {"venta": "sale", "renta": "rent", "sale": "sale", "rent": "rent"}
GROUP_NAMES = {"Exterior": "exterior", "General": "general", "Políticas": "policies", "Recreación": "recreation"}
ICON_OF = {
    "bedrooms": "fa-bed", "bathrooms": "fa-bath", "parking_spaces": "fa-car", "covered_area_m2": "fa-cube", "total_area_m2": "fa-expand",
    "floor_number": "fa-building", "construction_year": "fa-calendar",
}
_READ = {"covered_area_m2": (r"(\d+(?:\.\d+)?)", "double"), "total_area_m2": (r"(\d+(?:\.\d+)?)", "double"), "construction_year": (r"(\d{4})", "int")}


def _named(value: Column, names: dict[str, str]) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), value), value)


def _icon(name: str) -> Column:
    """The value beside the last icon of a kind that can be read; an icon counts for the first kind that its classes name."""
    kinds = list(ICON_OF)
    earlier = [ICON_OF[k] for k in kinds[: kinds.index(name)]]

    def own(x: Column) -> Column:
        hit = F.coalesce(x["icon"].contains(ICON_OF[name]), F.lit(False))
        for e in earlier:
            hit = hit & ~x["icon"].contains(e)
        return hit

    def value(x: Column) -> Column:
        said = F.try_element_at(F.split(x["value"], r"\|"), F.lit(2))
        pattern, kind = _READ.get(name, (r"^\s*([-+]?\d+)\s*$", "int"))
        return F.nullif(F.regexp_extract(said, pattern, 1), F.lit("")).try_cast(kind)

    return _last(F.array_compact(F.transform(F.filter("icons", own), value)))


def detail_records(pages: DataFrame, site: str = "") -> DataFrame:
    """One typed record for each detail page: what its tags say, null where they say nothing. ``pages``: page_id, url, html."""
    rows = records(pages.select("page_id", "url", "html"), PAGE, ICONS, AMENITY_GROUPS).withColumn("p", F.element_at("page", 1)).drop("page")
    f = lambda n: F.col(f"p.{n}")
    kind = F.lower(F.element_at(F.split(f("kind"), r"\s+"), 1))
    center = F.split(F.try_url_decode(F.nullif(F.regexp_extract(f("map"), r"[?&]q=([^&#]*)", 1), F.lit(""))), ",")
    lat, lng = (F.try_element_at(center, F.lit(i)).try_cast("double") for i in (1, 2))
    placed = (F.size(center) == 2) & lat.isNotNull() & lng.isNotNull()
    amount = F.trim(F.regexp_replace(F.regexp_replace(f("price"), r"US\$", ""), r"[,$]", "")).try_cast("double")
    images = F.array_distinct(
        F.transform(
            F.filter(f("images"), lambda x: ~x.contains("placeholder")),
            lambda x: F.when(x.startswith("//"), F.concat(F.lit("https:"), x)).when(x.startswith("/"), F.concat(F.lit(site), x)).otherwise(x),
        )
    )
    entries = F.filter(
        F.transform("groups", lambda g: F.struct(F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in GROUP_NAMES.items() for x in kv]), g["title"]), F.lower(g["title"])).alias("key"), g["items"].alias("value"))),
        lambda e: e["key"].isNotNull() & (F.size(e["value"]) > 0),
    )
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries) + 1), lambda x: x["key"] == e["key"]))
    cleaned = lambda c: F.when(c.isNotNull(), text.clean_text(c))
    out = rows.select(
        "page_id", "url", cleaned(f("title")).alias("title"), cleaned(f("description")).alias("description"),
        F.when(f("location").isNotNull(), text.location(f("location"))).alias("place"), _named(kind, KINDS).alias("property_type"),
        F.when(placed, lat).alias("latitude"), F.when(placed, lng).alias("longitude"),
        amount.alias("price"), F.when(amount.isNotNull(), F.when(f("price").contains("US$"), "USD").otherwise("MXN")).alias("currency"),
        _named(F.lower(F.regexp_replace(f("operation"), "En ", "")), DEALS).alias("operation_type"), *[_icon(n).alias(n) for n in ICON_OF],
        F.when(F.size(last) > 0, F.map_from_entries(last)).alias("amenities"), F.when(F.size(images) > 0, images).alias("image_urls"), F.try_element_at(images, F.lit(1)).alias("main_image_url"),
        cleaned(f("agent")).alias("agent_name"), cleaned(f("agency")).alias("agency_name"), F.try_element_at(f("phones"), F.lit(1)).alias("agent_phone"), f("listing_id").alias("listing_id"),
    )
    return out.select("*", "place.*").drop("place")


def nested_json(details: DataFrame) -> DataFrame:
    """(page_id, document): a detail record as one nested JSON document; absent numbers are 0, absent text is empty."""
    s = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    n = lambda c: F.coalesce(c, F.lit(0))
    title = s("title")
    document = F.struct(
        F.trim(F.regexp_replace(s("listing_id"), "ID: ", "")).alias("id"), title.alias("title"), text.presale(title).cast("int").alias("presale"), n("price").alias("price"), s("operation_type").alias("operation"),
        s("property_type").alias("type"), F.struct(s("address").alias("address"), "latitude", "longitude").alias("place"),
        F.struct(*[n(c).alias(c) for c in ICON_OF if c != "construction_year"], "construction_year").alias("features"),
        F.coalesce("image_urls", F.array().cast("array<string>")).alias("images"), F.struct(s("agent_name").alias("name"), s("agency_name").alias("organization")).alias("publisher"),
        "url", s("description").alias("description"),
    )
    return details.select("page_id", F.to_json(document).alias("document"))


def html_title(html):
    return F.nullif(F.regexp_extract(html, r"<title>([^<]*)</title>", 1), F.lit(""))


def link_count(html):
    return F.regexp_count(html, F.lit('<a href="'))


def page_total(html):
    """Pages of a result list: 'Page i of n' of its summary, else the highest number among its pager links and their texts, else 100."""
    said = F.regexp_extract(html, r"(?is)class=[\"']pagination-summary[\"'][^>]*>[^<]*Page\s+\d+\s+of\s+([\d,]+)", 1)
    links = F.flatten(F.transform(F.regexp_extract_all(html, F.lit(r"(?s)class=[\"'](?:pagination|pager)[\"'](.*?)</(?:div|ul|nav)>"), F.lit(1)), lambda x: F.regexp_extract_all(x, F.lit(r"page=(\d+)|>\s*(\d+)\s*</a>"), F.lit(0))))
    most = F.array_max(F.transform(links, lambda x: F.regexp_replace(x, r"\D", "").try_cast("int")))
    return F.coalesce(F.nullif(F.regexp_replace(said, ",", ""), F.lit("")).try_cast("int"), F.when(most > 1, most), F.lit(100))


def overlay(cards: DataFrame, details: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Details over cards, field by field; a missing detail keeps the card's value. A key has one detail."""
    d = one_each(details.select(key, *fields), key).select(key, *[F.col(f).alias(f"d_{f}") for f in fields])
    return cards.join(d, key, "left").select(*[c for c in cards.columns if c not in fields], *[F.coalesce(f"d_{f}", f).alias(f) for f in fields])
