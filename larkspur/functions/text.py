"""Text of listings to typed values: column expressions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the states that a location can end with.
STATES = [
    "aguascalientes", "baja california", "baja california sur", "campeche", "chiapas", "chihuahua", "coahuila", "colima",
    "durango", "guanajuato", "guerrero", "hidalgo", "jalisco", "méxico", "michoacán", "morelos", "nayarit", "nuevo león",
    "oaxaca", "puebla", "querétaro", "quintana roo", "san luis potosí", "sinaloa", "sonora", "tabasco", "tamaulipas",
    "tlaxcala", "veracruz", "yucatán", "zacatecas", "ciudad de méxico", "cdmx", "df", "estado de méxico",
]

# Feature keywords in the order of the result.
FEATURES = [
    "pool", "piscina", "gym", "gimnasio", "garden", "jardín", "elevator", "elevador", "balcony", "balcón", "terrace", "terraza",
    "security", "seguridad", "parking", "estacionamiento", "garage", "furnished", "amueblado", "air conditioning", "aire acondicionado",
]

# Property types with their keywords, first match wins.
PROPERTY_TYPES = {
    "house": ["house", "casa", "home", "villa", "chalet"],
    "apartment": ["apartment", "departamento", "depto", "condo", "condominium", "flat"],
    "lot": ["lot", "lote", "terreno", "land", "plot", "terrain"],
}

# Operation types with their keywords, first match wins.
OPERATIONS = {
    "foreclosure": ["foreclosure", "remate", "embargo", "adjudicacion", "adjudicación"],
    "new_construction": ["new_construction", "new construction", "under construction", "construccion", "construcción", "preventa", "pre-venta"],
    "rent": ["rent", "renta", "alquiler", "arrendamiento"],
    "sale": ["sale", "venta", "sell"],
}

# Amenity categories with their keywords, first category wins.
AMENITIES = {
    "exterior": [
        "covered_parking", "covered parking", "estacionamiento cubierto", "street_parking", "street parking",
        "estacionamiento en calle", "patio", "garden", "jardín", "yard", "balcony", "balcón", "terrace", "terraza", "garage", "carport",
    ],
    "general": [
        "accessibility_for_elderly", "accessibility for elderly", "accesibilidad adultos mayores", "storage_unit", "storage unit",
        "bodega", "cuarto de servicio", "laundry_room", "laundry room", "cuarto de lavado", "elevator", "elevador", "ascensor",
        "equipped_kitchen", "equipped kitchen", "cocina equipada", "study", "estudio", "office", "oficina", "24_hour_security",
        "24 hour security", "seguridad 24 horas", "furnished", "amueblado", "semi-furnished", "semi amueblado",
    ],
    "policies": ["pets_allowed", "pets allowed", "mascotas permitidas", "no_pets", "no pets", "no mascotas", "no_smoking", "no smoking", "no fumar"],
    "recreation": [
        "pool", "piscina", "swimming pool", "alberca", "playground", "área de juegos", "parque infantil", "tennis_court",
        "tennis court", "cancha de tenis", "gym", "gimnasio", "fitness center", "centro de fitness", "sauna", "spa", "jacuzzi",
        "games_room", "games room", "sala de juegos", "multipurpose_room", "multipurpose room", "salón de usos múltiples",
        "padel_courts", "padel courts", "canchas de pádel", "barbecue_area", "barbecue area", "área de asado",
    ],
}

# The characters besides word characters and white space that cleaning keeps.
KEPT = r"\-.,áéíóúüñÁÉÍÓÚÜÑ$€¢£¥₹₽₩₪₫₡"


def strip(c: Column) -> Column:
    """Without white space at either end, any Unicode white space included."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def populated(c: Column) -> Column:
    """Neither null nor blank."""
    return c.isNotNull() & (strip(c.cast("string")) != "")


def contains_any(c: Column, words: list[str]) -> Column:
    return F.lower(c).rlike("|".join(w.replace("-", "[-]") for w in words))


def clean_text(c: Column) -> Column:
    """Without a leading 'Description', runs of white space as one blank, then unusual characters removed, so that a blank
    beside one stays. Null as ''."""
    x = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?iU)^Description\s*:?\s*", "")
    x = F.regexp_replace(strip(x), r"(?U)\s+", " ")
    return F.regexp_replace(x, rf"(?U)[^\w\s{KEPT}]", "")


def first_match(c: Column, groups: dict[str, list[str]], default: str) -> Column:
    out = None
    for name, words in groups.items():
        out = F.when(contains_any(c, words), name) if out is None else out.when(contains_any(c, words), name)
    return out.otherwise(default)


def property_type(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) == "", "").otherwise(first_match(c, PROPERTY_TYPES, "house"))


def operation_type(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) == "", "sale").otherwise(first_match(c, OPERATIONS, "sale"))


def operation_from_url(url: Column) -> Column:
    return first_match(url, {"foreclosure": ["foreclosure"], "new_construction": ["new-construction", "construction"], "rent": ["rent"]}, "sale")


def feature_keywords(c: Column) -> Column:
    low = F.lower(F.coalesce(c, F.lit("")))
    return F.array_compact(F.array(*[F.when(F.contains(low, F.lit(w)), F.lit(w)) for w in FEATURES]))


def first_number(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"(\d+)", 1), F.lit("")).try_cast("long")


def area(c: Column) -> Column:
    """Square metres: the first of three notations."""
    low = F.lower(c)
    found = [F.nullif(F.regexp_extract(low, p, 1), F.lit("")) for p in (r"(\d+(?:\.\d+)?)\s*m[²2]", r"(\d+(?:\.\d+)?)\s*sq\s*m", r"(\d+(?:\.\d+)?)\s*metros")]
    return F.coalesce(*found).try_cast("double")


def price_amount(c: Column) -> Column:
    digits = F.regexp_replace(F.regexp_replace(c, ",", ""), r"[^\d.]", "")
    return F.nullif(F.regexp_extract(digits, r"(\d+(?:\.\d+)?)", 1), F.lit("")).try_cast("double")


def price_currency(c: Column) -> Column:
    """MXN unless dollars are named as US$ or USD (upper case), or euros are named."""
    up = F.upper(c)
    dollars = up.contains("USD") | up.contains("DOLLAR") | c.contains("$")
    return (
        F.when(dollars, F.when(up.contains("US$") | c.contains("USD"), "USD").otherwise("MXN"))
        .when(up.contains("EUR") | c.contains("€"), "EUR")
        .otherwise("MXN")
    )


def location(c: Column) -> Column:
    """Struct of address, neighborhood, city, state and postal_code. Five digits behind the name of a street, the first of several
    parts, are its house number; elsewhere they are the postal code."""
    said = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"[,\-|]"), strip), lambda x: x != "")
    house = lambda x, i: (i == 0) & (F.size(said) > 1) & ~x.rlike(r"^\d{5}\b")
    code = F.nullif(F.regexp_extract(F.array_join(F.filter(said, lambda x, i: ~house(x, i)), ","), r"\b(\d{5})\b", 1), F.lit(""))
    parts = F.filter(F.transform(said, lambda x, i: F.when(house(x, i), x).otherwise(strip(F.regexp_replace(x, r"\b\d{5}\b", "")))), lambda x: x != "")
    n = F.size(parts)
    part = lambda i: F.try_element_at(parts, F.lit(i))
    is_state = lambda x: contains_any(x, STATES)
    return F.struct(
        part(1).alias("address"),
        F.when(n == 2, F.when(~is_state(part(2)), part(2))).otherwise(part(2)).alias("neighborhood"),
        F.when(n == 3, F.when(~is_state(part(3)), part(3))).when(n > 3, part(3)).alias("city"),
        F.when((n == 2) & is_state(part(2)), part(2)).when((n == 3) & is_state(part(3)), part(3)).when(n > 3, part(4)).alias("state"),
        code.alias("postal_code"),
    )


#: Units of relative dates with their days; minutes and hours stay on the day of their time of day.
UNITS = {"minute": 1 / 1440, "hour": 1 / 24, "day": 1, "week": 7, "month": 30, "year": 365}


def listing_date(published: Column, scraped_at: Column) -> Column:
    """'N units ago' or 'a unit ago' before ``scraped_at``, as a date; null if the text says neither."""
    low, out = F.lower(published), None
    for unit, days in UNITS.items():
        found = F.regexp_extract(low, rf"(\d+|\ban?)\s+{unit}s?\s+ago", 1)
        n = F.when(found.rlike(r"^\d+$"), found.try_cast("int")).otherwise(1)
        at = F.timestamp_seconds(F.unix_timestamp(scraped_at) - (n * round(days * 86400)).cast("long")).cast("date")
        out = F.when(found != "", at) if out is None else out.when(found != "", at)
    return out


def amenity_groups(items: Column) -> Column:
    """Map of category to items; known items once, unknown ones in general as often as they occur, no empty category."""
    items = F.filter(F.coalesce(items, F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != ""))
    sorted_ = F.transform(items, lambda x: F.struct(x.alias("item"), first_match(x, AMENITIES, "").alias("group")))
    of = lambda name: F.transform(F.filter(sorted_, lambda x: x["group"] == name), lambda x: x["item"])
    entries = []
    for name in AMENITIES:
        own = F.array_distinct(of(name))
        entries.append(F.struct(F.lit(name).alias("key"), (F.concat(own, of("")) if name == "general" else own).alias("value")))
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: F.size(e["value"]) > 0))


# Patterns of phone numbers in the order in which their finds are listed.
PHONES = [
    r"\+\d{1,3}\s*\d{3,4}\s*\d{3,4}\s*\d{3,4}", r"\+\d{10,15}", r"\(\d{3}\)\s*\d{3}[-\s]?\d{4}", r"\d{3}[-\s]?\d{3}[-\s]?\d{4}", r"\b\d{10,15}\b",
    r"\d{3}\.\d{3}\.\d{4}",
]


def phones(c: Column) -> Column:
    """Phone candidates of ten digits or more, in the order of the patterns, each once."""
    text = F.coalesce(c, F.lit(""))
    found = F.flatten(F.array(*[F.regexp_extract_all(text, F.lit(f"({p})"), F.lit(1)) for p in PHONES]))
    return F.filter(F.array_distinct(found), lambda x: F.length(F.regexp_replace(x, r"\D", "")) >= 10)


def agent_email(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"(?U)([\w.\-]+@[\w.\-]+\.\w+)", 1), F.lit(""))


def _unlabelled(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?iU)published\s+by\s*:?\s*", ""), r"(?iU)contact\s*:?\s*", ""))


def agent_phone(c: Column) -> Column:
    """The first run of 7 to 15 digits, blanks, hyphens and brackets."""
    return F.nullif(strip(F.regexp_extract(_unlabelled(c), r"(?U)(\+?[\d\s\-()]{7,15})", 1)), F.lit(""))


def agent_names(c: Column) -> Column:
    """Struct of agent_name and agency_name by the look of the lines."""
    lines = F.filter(F.transform(F.split(_unlabelled(c), "\n"), strip), lambda x: x != "")
    one, two = F.try_element_at(lines, F.lit(1)), F.try_element_at(lines, F.lit(2))
    person = lambda x, dots: x.contains(" ") & F.regexp_replace(x, "[ .]" if dots else " ", "").rlike(r"^\p{L}+$")
    plain, short = ~one.rlike(r"(?U)[@+\d]") & (F.length(one) < 100), F.length(one) < 60
    swap = ~person(one, True) & two.isNotNull()
    return F.struct(
        F.when(two.isNull(), F.when(plain & short & person(one, False), one)).when(swap, two).otherwise(one).alias("agent_name"),
        F.when(two.isNull(), F.when(plain & ~(short & person(one, False)), one)).when(swap, one).otherwise(two).alias("agency_name"),
    )


def presale(title: Column) -> Column:
    return F.coalesce(F.upper(title).contains("PREVENTA"), F.lit(False))


def positional_similarity(a: Column, b: Column) -> Column:
    """Share of equal characters at equal places of the trimmed lower-case strings, of the longer length; 0 if both are empty."""
    a, b = F.lower(strip(a)), F.lower(strip(b))
    most = F.greatest(F.length(a), F.length(b))
    same = F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x == y), lambda x: F.coalesce(x, F.lit(False))))
    return F.when(most == 0, 0.0).otherwise(same / most)


# Frequent Spanish words that a search vector leaves out.
STOP_WORDS = [
    "a", "al", "algo", "ante", "como", "con", "contra", "cual", "cuando", "de", "del", "desde", "donde", "durante", "e", "el", "ella",
    "en", "entre", "era", "es", "esa", "ese", "eso", "esta", "este", "esto", "está", "fue", "ha", "hasta", "hay", "la", "las", "le", "les",
    "lo", "los", "me", "mi", "muy", "más", "nada", "ni", "no", "nos", "o", "otra", "otro", "para", "pero", "poco", "por", "porque", "que",
    "quien", "qué", "se", "ser", "si", "sin", "sobre", "son", "su", "sus", "sí", "también", "te", "todo", "tu", "un", "una", "uno", "y", "ya", "yo",
]


def search_tokens(*columns: Column) -> Column:
    """Distinct lower-case words of the columns together, without stop-words, sorted."""
    words = F.array_distinct(F.split(F.lower(F.concat_ws(" ", *columns)), r"[^\p{L}\p{N}]+"))
    return F.array_sort(F.array_except(words, F.array(*[F.lit(w) for w in ["", *STOP_WORDS]])))


def words_of(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def _word_trigrams(w: Column) -> Column:
    """The trigrams of a word that is padded with two blanks before and one behind, in order."""
    return F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3)))


def trigrams(c: Column) -> Column:
    """Distinct trigrams of the lower-case words."""
    return F.array_distinct(F.flatten(F.transform(words_of(c), _word_trigrams)))


def _share(x: Column, y: Column) -> Column:
    both = F.size(F.array_intersect(x, y))
    return F.coalesce(F.try_divide(both, F.size(x) + F.size(y) - both), F.lit(0.0))


def trigram_similarity(a: Column, b: Column) -> Column:
    return _share(trigrams(a), trigrams(b))


def trigram_distance(a: Column, b: Column) -> Column:
    return 1 - trigram_similarity(a, b)


def _bind(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once."""
    return F.transform(F.array(x), f)[0]


def _best_extent(a: Column, b: Column, whole: bool) -> Column:
    """The greatest share that the trigrams of ``a`` have in common with those of a run in ``b``: of whole words, or of any trigrams.

    Each trigram of ``b`` is looked up once: whether ``a`` has it, and where it stood before. From each start one pass over what follows
    counts the different and the common ones, some additions a step. A best run of any trigrams begins and ends with one that ``a`` has.
    """
    zero = F.lit(0)
    count = lambda hit: F.when(hit, 1).otherwise(0)

    def placed(v: Column) -> Column:
        def look(g: Column, k: Column) -> Column:
            back = F.array_position(F.reverse(F.slice(v["y"]["gram"], F.lit(1), k)), g["gram"]).cast("int")
            hit = F.array_contains(v["x"], g["gram"])
            ends = (g["first"], g["last"]) if whole else (hit, hit)
            return F.struct(k.alias("at"), F.when(back > 0, k - back).otherwise(-1).alias("before"), hit.alias("hit"), ends[0].alias("first"), ends[1].alias("last"))

        return F.struct(F.size(v["x"]).alias("n"), F.transform(v["y"], look).alias("items"))

    def best(v: Column) -> Column:
        def run(start: Column) -> Column:
            def step(s: Column, t: Column) -> Column:
                fresh = t["before"] < start["at"]
                d, c = s["d"] + count(fresh), s["c"] + count(fresh & t["hit"])
                return F.struct(d.alias("d"), c.alias("c"), F.when(t["last"], F.greatest(s["best"], c / (v["n"] + d - c))).otherwise(s["best"]).alias("best"))

            rest = F.slice(v["items"], start["at"] + 1, F.size(v["items"]))
            return F.aggregate(rest, F.struct(zero.alias("d"), zero.alias("c"), F.lit(0.0).alias("best")), step, lambda s: s["best"])

        return F.array_max(F.transform(F.filter(v["items"], lambda t: t["first"]), run))

    marked = lambda w: F.transform(w, lambda g, p: F.struct(g.alias("gram"), (p == 0).alias("first"), (p == F.size(w) - 1).alias("last")))
    grams = F.flatten(F.transform(F.transform(words_of(b), _word_trigrams), marked))
    return F.coalesce(_bind(_bind(F.struct(trigrams(a).alias("x"), grams.alias("y")), placed), best), F.lit(0.0))


def word_similarity(a: Column, b: Column) -> Column:
    """Similarity of ``a`` and the run of trigrams of ``b`` that is most like it."""
    return _best_extent(a, b, False)


def strict_word_similarity(a: Column, b: Column) -> Column:
    """Similarity of ``a`` and the run of whole words of ``b`` that is most like it."""
    return _best_extent(a, b, True)


def staleness_days(at: Column, now: Column) -> Column:
    """Whole days since ``at``; null stays null."""
    return F.floor((F.unix_timestamp(now) - F.unix_timestamp(at)) / 86400)
