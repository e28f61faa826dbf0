"""Spanish stems and search vectors, as column expressions.

The published suffix-stripping algorithm: regions of a word, an attached pronoun, then the longest ending of each step
where it stands in its region. Each step is bound once, so that expressions don't grow with the steps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.text import STOP_WORDS

# Vowels, and the endings of each step of the published algorithm.
VOWELS = "aeiouáéíóúü"
PRONOUNS = "me se sela selo selas selos la le lo las les los nos"
BEFORE_PRONOUNS = "iéndo ándo ár ér ír ando iendo ar er ir"
PLAIN = (
    "anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas amiento amientos imiento imientos"
)
AFTER_IC = "adora ador ación adoras adores aciones ante antes ancia ancias"
LOGY, UTION, ENCE, IDAD, IVE = "logía logías", "ución uciones", "encia encias", "idad idades", "iva ivo ivas ivos"
Y_VERBS = "ya ye yan yen yeron yendo yo yó yas yes yais yamos"
SHORT_VERBS = "en es éis emos"
VERBS = (
    "arían arías arán arás aríais aría aréis aríamos aremos ará aré erían erías erán erás eríais ería eréis eríamos eremos erá eré irían irías irán irás "
    "iríais iría iréis iríamos iremos irá iré aba ada ida ía ara iera ad ed id ase iese aste iste an aban ían aran ieran asen iesen aron ieron ado ido ando "
    "iendo ió ar er ir as abas adas idas ías aras ieras ases ieses ís áis abais íais arais ierais aseis ieseis asteis isteis ados idos amos ábamos íamos imos "
    "áramos iéramos iésemos ásemos"
)
RESIDUAL, RESIDUAL_E = "os a o á í ó", "e é"
ACCENTS = ("áéíóú", "aeiou")


def _bind(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once."""
    return F.transform(F.array(x), f)[0]


def _ending(w: Column, *lists: str) -> Column:
    """The longest of the endings that a word has, or an empty string: the leftmost match that reaches to the end."""
    return F.regexp_extract(w, f"(?:{'|'.join(' '.join(lists).split())})$", 0)


def _without(w: Column, n: Column | int) -> Column:
    return F.substring(w, F.lit(1), F.length(w) - n)


def _in(w: Column, ending: Column, start: Column) -> Column:
    """Whether an ending that is there lies in the region that begins after ``start`` characters."""
    return (ending != "") & (F.length(w) - F.length(ending) >= start)


def _after(w: Column, pattern: str) -> Column:
    """Characters up to the region that a pattern captures, or all of the word."""
    return F.length(w) - F.length(F.regexp_extract(w, pattern, 1))


def _regions(w: Column) -> Column:
    v = f"[{VOWELS}]"
    n = f"[^{VOWELS}]"
    r1 = _after(w, f"^.*?{v}{n}(.*)$")
    r2 = r1 + _after(F.substring(w, r1 + 1, F.length(w)), f"^.*?{v}{n}(.*)$")
    rv = F.when(w.rlike(f"^.{n}"), _after(w, f"^.{n}{n}*{v}(.*)$")).when(w.rlike(f"^{v}{v}"), _after(w, f"^{v}{v}+{n}(.*)$")).otherwise(F.least(F.lit(3), F.length(w)))
    return F.struct(w.alias("w"), r1.alias("r1"), r2.alias("r2"), rv.alias("rv"))


def _pronoun(s: Column) -> Column:
    """Step 0: a pronoun behind a gerund or an infinitive goes, and with it the accent that it had brought."""

    def cut(e: Column) -> Column:
        w, pronoun = s["w"], e["p"]
        left = _without(w, F.length(pronoun))
        verb = _ending(left, BEFORE_PRONOUNS)
        yendo = left.endswith("uyendo") & (F.length(left) - 5 >= s["rv"])
        plain = F.concat(_without(left, F.length(verb)), F.translate(verb, *ACCENTS))
        return F.when(_in(w, pronoun, s["rv"]) & _in(left, verb, s["rv"]), plain).when(_in(w, pronoun, s["rv"]) & yendo, left).otherwise(w)

    return _bind(F.struct(_ending(s["w"], PRONOUNS).alias("p")), cut)


def _standard(w: Column, s: Column) -> Column:
    """Step 1: endings of nouns, adjectives and adverbs."""

    def cut(e: Column) -> Column:
        r1, r2 = s["r1"], s["r2"]
        left = _without(w, F.length(e))
        fits = lambda x, start=r2: F.length(x) >= start
        more = lambda x, *tails: F.coalesce(*[F.when(x.endswith(t) & (F.length(x) - len(t) >= r2), _without(x, len(t))) for t in tails], x)
        kind = lambda names: e.isin(*names.split())
        iv = left.endswith("iv") & (F.length(left) - 2 >= r2)
        amente = F.when(iv, more(_without(left, 2), "at")).otherwise(more(left, "os", "ic", "ad"))
        return (
            F.when(e == "", w).when(e == "amente", F.when(fits(left, r1), amente).otherwise(w)).when(~fits(left), w)
            .when(kind(PLAIN), left).when(kind(AFTER_IC), more(left, "ic")).when(kind(LOGY), F.concat(left, F.lit("log"))).when(kind(UTION), F.concat(left, F.lit("u")))
            .when(kind(ENCE), F.concat(left, F.lit("ente"))).when(e == "mente", more(left, "ante", "able", "ible")).when(kind(IDAD), more(left, "abil", "ic", "iv")).otherwise(more(left, "at"))
        )

    return _bind(_ending(w, PLAIN, AFTER_IC, LOGY, UTION, ENCE, "amente mente", IDAD, IVE), cut)


def _tail(w: Column, start: Column) -> Column:
    """The part of a word that lies in a region, where the longest ending is looked for."""
    return F.substring(w, start + 1, F.length(w))


def _verb(w: Column, s: Column) -> Column:
    """Step 2: endings of verbs, those with y first."""

    def cut(e: Column) -> Column:
        y, long, short = e["y"], e["long"], e["short"]
        left = _without(w, F.length(y))
        shorter = _without(w, F.length(short))
        return (
            F.when((y != "") & left.endswith("u"), left).when(F.length(long) > F.length(short), _without(w, F.length(long)))
            .when(short != "", F.when(shorter.endswith("gu"), _without(shorter, 1)).otherwise(shorter)).otherwise(w)
        )

    tail = _tail(w, s["rv"])
    return _bind(F.struct(_ending(tail, Y_VERBS).alias("y"), _ending(tail, VERBS).alias("long"), _ending(tail, SHORT_VERBS).alias("short")), cut)


def _residual(w: Column, s: Column) -> Column:
    """Step 3: a last vowel goes, and after gu + e the u, too; then accents."""
    tail = _tail(w, s["rv"])
    left = _without(w, 1)
    e = F.when(left.endswith("gu") & (F.length(left) - 1 >= s["rv"]), _without(left, 1)).otherwise(left)
    cut = F.when(_ending(tail, RESIDUAL_E) != "", e).otherwise(_without(w, F.length(_ending(tail, RESIDUAL))))
    return F.translate(cut, *ACCENTS)


def stem(word: Column) -> Column:
    """The Spanish stem of a word in lower case; null stays null."""
    def steps(s: Column) -> Column:
        first = lambda w: _bind(_standard(w, s), lambda x: F.when(x != w, x).otherwise(_verb(w, s)))
        return _bind(_bind(_pronoun(s), first), lambda w: _residual(w, s))

    return F.when(word.isNotNull(), _bind(_regions(word), steps))


def search_vector(rows: DataFrame, id: str, *columns: str) -> DataFrame:
    """(id, token, positions): the stems of the columns together, with their sorted places from 1; stop-words have a place, but no entry.

    ``id`` tells the rows apart. Each different word is stemmed once, however often it occurs; rows without words have no entry.
    """
    words = F.filter(F.split(F.lower(F.concat_ws(" ", *columns)), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    each = rows.select(F.col(id).alias("id"), F.posexplode(words).alias("at", "word"))
    kept = each.where(~F.col("word").isin(*STOP_WORDS))
    stems = kept.select("word").distinct().withColumn("token", stem(F.col("word")))
    # dealt by row, so that what follows groups by token or by row where the words lie
    found = kept.join(stems, "word").select("id", "at", "token").repartition("id").groupBy("id", "token").agg(F.array_sort(F.collect_list(F.col("at") + 1)).alias("positions"))
    return found.select(F.col("id").alias(id), "token", "positions")
