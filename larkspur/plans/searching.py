"""Queries over stems and search vectors, and the stemmer's steps in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions import stems, text
from larkspur.plans.base import query
from larkspur.sources import tables as t


def _end(w: str, *lists: str) -> str:
    return f"regexp_extract({w}, '(?:{'|'.join(' '.join(lists).split())})$')"


def _cut(w: str, n) -> str:
    return f"left({w}, length({w}) - {n})"


def _plain(x: str) -> str:
    return f"translate({x}, '{stems.ACCENTS[0]}', '{stems.ACCENTS[1]}')"


def _more(x: str, *tails: str) -> str:
    cases = " ".join(f"WHEN suffix({x}, '{e}') AND length({x}) - {len(e)} >= r2 THEN {_cut(x, len(e))}" for e in tails)
    return f"CASE {cases} ELSE {x} END"


def _among(x: str) -> str:
    return "e IN (" + ", ".join(f"'{y}'" for y in x.split()) + ")"


def _stemmed() -> str:
    """The steps of the Spanish stemmer as tables, from words (word) to stemmed (word, token)."""
    v, n = f"[{stems.VOWELS}]", f"[^{stems.VOWELS}]"
    region = lambda w, p: f"length({w}) - length(regexp_extract({w}, '{p}', 1))"
    return f"""
r1s AS (SELECT word, word AS w, {region('word', f'^.*?{v}{n}(.*)$')} AS r1 FROM words),
r2s AS (SELECT *, r1 + {region('substr(w, r1 + 1)', f'^.*?{v}{n}(.*)$')} AS r2,
  CASE WHEN regexp_matches(w, '^.{n}') THEN {region('w', f'^.{n}{n}*{v}(.*)$')} WHEN regexp_matches(w, '^{v}{v}') THEN {region('w', f'^{v}{v}+{n}(.*)$')} ELSE least(3, length(w)) END AS rv FROM r1s),
p0 AS (SELECT *, {_end('w', stems.PRONOUNS)} AS p FROM r2s), p1 AS (SELECT *, {_cut('w', 'length(p)')} AS l FROM p0), p2 AS (SELECT *, {_end('l', stems.BEFORE_PRONOUNS)} AS b FROM p1),
s0 AS (SELECT word, r1, r2, rv, CASE WHEN p = '' OR length(l) < rv THEN w WHEN b <> '' AND length(l) - length(b) >= rv THEN {_cut('l', 'length(b)')} || {_plain('b')}
  WHEN suffix(l, 'uyendo') AND length(l) - 5 >= rv THEN l ELSE w END AS w FROM p2),
e1 AS (SELECT *, {_end('w', stems.PLAIN, stems.AFTER_IC, stems.LOGY, stems.UTION, stems.ENCE, 'amente mente', stems.IDAD, stems.IVE)} AS e FROM s0),
l1 AS (SELECT *, {_cut('w', 'length(e)')} AS l FROM e1), i1 AS (SELECT *, {_cut('l', 2)} AS iv FROM l1),
s1 AS (SELECT word, rv, w AS old, CASE WHEN e = '' OR (e = 'amente' AND length(l) < r1) OR (e <> 'amente' AND length(l) < r2) THEN w
  WHEN e = 'amente' THEN CASE WHEN suffix(l, 'iv') AND length(iv) >= r2 THEN {_more('iv', 'at')} ELSE {_more('l', 'os', 'ic', 'ad')} END
  WHEN {_among(stems.PLAIN)} THEN l WHEN {_among(stems.AFTER_IC)} THEN {_more('l', 'ic')} WHEN {_among(stems.LOGY)} THEN l || 'log' WHEN {_among(stems.UTION)} THEN l || 'u' WHEN {_among(stems.ENCE)} THEN l || 'ente'
  WHEN e = 'mente' THEN {_more('l', 'ante', 'able', 'ible')} WHEN {_among(stems.IDAD)} THEN {_more('l', 'abil', 'ic', 'iv')} ELSE {_more('l', 'at')} END AS w FROM i1),
e2 AS (SELECT *, substr(w, rv + 1) AS tail FROM s1), v2 AS (SELECT *, {_end('tail', stems.Y_VERBS)} AS y, {_end('tail', stems.VERBS)} AS long, {_end('tail', stems.SHORT_VERBS)} AS short FROM e2),
l2 AS (SELECT *, {_cut('w', 'length(short)')} AS ls FROM v2),
s2 AS (SELECT word, rv, CASE WHEN w <> old THEN w WHEN y <> '' AND suffix({_cut('w', 'length(y)')}, 'u') THEN {_cut('w', 'length(y)')} WHEN length(long) > length(short) THEN {_cut('w', 'length(long)')}
  WHEN short <> '' THEN CASE WHEN suffix(ls, 'gu') THEN {_cut('ls', 1)} ELSE ls END ELSE w END AS w FROM l2),
e3 AS (SELECT *, substr(w, rv + 1) AS tail, {_cut('w', 1)} AS l FROM s2), x3 AS (SELECT *, {_end('tail', stems.RESIDUAL)} AS x, {_end('tail', stems.RESIDUAL_E)} AS xe FROM e3),
stemmed AS (SELECT word, {_plain(f"CASE WHEN xe <> '' THEN CASE WHEN suffix(l, 'gu') AND length(l) - 1 >= rv THEN {_cut('l', 1)} ELSE l END ELSE {_cut('w', 'length(x)')} END")} AS token FROM x3)"""


@query("search_vector", rf"""
WITH listed AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(source, '') || ' ' || text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS parts FROM documents),
placed AS (SELECT doc_id, unnest(parts) AS word, generate_subscripts(parts, 1) AS at FROM listed),
kept AS (SELECT * FROM placed WHERE word NOT IN ({", ".join(f"'{w}'" for w in text.STOP_WORDS)})), words AS (SELECT DISTINCT word FROM kept), {_stemmed().lstrip()},
tokens AS (SELECT doc_id, token, string_agg("at"::VARCHAR, ',' ORDER BY "at") AS places FROM kept JOIN stemmed USING (word) GROUP BY ALL)
SELECT doc_id, count(*)::BIGINT AS tokens, md5(string_agg(token || ':' || places, ' ' ORDER BY token)) AS vector FROM tokens GROUP BY doc_id""", False)
def _(s, d):
    """Stems of the whole texts with their places, digested for each document."""
    found = stems.search_vector(t.read(s, d, "documents").select("doc_id", "source", "text"), "doc_id", "source", "text")
    entry = F.concat("token", F.lit(":"), F.array_join(F.transform("positions", lambda x: x.cast("string")), ",")).alias("e")
    said = F.array_sort(F.collect_list(F.struct("token", entry)))
    return found.groupBy("doc_id").agg(F.count("*").alias("tokens"), F.md5(F.array_join(F.transform(said, lambda x: x["e"]), " ")).alias("vector"))
