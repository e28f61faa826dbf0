"""Language identification: script ranges narrow the candidates, Viterbi over word scores labels the spans of a text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import GOLDEN, bound_batches, mix

#: Labelled documents that a model is fitted on at most, about (picked by a hash of the id).
SAMPLE = 20_000
#: Hash buckets of the letter n-grams: the fixed size of a model for each language.
BUCKETS = 1 << 16
#: Lengths of the letter n-grams of a word with a mark at either end.
GRAMS = (1, 2, 3, 4)
#: A word speaks for a language by this many nats at most.
MOST = 4.0
#: Cost of changing the language between two words, in nats.
SWITCH = 12.0
#: Share of a language's letters from which a script counts as one of its own.
SCRIPT_SHARE = 0.01
#: Words whose scores are kept at once in a worker.
MAX_WORDS = 200_000
#: Texts whose new words are scored together.
TOGETHER = 128

# First and last code points of the letters of each script.
SCRIPTS = [
    ("latin", 0x0041, 0x024F),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x06FF),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
]

WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def script_of(letter: str) -> str:
    c = ord(letter)
    return next((name for name, first, last in SCRIPTS if first <= c <= last), "other")


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash bucket of each n-gram, word that it belongs to), word by word."""
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    code = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
    owner = np.repeat(np.arange(len(words)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(code))
    h, buckets, owners = np.zeros(len(code), np.uint64), [], []
    for i in range(max(GRAMS)):
        h[: len(code) - i] = mix(h[: len(code) - i] * GOLDEN + code[i:])
        if i + 1 in GRAMS:
            own = left > i
            buckets.append((h[own] % np.uint64(BUCKETS)).astype(np.int64))
            owners.append(owner[own])
    return np.concatenate(buckets), np.concatenate(owners)


@dataclass
class Model:
    langs: list[str]
    #: Log odds of each bucket for each language against the mean of all.
    weights: np.ndarray
    #: Script -> the languages that are written in it.
    scripts: dict[str, np.ndarray]
    #: The language with the most training letters; answers where no word speaks.
    usual: int


def held_out(doc_id="doc_id"):
    """Whether crc32 of the id as text leaves 1 when divided by 3; such documents are never learned from."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "utf-8")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits on about ``sample`` documents that are not held out and have a lang, a text and an id.

    Rows whose lang, text or id is null teach nothing, repeated rows count as often as they occur, and of two languages with
    equally many letters the smaller name is the usual one. Counts of (script, bucket, lang) are summed and packed on the
    executors; the driver gets one row of 8 * BUCKETS bytes for each language.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    bound_batches(docs.sparkSession)
    n = known.select("doc_id").count()
    if n > sample:
        known = known.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(9)), F.lit(1 << 30)) < int((1 << 30) * sample / n))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams: dict[str, np.ndarray] = {}
        scripts: dict[tuple[str, str], int] = {}
        for b in batches:
            for text, lang in zip(b["text"], b["lang"]):
                words = WORDS.findall(text.lower())
                to = grams.setdefault(lang, np.zeros(BUCKETS, np.int64))
                if words:
                    to += np.bincount(grams_of(words)[0], minlength=BUCKETS)
                for w in words:
                    k = (lang, script_of(w[0]))
                    scripts[k] = scripts.get(k, 0) + len(w)
        for lang, c in grams.items():
            at = np.flatnonzero(c)
            yield pd.DataFrame({"lang": lang, "script": None, "bucket": at.astype(np.int32), "n": c[at]})
        for (lang, script), c in scripts.items():
            yield pd.DataFrame({"lang": [lang], "script": [script], "bucket": np.array([-1], np.int32), "n": [c]})

    def packed(part: pd.DataFrame) -> pd.DataFrame:
        grams, own = np.zeros(BUCKETS, np.int64), part[part["script"].notna()].sort_values("script")
        count = part[part["script"].isna()]
        grams[count["bucket"]] = count["n"]
        return pd.DataFrame({"lang": part["lang"].iloc[:1], "grams": [grams.tobytes()], "script": [own["script"].tolist()], "n": [own["n"].tolist()]})

    rows = (
        known.select("text", "lang").mapInPandas(counted, "lang string, script string, bucket int, n long")
        .groupBy("lang", "script", "bucket").agg(F.sum("n").alias("n"))
        .groupBy("lang").applyInPandas(packed, "lang string, grams binary, script array<string>, n array<long>")
        .orderBy("lang").collect()
    )
    langs = [r.lang for r in rows]
    counts = np.stack([np.frombuffer(r.grams, np.int64) for r in rows], axis=1).astype(np.float64) if langs else np.zeros((BUCKETS, 0))
    logs = np.log((counts + 0.5) / (counts.sum(0) + 0.5 * BUCKETS)) if langs else counts
    weights = (logs - logs.mean(1, keepdims=True)).astype(np.float32) if langs else logs
    scripts: dict[str, np.ndarray] = {}
    for i, r in enumerate(rows):
        for script, n in zip(r.script, r.n):
            if n >= SCRIPT_SHARE * sum(r.n):
                scripts.setdefault(script, np.zeros(len(langs), bool))[i] = True
    usual = max(range(len(langs)), key=lambda i: sum(rows[i].n)) if langs else 0
    return Model(langs, weights, scripts, usual)


class Scorer(dict):
    """Word -> number of its row of scores. Words that are new are scored together."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.rows = model, np.zeros((0, len(model.langs)), np.float32)

    def learn(self, words: set[str]) -> None:
        """Scores the words that have none yet; forgets all others first if there are too many."""
        m = self.model
        if len(self) > MAX_WORDS:
            self.clear()
            self.rows = self.rows[:0]
        new = [w for w in words if w not in self]
        if not new or not m.langs:
            return
        bucket, owner = grams_of(new)
        score = np.stack([np.bincount(owner, m.weights[bucket, k], len(new)) for k in range(len(m.langs))], axis=1)
        none = np.zeros(len(m.langs), bool)
        allowed = np.stack([m.scripts.get(script_of(w[0]), none) for w in new])
        score = np.where(allowed, score, -np.inf)
        known = allowed.any(1)
        score[known] = np.maximum(score[known] - score[known].max(1, keepdims=True), -MOST)
        score[~known] = 0
        start = len(self.rows)
        self.rows = np.concatenate([self.rows, score.astype(np.float32)])
        self.update(zip(new, range(start, start + len(new))))

    def scores(self, words: list[str]) -> np.ndarray:
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.rows[at].astype(np.float64)


def viterbi(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of each word when each change of the label costs ``switch``; ties go to the smaller label.

    If no stretch of words prefers another label to the best single one by more than half the cost, that single label
    is the best path, and the recursion is not run.
    """
    n, k = scores.shape
    total = scores.sum(0)
    best = int(total.argmax())
    gain = np.cumsum(scores - scores[:, [best]], axis=0)
    low = np.minimum(np.minimum.accumulate(np.concatenate([np.zeros((1, k)), gain[:-1]]), axis=0), 0)
    if n == 0 or (gain - low).max() <= switch / 2:
        return np.full(n, best)
    v = scores[0].tolist()
    back = []
    for row in scores[1:].tolist():
        top = max(v)
        lead, cost = v.index(top), top - switch
        came = [i if x >= cost else lead for i, x in enumerate(v)]
        v = [(x if x >= cost else cost) + s for x, s in zip(v, row)]
        back.append(came)
    at = v.index(max(v))
    path = [at]
    for came in reversed(back):
        at = came[at]
        path.append(at)
    return np.array(path[::-1])


def label(text: str | None, scorer: Scorer) -> tuple[str, float, list[tuple[str, int, int]]]:
    """(language, share of the letters in its spans, spans as (language, first word, words))."""
    return label_all([text], scorer)[0]


def label_all(texts: list[str | None], scorer: Scorer) -> list[tuple[str, float, list[tuple[str, int, int]]]]:
    """Labels of several texts, whose new words are scored together."""
    words = [WORDS.findall(x.lower()) if x else [] for x in texts]
    scorer.learn(set().union(*words))
    return [_labelled(w, scorer) for w in words]


def _labelled(words: list[str], scorer: Scorer) -> tuple[str, float, list[tuple[str, int, int]]]:
    langs = scorer.model.langs
    if not words:
        return "und", 0.0, []
    if not langs:
        return "und", 0.0, []
    if len(langs) == 1:
        return langs[0], 1.0, [(langs[0], 0, len(words))]
    scores = scorer.scores(words)
    if not scores.any():
        return langs[scorer.model.usual], 0.0, []
    path = viterbi(scores)
    letters = np.fromiter(map(len, words), np.int64, len(words))
    share = np.bincount(path, letters, len(langs))
    starts = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]]))
    ends = np.concatenate([starts[1:], [len(words)]])
    win = int(share.argmax())
    return langs[win], float(share[win] / letters.sum()), [(langs[path[a]], int(a), int(b - a)) for a, b in zip(starts, ends)]


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Adds lang_pred, score and spans to ``docs`` (columns of these names are replaced).

    lang_pred is a language of the model, or ``und`` where the text is null or has no letter, or the model is empty; the
    language with most letters in the spans of the best path wins, ties go to the smaller name. score: its share of the
    letters, 0 where no word speaks for a language. spans: runs of words with one language. Each row stands for itself;
    the prediction sees the text alone. The model is broadcast: BUCKETS numbers for each language.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score", "spans")
    names = docs.columns
    kept: dict[int, Scorer] = {}

    def labelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = kept.setdefault(0, Scorer(shared.value))
        for b in batches:
            texts = b["text"].tolist()
            found = [y for i in range(0, len(texts), TOGETHER) for y in label_all(texts[i : i + TOGETHER], scorer)]
            out = pd.DataFrame(
                {
                    "lang_pred": [x[0] for x in found],
                    "score": [x[1] for x in found],
                    "spans": [[{"lang": a, "first": s, "words": n} for a, s, n in x[2]] for x in found],
                },
                index=b.index,
            )
            yield pd.concat([b, out], axis=1)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInPandas(labelled, f"{schema}, lang_pred string, score double, spans array<struct<lang:string,first:int,words:int>>").select(
        *[f"`{n}`" for n in names], "lang_pred", "score", "spans"
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = fit(docs)
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
