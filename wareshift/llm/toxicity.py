"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text,
normalised by length, with exception phrases.

Folding maps look-alike letters of other scripts and digits or signs used as
letters to the letter they stand for, drops signs inside words, shortens
drawn-out letters and closes up words spelled out letter by letter, so
altered spellings meet the same lexicon entry.

The lexicon is learned from labelled rows: for each word, and each word
start of four to eight letters, the documents of either label that hold it.
An entry is kept if its log-likelihood ratio exceeds what the best of as
many random candidates would reach; its weight is the smoothed log odds.
Word pairs around an entry that only clean documents hold, more of them than
chance explains at the rate of clean documents among those with an entry,
become exception phrases, which silence the entries inside them.  Every entry
and phrase that passes its test is kept.

A document's whole folded text runs through one automaton of entries and
phrases.  Of the entries that begin at one word the heaviest counts.  The
hits' weights, summed, and per word, are the document's features; a logistic
curve fitted on the labelled rows turns them into a score from 0 to 1.

At most ``max_labelled`` labelled rows are fitted on (by hash of the id);
that bounds what is broadcast and collected, the lexicon too.  Scoring is a
map over all documents.

Defined results: a null text is empty; a text without words scores as one
without hits; without labels of both kinds the lexicon is empty and every
score 0; repeated label rows of an id count once, toxic if one is; null
labels are left out; repeated documents are scored, and learned from, row by
row.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareshift.llm.stage import written

# Letters of other scripts that look like a Latin letter.
LOOK_ALIKES = {
    "a": "аαɑ", "b": "ЬЪвβ", "c": "сϲ", "d": "ԁ", "e": "еєε", "g": "ɡ", "h": "һн", "i": "іıιӏ", "j": "ј", "k": "кκ",
    "l": "ⅼ", "m": "м", "n": "пη", "o": "оοσ", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ", "t": "тτ", "u": "υ", "v": "ѵν",
    "w": "ԝω", "x": "хχ", "y": "уγ", "z": "ᴢ",
}
# Digits and signs written for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}

_FOLD = {ord(c): to for to, cs in LOOK_ALIKES.items() for c in cs + cs.upper() if ord(c) > 127}
_SUBST = {ord(c): to for c, to in SUBSTITUTES.items()}
_MARKS = re.compile("[̀-ͯ​-‏­]")
_SIGNS = re.compile(r"[^\w]|_")
_DRAWN = re.compile(r"(.)\1{2,}")
_TRAIL = re.compile(r"[!?.,;:$@#%&*]+$")
_SPELLED = re.compile(r" (?:[^\W\d_] ){3,}")

STARTS = (4, 5, 6, 7, 8)
#: Entries of a task's count table before it is handed on.
TABLE = 200_000
#: Words whose folded form a task remembers, and whose features (several
#: strings a word).
REMEMBERED, REMEMBERED_FEATURES = 300_000, 120_000


def fold_word(word: str) -> str:
    """The letters a lower-case word stands for; '' if it has none."""
    if not word.isascii():
        word = _MARKS.sub("", unicodedata.normalize("NFKC", word)).lower().translate(_FOLD)
    word = _TRAIL.sub("", word)
    if not word.isalpha():
        if not any(c.isalpha() for c in word):
            return ""
        word = _SIGNS.sub("", word.translate(_SUBST))
    return _DRAWN.sub(r"\1", word)


class _Remembered(dict):
    """Results of a function of a word, emptied between texts when it grows."""

    def __init__(self, of, limit: int):
        super().__init__()
        self.of, self.limit = of, limit

    def __missing__(self, word: str):
        self[word] = value = self.of(word)
        return value

    def all(self, words) -> list:
        if len(self) > self.limit:
            self.clear()
        return list(map(self.__getitem__, words))


def split(text: str) -> list[str]:
    """The lower-case words of a text."""
    return text.lower().split()


def _close_up(match: re.Match) -> str:
    return f" {fold_word(match.group().replace(' ', ''))} "


def join_folded(folded: list[str]) -> str:
    """The folded text: words between single spaces, one at either end; three
    or more single letters in a row are one word spelled out."""
    text = f" {' '.join(filter(None, folded))} "
    return _SPELLED.sub(_close_up, text)


def fold(text: str) -> list[str]:
    """The folded words of a text."""
    return join_folded(list(map(fold_word, split(text)))).split()


def word_features(word: str) -> tuple[str, ...]:
    """Of a folded word: itself as ' word ', its starts as ' star'."""
    word = fold_word(word)
    if len(word) < 3:
        return ()
    return (f" {word} ", *(f" {word[:n]}" for n in STARTS if len(word) >= n))


@dataclass
class Model:
    """terms: entry -> weight; exceptions: ' before after ' word pairs;
    curve: coefficients of (1, total, per word)."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset = frozenset()
    curve: tuple[float, ...] = ()

    def matcher(self) -> "Matcher":
        return Matcher(self.terms, self.exceptions)


class Matcher:
    """The automaton of a model's entries and exception phrases, each of
    which begins with the space before its first word."""

    def __init__(self, terms: dict[str, float], exceptions: frozenset):
        import ahocorasick

        self.folded = _Remembered(fold_word, REMEMBERED)
        self.empty = not terms
        self.automaton = ahocorasick.Automaton()
        for entry in {*terms, *exceptions}:
            self.automaton.add_word(entry, (len(entry), terms.get(entry, 0.0), entry if entry in exceptions else None))
        self.automaton.make_automaton()

    def text(self, words: list[str]) -> str:
        """The folded text of lower-case words."""
        return join_folded(self.folded.all(words))


def hits(words: list[str], matcher: Matcher, exceptions: frozenset) -> list[tuple[int, float]]:
    """(number of the folded word, weight) of the words at which entries
    begin, without those inside an exception phrase."""
    return [] if matcher.empty or not words else text_hits(matcher.text(words), matcher, exceptions)


def text_hits(text: str, matcher: Matcher, exceptions: frozenset) -> list[tuple[int, float]]:
    best: dict[int, float] = {}
    silent = []
    for end, (size, weight, phrase) in matcher.automaton.iter(text):
        start = end - size + 1
        if weight > best.get(start, 0.0):
            best[start] = weight
        if phrase is not None and phrase in exceptions:
            silent.append((start, end))
    return [(text.count(" ", 0, start), w) for start, w in sorted(best.items())
            if not any(a <= start < b for a, b in silent)]


def _pair(folded: list[str], i: int) -> str:
    return f" {folded[i]} {folded[i + 1]} " if 0 <= i < len(folded) - 1 else ""


def measures(found: list[tuple[int, float]], n_words: int) -> tuple[float, float]:
    """The hits' total weight, damped, and per word (of 100 at least)."""
    total = sum(w for _, w in found)
    return math.log1p(max(total, 0.0)), math.log1p(100.0 * max(total, 0.0) / max(n_words, 100))


def score(curve: tuple[float, ...], total: float, rate: float) -> float:
    if not curve:
        return 0.0
    z = curve[0] + curve[1] * total + curve[2] * rate
    return 1.0 / (1.0 + math.exp(-min(max(z, -60.0), 60.0)))


def training_rows(docs: DataFrame, labels: DataFrame, max_labelled: int, id_col: str, text_col: str) -> DataFrame:
    """(text, toxic) of the labelled documents outside the held-out third."""
    lab = (labels.select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("toxic"))
           .where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("id")))
           .groupBy("id").agg(F.max("toxic").alias("toxic")))
    n = lab.count()
    if n > max_labelled:
        part = int(1_000_000 * 0.95 * max_labelled / n)
        lab = lab.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < part)
    # at most max_labelled rows of an id and a bit
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.join(F.broadcast(lab), "id").select("text", "toxic")


def held_out(id_col):
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables = Counter(), Counter()  # clean, toxic
    features = _Remembered(word_features, REMEMBERED_FEATURES)

    def flush():
        terms = list(tables[0].keys() | tables[1].keys())
        columns = [pa.array(terms, pa.string()), *(pa.array([t[k] for k in terms], pa.int64()) for t in tables)]
        return pa.RecordBatch.from_arrays(columns, names=["term", "clean", "toxic"])

    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
            tables[toxic].update(set().union(*features.all(set(split(text.as_py() or "")))))
            if len(tables[0]) + len(tables[1]) > TABLE:
                yield flush()
                tables[0].clear()
                tables[1].clear()
    yield flush()


def _llr(k1: F.Column, n1: int, k0: F.Column, n0: int):
    """Twice the log-likelihood ratio of a term's two rates against one."""
    def ll(k, n):
        return F.when((k > 0) & (k < n), k * F.log(k / n) + (n - k) * F.log(1 - k / n)).otherwise(0.0)

    n = float(n1 + n0)
    k = k1 + k0
    p = k / n

    def one(k, size):
        return F.when(k > 0, k * F.log(p)).otherwise(0.0) + F.when((k < size) & (p < 1), (size - k) * F.log(1 - p)).otherwise(0.0)

    return 2 * (ll(k1, float(n1)) + ll(k0, float(n0)) - one(k1, float(n1)) - one(k0, float(n0)))


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = 200_000, id_col: str = "doc_id",
          text_col: str = "text") -> Model:
    """Fit the lexicon, its exceptions and the curve."""
    rows = training_rows(docs, labels, max_labelled, id_col, text_col)
    by = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n0, n1 = by.get(0, 0), by.get(1, 0)
    if not n0 or not n1:
        return Model()
    counted = written(rows.mapInArrow(_count_features, "term string, clean bigint, toxic bigint")
                      .groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "lexicon", rows=50 * (n0 + n1))
    least = 2 * math.log(max(counted.count(), 2))
    odds = F.log((F.col("toxic") + 0.5) / (n1 + 1.0)) - F.log((F.col("clean") + 0.5) / (n0 + 1.0))
    entries = (counted.where(F.col("toxic") * n0 > F.col("clean") * n1)
               .where(_llr(F.col("toxic"), n1, F.col("clean"), n0) >= least)
               .select("term", odds.alias("weight")).where(F.col("weight") > 1.0).collect())
    model = Model({r.term: r.weight for r in entries})
    if not model.terms:
        return model
    model.exceptions = _exceptions(rows, model, n0 + n1)
    seen = rows.mapInArrow(_measure(model), "toxic int, total double, rate double").collect()  # max_labelled rows
    y = np.array([r.toxic for r in seen], float)
    x = np.array([(1.0, r.total, r.rate) for r in seen])
    model.curve = tuple(_fit(x, y))
    return model


def _exceptions(rows: DataFrame, model: Model, max_rows: int) -> frozenset:
    """Word pairs with a hit that clean documents hold and toxic ones do not,
    if so many clean ones in a row are less likely than one chance in as many
    as there are pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = model.matcher()
        for batch in batches:
            pairs, labels = [], []
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                folded = matcher.text(split(text.as_py() or ""))
                found = text_hits(folded, matcher, frozenset())
                if not found:
                    continue
                words = folded.split()
                near = {_pair(words, i) for n, _ in found for i in (n - 1, n)} - {""} | {"any"}
                pairs += near
                labels += [toxic] * len(near)
            yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.string()), pa.array(labels, pa.int32())],
                                             names=["pair", "toxic"])

    counted = written(rows.mapInArrow(run, "pair string, toxic int").groupBy("pair")
                      .agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")), "pairs", rows=max_rows)
    every = counted.where("pair = 'any'").first()
    if every is None or every.toxic == every.n:
        return frozenset()
    clean = max(1e-9, -math.log((every.n - every.toxic) / every.n))
    least = math.log(max(counted.count(), 2)) / clean
    return frozenset(r.pair for r in counted.where((F.col("toxic") == 0) & (F.col("n") >= least) & (F.col("pair") != "any"))
                     .select("pair").collect())


def _measure(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = model.matcher()
        for batch in batches:
            out = []
            for text in batch.column(0):
                words = split(text.as_py() or "")
                out.append(measures(hits(words, matcher, model.exceptions), len(words)))
            yield pa.RecordBatch.from_arrays([
                batch.column(1), pa.array([t for t, _ in out], pa.float64()),
                pa.array([r for _, r in out], pa.float64())], names=["toxic", "total", "rate"])

    return run


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression by Newton steps; the classes weigh their rows."""
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return w


def score_documents(docs: DataFrame, model: Model, carry: list[str], threshold: float = 0.7,
                    text_col: str = "text") -> DataFrame:
    """``row`` (struct of the ``carry`` columns but the text), ``text`` if
    carried (else null), score, predicted, n_hits."""
    with_text = text_col in carry
    # a struct needs a field; its name cannot meet one of the carried columns
    kept = [F.col(f"`{c}`").alias(c) for c in carry if c != text_col] or [F.lit(0).alias("none")]
    src = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.struct(*kept).alias("row"))
    schema = T.StructType([src.schema["row"], T.StructField("text", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("n_hits", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = None
        for batch in batches:
            matcher = model.matcher() if matcher is None else matcher
            scores, counts = [], []
            for text in batch.column(0):
                words = split(text.as_py() or "")
                found = hits(words, matcher, model.exceptions)
                scores.append(score(model.curve, *measures(found, len(words))))
                counts.append(len(found))
            yield pa.RecordBatch.from_arrays([
                batch.column(1), batch.column(0) if with_text else pa.nulls(batch.num_rows, pa.string()),
                pa.array(scores, pa.float64()), pa.array(counts, pa.int64())], names=["row", "text", "score", "n_hits"])
        pa.default_memory_pool().release_unused()

    out = src.mapInArrow(run, schema)
    return out.select("row", "text", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_hits")


def acceptable_documents(docs: DataFrame, model: Model, text_col: str = "text", **options) -> DataFrame:
    """The documents not predicted toxic, with all their columns."""
    kept = score_documents(docs, model, docs.columns, text_col=text_col, **options).where("predicted = 0")
    return kept.select(*[F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c)
                         for c in docs.columns])
