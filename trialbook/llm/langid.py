"""Language identification: words first, then ever shorter character n-grams.

A model holds, per language, the log frequency of the most frequent words and of character n-grams of
four lengths. A known word is scored by its own log frequencies. A word not seen in training backs off to
its n-grams of length 4; the parts of it that are unknown too back off to length 3, then 2, then 1, and the
word gets the mean over what was found. A text's language has the highest sum over its words; its score
is the mean, over words, of the word's posterior for that language.

Training takes a bounded sample of the distinct labelled texts with a letter, spread evenly by a hash of the
text and alike for each language (about ``SAMPLE_TEXTS`` each, texts of at most ``SAMPLE_CHARS`` characters, or
longer ones, as a whole, where a language has no others), counts it in Spark and keeps ``TABLE`` entries per
length and language, so the model's size depends on the number of languages, not on the corpus. What a language
was not seen with has the floor of its length, the lowest one of all languages, whether the language has few words
or many. Scoring reads whole texts in pieces; new words of a batch are scored together, and kept while they are few.

Nulls and edges: a null text, or one without a letter, is ``und`` with score 0. Rows without a language, or
without a letter, are not learned from, and a language of such rows only is not known. Without any training text every text is ``und``. Ties go to the language first in
order. Repeated rows are scored alike; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trialbook.llm import query
from trialbook.llm.tasks import remote
from trialbook.llm.text import table, whole
from trialbook.session import stage

SAMPLE_TEXTS, SAMPLE_CHARS = 2000, 50_000
TABLE = 20_000  # entries per language and length
GRAMS = (4, 3, 2, 1)
LETTERS = re.compile(r"[^\W\d_]+")
# Bounds of memory for up to four languages, less for more: characters of a piece, words kept, words of texts that are
# looked up together, texts.
SEGMENT, _CACHE, TOKENS, TEXTS = 1_000_000, 400_000, 500_000, 100_000
UNKNOWN = "und"


def _gram(size: int):
    """The n-gram of a word at a place. (A second parameter of such a function would be the place's index.)"""
    return lambda i: F.col("word").substr(i, F.lit(size))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict:
    """Log frequencies per language from the labelled rows of ``docs``."""
    labelled = docs.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    labelled = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("h"), (F.length(text) > SAMPLE_CHARS).alias("long"))
    counts: dict[str, tuple[bool, int]] = {}  # long texts, or not, and how many distinct ones: false sorts before true
    for r in labelled.groupBy("lang", "long").agg(F.approx_count_distinct("h").alias("n")).orderBy("lang", "long").collect():
        counts.setdefault(r["lang"], (r["long"], r["n"]))
    # An even share by hash, about SAMPLE_TEXTS per language: no ordering and no group in one task. Copies are drawn once.
    shares = [(name, long, 1_000_000 * min(1.0, SAMPLE_TEXTS / max(n, 1))) for name, (long, n) in counts.items()]
    shares = docs.sparkSession.createDataFrame(shares, "lang string, long boolean, share double")  # a row per language
    drawn = labelled.join(F.broadcast(shares), ["lang", "long"]).filter(F.pmod(F.col("h"), F.lit(1_000_000)) < F.col("share"))
    drawn = drawn.groupBy("lang", "h").agg(F.min("text").alias("text"))
    words = drawn.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    words = stage(words.groupBy("lang", "word").count(), "words")
    parts = [words.select("lang", F.lit(0).alias("size"), F.col("word").alias("gram"), "count")]
    for size in GRAMS:
        places = F.sequence(F.lit(1), F.length("word") - size + 1)
        cut = words.filter(F.length("word") >= size).select("lang", "count", F.explode(F.transform(places, _gram(size))).alias("gram"))
        parts.append(cut.groupBy("lang", "gram").agg(F.sum("count").alias("count")).select("lang", F.lit(size).alias("size"), "gram", "count"))
    grams = parts[0]
    for p in parts[1:]:
        grams = grams.unionByName(p)
    grams = stage(grams, "grams")
    rank = Window.partitionBy("lang", "size").orderBy(F.desc("count"), "gram")
    top = grams.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= TABLE)
    totals = grams.groupBy("lang", "size").agg((F.sum("count") + F.count(F.lit(1)) + 1).alias("total")).collect()
    langs = sorted({r["lang"] for r in totals})
    place = {name: i for i, name in enumerate(langs)}
    logs = np.zeros((GRAMS[0] + 1, len(langs)))
    for r in totals:
        logs[r["size"], place[r["lang"]]] = np.log(r["total"])
    # One floor per length, the lowest of all languages: with its own one, a language of few words would win what nobody knows.
    floors = logs.max(axis=1, initial=0)
    # At most TABLE rows per language and length. What a gram has above the floors is kept for the languages that have it.
    rows = top.select("lang", "size", "gram", "count").toArrow()
    size, at = rows.column("size").to_numpy(), np.array([place[x] for x in rows.column("lang").to_pylist()], dtype=np.int64)
    index: dict[tuple[int, str], int] = {}
    row = np.array([index.setdefault(x, len(index)) for x in zip(size.tolist(), rows.column("gram").to_pylist(), strict=True)], dtype=np.int64)
    by = np.argsort(row, kind="stable")
    starts = np.searchsorted(row[by], np.arange(len(index) + 2))  # the last gram is an unknown letter, which no language has
    above = np.log(rows.column("count").to_numpy() + 1.0) - logs[size, at] + floors[size]
    return {"langs": langs, "grams": list(index), "starts": starts, "at": at[by], "above": above[by]}


def bound(most: int, langs: int) -> int:
    """A bound for four languages, fit for so many."""
    return max(1, min(most, most * 4 // max(langs, 1)))


class Scorer(dict):
    """Word -> row of ``scores`` (log frequencies) and ``posteriors``. Row 0 is for what has no letter."""

    def __init__(self, model: dict):
        super().__init__()
        self.langs, self.starts, self.at, self.above = len(model["langs"]), model["starts"], model["at"], model["above"]
        self.tables: dict[int, dict[str, int]] = {size: {} for size in (0, *GRAMS)}
        for i, (size, gram) in enumerate(model["grams"]):
            self.tables[size][gram] = i
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.scores = np.zeros((1, self.langs))
        self.posteriors = self.scores

    def __missing__(self, word: str) -> int:
        if not word.isalpha() and not any(map(str.isalpha, word)):
            self[word] = 0
            return 0
        self.new.append(word)
        self[word] = row = len(self.scores) + len(self.new) - 1
        return row

    def backed_off(self, word: str, level: int, out: list[int]) -> None:
        """Rows of the n-grams of a part of a word; the last row stands for an unknown letter."""
        if level == len(GRAMS):
            out += [len(self.starts) - 2] * len(word)
            return
        size = GRAMS[level]
        n = len(word) - size + 1
        if n < 1:
            self.backed_off(word, level + 1, out)
            return
        get = self.tables[size].get
        found = [get(word[i : i + size]) for i in range(n)]
        if None not in found:
            out += found
            return
        at = 0
        while at < n:
            if found[at] is not None:
                out.append(found[at])
                at += 1
                continue
            stop = at
            while stop < n and found[stop] is None:
                stop += 1
            # The run of unknown n-grams is one part, which is read again one letter shorter.
            self.backed_off(word[at : stop + size - 1], level + 1, out)
            at = stop

    def learn(self) -> None:
        """Score the new words: log frequencies above the floors, which are alike for all languages."""
        if not self.new:
            return
        rows: list[int] = []
        ends = []
        for word in self.new:
            known = self.tables[0].get(word)
            if known is None:
                self.backed_off(word, 0, rows)
            else:
                rows.append(known)
            ends.append(len(rows))
        number = np.diff(ends, prepend=0)
        found, owner = np.array(rows), np.repeat(np.arange(len(number)), number)
        first, many = self.starts[found], self.starts[found + 1] - self.starts[found]
        entry = np.arange(many.sum()) + np.repeat(first - np.cumsum(many) + many, many)
        cells = np.bincount(np.repeat(owner, many) * self.langs + self.at[entry], self.above[entry], len(number) * self.langs)
        scores = cells.reshape(-1, self.langs) / number[:, None]
        odds = np.exp(scores - scores.max(axis=1, keepdims=True))
        self.scores = np.vstack([self.scores, scores])
        self.posteriors = np.vstack([self.posteriors, odds / odds.sum(axis=1, keepdims=True)])
        self.new = []


def pieces(text: str, segment: int = SEGMENT) -> Iterator[str]:
    """A text in pieces cut where no letter stands."""
    at = 0
    while at < len(text):
        stop = min(at + segment, len(text))
        while stop < len(text) and text[stop].isalpha():
            stop += 1
        yield text[at:stop]
        at = stop


def identify(texts: list[str], scorer: Scorer, langs: list[str]) -> list[tuple[str, float]]:
    """Language and score of each text."""
    totals, posteriors, numbers = np.zeros((len(texts), len(langs))), np.zeros((len(texts), len(langs))), np.zeros(len(texts))
    rows: list[np.ndarray] = []
    owners: list[int] = []

    def add() -> None:
        scorer.learn()
        for k, found in zip(owners, rows, strict=True):
            totals[k] += scorer.scores[found].sum(axis=0)
            posteriors[k] += scorer.posteriors[found].sum(axis=0)
            numbers[k] += np.count_nonzero(found)
        rows.clear(), owners.clear()
        if len(scorer) > bound(_CACHE, len(langs)):
            scorer.forget()

    size, most, segment = 0, bound(TOKENS, len(langs)), bound(SEGMENT, len(langs))
    for k, text in enumerate(texts if langs else ()):
        for piece in pieces(text, segment):
            words = LETTERS.findall(piece.lower())
            rows.append(np.fromiter(map(scorer.__getitem__, words), dtype=np.int64, count=len(words)))
            owners.append(k)
            size += len(words)
            if size > most:
                add()
                size = 0
    add()
    best = totals.argmax(axis=1) if langs else []
    return [(langs[best[k]], float(min(1.0, posteriors[k, best[k]] / n))) if n else (UNKNOWN, 0.0) for k, n in enumerate(numbers.tolist())]


def label(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """Batches of (doc_id, text) with lang_pred and score in place of the text."""
    scorer, langs = Scorer(model.value), model.value["langs"]
    step = bound(TEXTS, len(langs))
    for batch in batches:
        texts = batch.column(1).to_pylist()
        found = [x for at in range(0, len(texts), step) for x in identify(texts[at : at + step], scorer, langs)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "lang_pred", "score"])


def predict(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by languages x lengths x TABLE entries
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text)).mapInArrow(remote(label, sent), "doc_id long, lang_pred string, score double")


@query("op1_language_id")
def _(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = fit(docs.filter(~held_out))
    return predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
