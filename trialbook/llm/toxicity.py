"""Toxic spans by a linear-chain conditional random field.

Documents carry the labels, so tokens get theirs first: words and word beginnings that occur in many
toxic documents of the training sample and hardly in a clean one mark the tokens of toxic documents.
A two-state chain with features of each word (itself, its beginnings, its end) is trained on these
tokens by maximum likelihood. Scoring runs forward-backward over the whole chain of a text; a
document's score is the chance that any token is toxic, calibrated on the sample, and runs of tokens
with a marginal of one half or more are the offending spans.

Forward-backward works on blocks of tokens of many texts at once: products of 2 x 2 matrices within
blocks, a scan over blocks, and matrices of equal rows where a text begins. A chain is cut after
``CHAIN`` tokens, so memory is bounded for texts of any length.

The sample has about ``SAMPLE_TEXTS`` toxic documents at most, and ``CLEAN_PER_TOXIC`` times as many clean ones,
chosen by a hash of the id, of ``SAMPLE_CHARS`` characters at most. Nulls and edges: a null, empty or letterless text has no token
and gets the score of no toxic token; rows without a label are not learned from; a document labelled
more than once counts as toxic if one label says so. Without toxic or clean training documents every
score is 0. Repeated rows are scored alike; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialbook.llm import query
from trialbook.llm.tasks import remote
from trialbook.llm.text import table, whole

SAMPLE_TEXTS, SAMPLE_CHARS, CLEAN_PER_TOXIC = 600, 30_000, 8
LEAST_PRECISION, CHANCE = 0.98, 0.01  # of documents with a mark that are toxic; of one mark or more by accident
STEPS, RATE, PENALTY = 50, 0.3, 1e-6
BLOCK, CHAIN = 64, 1_000_000
WORDS = re.compile(r"[^\W\d_]+")
_CACHE = 200_000
SPAN = "array<struct<start: long, stop: long, marginal: double>>"


def features(word: str) -> list[str]:
    w = word.lower()
    return ["=" + w, *("^" + w[:n] for n in (3, 4, 5, 6) if len(w) > n), "$" + w[-3:], "*"]


class Chain:
    """Forward-backward over concatenated chains of two states."""

    def __init__(self, emission: np.ndarray, first: np.ndarray, start: np.ndarray, move: np.ndarray):
        """``emission``: log odds of state 1 per token; ``first``: whether a token begins a text;
        ``start`` (2) and ``move`` (2 x 2): log weights."""
        n = len(emission)
        blocks = max(1, -(-n // BLOCK))
        odds = np.exp(np.clip(emission, -30, 30))
        m = np.tile(np.eye(2), (blocks * BLOCK, 1, 1))
        m[:n] = np.where(first[:, None, None], np.exp(start)[None, None, :], np.exp(move)[None])
        m[:n, :, 1] *= odds[:, None]
        self.n, self.m = n, m.reshape(blocks, BLOCK, 2, 2)
        total = np.tile(np.eye(2), (blocks, 1, 1))
        for t in range(BLOCK):
            total = total @ self.m[:, t]
            total /= total.max(axis=(1, 2), keepdims=True)
        into, out = np.empty((blocks, 2)), np.empty((blocks, 2))
        a, b = 0.5, 0.5
        for k, (p, q, r, s) in enumerate(total.reshape(-1, 4).tolist()):
            into[k] = a, b
            a, b = a * p + b * r, a * q + b * s
            a, b = a / (a + b), b / (a + b)
        a, b = 0.5, 0.5
        for k, (p, q, r, s) in zip(range(blocks - 1, -1, -1), total.reshape(-1, 4)[::-1].tolist(), strict=True):
            out[k] = a, b
            a, b = p * a + q * b, r * a + s * b
            a, b = a / (a + b), b / (a + b)
        forward, backward = np.empty((blocks, BLOCK, 2)), np.empty((blocks, BLOCK, 2))
        for t in range(BLOCK):
            into = np.einsum("ki,kij->kj", into, self.m[:, t])
            into /= into.sum(axis=1, keepdims=True)
            forward[:, t] = into
        for t in range(BLOCK - 1, -1, -1):
            backward[:, t] = out
            out = np.einsum("kij,kj->ki", self.m[:, t], out)
            out /= out.sum(axis=1, keepdims=True)
        self.forward, self.backward = forward.reshape(-1, 2), backward.reshape(-1, 2)

    def marginals(self) -> np.ndarray:
        """The chance of state 1 per token."""
        both = self.forward[: self.n] * self.backward[: self.n]
        return both[:, 1] / both.sum(axis=1)

    def moves(self) -> np.ndarray:
        """The chance of each pair of states per token and the one before it."""
        pair = self.forward[: self.n - 1, :, None] * self.m.reshape(-1, 2, 2)[1 : self.n] * self.backward[1 : self.n, None, :]
        return pair / pair.sum(axis=(1, 2), keepdims=True)


def _marks(texts: list[str], toxic: np.ndarray) -> set[str]:
    """Features that tell toxic documents from clean ones: so frequent among the toxic ones, and hardly elsewhere,
    that of all features seen none would be expected to be so by accident, nor by copies of a passage."""
    bad, clean = Counter(), Counter()
    for text in (t for t, y in zip(texts, toxic, strict=True) if y):
        bad.update({f for w in set(WORDS.findall(text)) for f in features(w)[:-2]})
    least = np.log(CHANCE / len(bad)) / np.log(toxic.mean())
    bad = Counter({f: n for f, n in bad.items() if n >= least})
    for text in (t for t, y in zip(texts, toxic, strict=True) if not y):
        clean.update({f for w in set(WORDS.findall(text)) for f in features(w)[:-2]} & bad.keys())
    marks = {f for f, n in bad.items() if n >= LEAST_PRECISION * (n + clean[f])}
    # Copies of one passage repeat its words after the same words; a mark stands after various ones.
    before: dict[str, set[str]] = {f: set() for f in marks}
    for text in (t for t, y in zip(texts, toxic, strict=True) if y):
        words = WORDS.findall(text)
        for last, word in zip(["", *words], words):
            for f in marks.intersection(features(word)[:-2]):
                before[f].add(last)
    return {f for f, words in before.items() if len(words) >= least / 2}


def any_toxic(marginals: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Log odds, per text, that one of its tokens is toxic; marginals below one in a hundred count as none."""
    clean = np.log1p(-np.clip(np.where(marginals < 0.01, 0.0, marginals), 0, 1 - 1e-9))
    total = np.add.reduceat(clean, np.flatnonzero(first)) if len(clean) else np.zeros(0)
    return np.clip(np.log1p(-np.exp(np.minimum(total, -1e-6))) * -1 + total, -15, 15) * -1


def train(texts: list[str], toxic: np.ndarray) -> dict | None:
    """Weights of the chain and the calibration, from texts and their labels."""
    some = [bool(WORDS.search(t)) for t in texts]
    texts, toxic = [t for t, x in zip(texts, some, strict=True) if x], toxic[np.array(some, dtype=bool)]
    marks = _marks(texts, toxic) if toxic.any() and not toxic.all() else set()
    if not marks:
        return None
    # The marks are found on all texts; the chain is trained on the toxic ones and as many clean ones.
    clean = np.flatnonzero(~toxic)[: toxic.sum()]
    taken = np.sort(np.concatenate([np.flatnonzero(toxic), clean]))
    texts, toxic = [[sys.intern(w) for w in WORDS.findall(texts[i])] for i in taken], toxic[taken]
    types: dict[str, int] = {}
    at = np.array([types.setdefault(w, len(types)) for t in texts for w in t])
    names: dict[str, int] = {}
    rows = [[names.setdefault(f, len(names)) for f in features(w)] for w in types]
    owner, feature = np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate([np.array(r) for r in rows])
    marked = np.array([any(f in marks for f in features(w)[:-2]) for w in types])
    lengths = np.array([len(t) for t in texts])
    first = np.zeros(len(at), dtype=bool)
    first[np.cumsum(lengths) - lengths] = True
    truth = marked[at] & np.repeat(toxic, lengths)
    # What the labels show of states and moves, then ascent with a step per parameter (Adam).
    later = ~first[1:]
    seen_moves = np.zeros((2, 2))
    np.add.at(seen_moves, (truth[:-1][later].astype(int), truth[1:][later].astype(int)), 1)
    seen_start = np.bincount(truth[first].astype(int), minlength=2)
    seen_words = np.bincount(at, weights=truth, minlength=len(types))
    value = np.zeros(len(names) + 6)
    mean, spread = np.zeros_like(value), np.zeros_like(value)
    for step in range(1, STEPS + 1):
        weight, start, move = value[:-6], value[-6:-4], value[-4:].reshape(2, 2)
        emission = np.bincount(owner, weights=weight[feature], minlength=len(types))
        chain = Chain(emission[at], first, start, move)
        p = chain.marginals()
        by_word = seen_words - np.bincount(at, weights=p, minlength=len(types))
        slope = np.concatenate([
            np.bincount(feature, weights=by_word[owner], minlength=len(names)), seen_start - [(1 - p[first]).sum(), p[first].sum()],
            (seen_moves - chain.moves()[later].sum(axis=0)).ravel()]) / len(texts) - PENALTY * value
        mean, spread = 0.9 * mean + 0.1 * slope, 0.999 * spread + 0.001 * slope**2
        value = value + RATE * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
    x = any_toxic(Chain(np.bincount(owner, weights=value[:-6][feature], minlength=len(types))[at], first, value[-6:-4], value[-4:].reshape(2, 2)).marginals(), first)
    a, b = 1.0, 0.0
    for _ in range(500):
        q = 1 / (1 + np.exp(-(a * x + b)))
        a, b = a + 0.05 * ((toxic - q) * x).mean() - 0.001 * a, b + 0.05 * (toxic - q).mean()
    return {"weights": {f: float(value[i]) for f, i in names.items() if abs(value[i]) > 1e-3}, "start": value[-6:-4], "move": value[-4:].reshape(2, 2), "scale": a, "shift": b}


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> dict | None:
    """A model from the documents that ``labels`` (doc_id, toxic) names; None if it cannot tell anything."""
    named = labels.filter(F.col(toxic).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.max(toxic) > 0).alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in named.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic"), min(1.0, SAMPLE_TEXTS / sizes.get(True, 1))).otherwise(min(1.0, CLEAN_PER_TOXIC * SAMPLE_TEXTS / sizes.get(False, 1)))
    drawn = named.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000).select(F.col("doc_id").alias("_id"), "toxic")
    texts = docs.select(F.col(doc_id).alias("_doc"), whole(text).alias("t")).filter(F.length("t") <= SAMPLE_CHARS)
    rows = texts.join(F.broadcast(drawn), F.col("_doc") == F.col("_id")).select("t", "toxic").distinct().collect()  # about (1 + CLEAN_PER_TOXIC) x SAMPLE_TEXTS texts
    rows.sort(key=lambda r: zlib.crc32(r["t"].encode()))
    return train([r["t"] for r in rows], np.array([r["toxic"] for r in rows], dtype=bool))


class Emission(dict):
    """Log odds of a word under the model; words are kept while they are few."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) > _CACHE:
            self.clear()
        get = self.weights.get
        self[word] = out = sum(get(f, 0.0) for f in features(word))
        return out


def _chains(text: str, emission: Emission) -> Iterator[np.ndarray]:
    """Emissions of a text's tokens, ``CHAIN`` at a time."""
    part: list[float] = []
    for at in WORDS.finditer(text) if len(text) > 4 * CHAIN else ():
        part.append(emission[at.group()])
        if len(part) == CHAIN:
            yield np.array(part)
            part = []
    if len(text) <= 4 * CHAIN:
        words = WORDS.findall(text)
        for k in range(0, len(words), CHAIN):
            yield np.fromiter(map(emission.__getitem__, words[k : k + CHAIN]), dtype=float)
    elif part:
        yield np.array(part)


def _spans(text: str, marginals: np.ndarray) -> list[dict]:
    """Runs of toxic tokens as places in the text."""
    out: list[dict] = []
    if not (marginals >= 0.5).any():
        return out
    before = -2
    for i, (at, p) in enumerate(zip(WORDS.finditer(text), marginals.tolist(), strict=True)):
        if p < 0.5:
            continue
        if i == before + 1:
            out[-1] = {"start": out[-1]["start"], "stop": at.end(), "marginal": max(p, out[-1]["marginal"])}
        else:
            out.append({"start": at.start(), "stop": at.end(), "marginal": p})
        before = i
    return out


def tag(batches: Iterator[pa.RecordBatch], model, with_spans: bool) -> Iterator[pa.RecordBatch]:
    """Batches of (doc_id, text) with score and spans in place of the text."""
    m = model.value
    emission = Emission(m["weights"] if m else {})

    def work(texts: list[tuple[str, list[np.ndarray]]]) -> Iterator[tuple[float, list]]:
        chains = [c for _, cs in texts for c in cs]
        if not m or not chains:
            none = 0.0 if not m else float(1 / (1 + np.exp(-(m["scale"] * -15 + m["shift"]))))
            yield from [(none, [])] * len(texts)
            return
        first = np.zeros(sum(map(len, chains)), dtype=bool)
        first[np.cumsum([0, *map(len, chains[:-1])])] = True
        marginals = Chain(np.concatenate(chains), first, m["start"], m["move"]).marginals()
        at = 0
        for text, cs in texts:
            n = sum(map(len, cs))
            own = marginals[at : at + n]
            at += n
            begin = np.zeros(n, dtype=bool)
            begin[:1] = True
            x = float(any_toxic(own, begin)[0]) if n else -15.0
            yield float(1 / (1 + np.exp(-(m["scale"] * x + m["shift"])))), _spans(text, own) if with_spans else []

    names, types = ["doc_id", "score", "spans"], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("marginal", pa.float64())]))
    for batch in batches:
        found: list[tuple[float, list]] = []
        held: list[tuple[str, list[np.ndarray]]] = []
        size = 0
        for t in batch.column(1):
            text = t.as_py()
            chains = list(_chains(text, emission))
            held.append((text, chains))
            size += sum(map(len, chains))
            if size > 200_000:
                found += work(held)
                held, size = [], 0
        found += work(held)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], types)], names=names)


def score(docs: DataFrame, model: dict | None, doc_id: str = "doc_id", text: str = "text", with_spans: bool = True) -> DataFrame:
    """(doc_id, score, spans) of every row; spans are empty unless asked for."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text)).mapInArrow(remote(tag, sent, with_spans), f"doc_id long, score double, spans {SPAN}")


@query("op3_toxic_spans")
def _(spark, folder):
    def held_out():
        return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))

    docs = table(spark, folder, "documents")
    model = fit(docs, table(spark, folder, "labels").filter(~held_out()))
    scored = score(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "spans")
