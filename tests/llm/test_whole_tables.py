"""Queries over a whole given table against plain versions of their methods."""

import math
import re
import zlib
from collections import Counter, defaultdict

from trialbook.llm import QUERIES, langid

from test_small_tables import plain_components


def plain_languages(rows):
    """Word-first backoff in dictionaries: (prediction, score) per document."""
    learned = defaultdict(set)
    for i, text, lang in rows:
        if zlib.crc32(str(i).encode()) % 5 and lang is not None and re.search(r"[^\W\d_]", text or ""):
            learned[lang].add(text)
    short = {lang: {t for t in texts if len(t) <= langid.SAMPLE_CHARS} or texts for lang, texts in learned.items()}
    counts = {}
    for lang, texts in short.items():
        words = Counter(w for t in texts for w in langid.LETTERS.findall(t.lower()))
        counts[lang, 0] = words
        for size in langid.GRAMS:
            counts[lang, size] = Counter()
            for w, n in words.items():
                for k in range(len(w) - size + 1):
                    counts[lang, size][w[k : k + size]] += n
    langs = sorted(short)
    total = {key: math.log(sum(c.values()) + len(c) + 1) for key, c in counts.items()}
    floor = {size: max(total[lang, size] for lang in langs) for size in (0, *langid.GRAMS)}

    def above(size, gram):
        """Log frequencies above the floor of the length, which all languages have for what they were not seen with."""
        return [math.log(counts[lang, size][gram] + 1) - total[lang, size] + floor[size] if gram in counts[lang, size] else 0.0 for lang in langs]

    def known(size, gram):
        return any(gram in counts[lang, size] for lang in langs)

    def parts(text, level):
        if level == len(langid.GRAMS):
            return [[0.0] * len(langs) for _ in text]
        size = langid.GRAMS[level]
        if len(text) < size:
            return parts(text, level + 1)
        out, run = [], None
        for k in range(len(text) - size + 2):
            here = k <= len(text) - size and known(size, text[k : k + size])
            if k > len(text) - size or here:
                if run is not None:
                    out += parts(text[run : k - 1 + size], level + 1)
                    run = None
                if here:
                    out.append(above(size, text[k : k + size]))
            elif run is None:
                run = k
        return out

    memory = {}

    def score(word):
        if word not in memory:
            found = [above(0, word)] if known(0, word) else parts(word, 0)
            memory[word] = [sum(c) / len(found) for c in zip(*found, strict=True)]
        return memory[word]

    out = {}
    for i, text, _ in rows:
        words = [score(w) for w in langid.LETTERS.findall((text or "").lower())]
        if not words:
            out[i] = ("und", 0.0)
            continue
        sums = [sum(c) for c in zip(*words, strict=True)]
        best = sums.index(max(sums))
        shares = [math.exp(w[best] - max(w)) / sum(math.exp(x - max(w)) for x in w) for w in words]
        out[i] = (langs[best], sum(shares) / len(shares))
    return out


def test_language_id(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang").collect()]
    want = plain_languages(rows)
    got = QUERIES["op1_language_id"](spark, folder).collect()
    assert len(got) == len(rows)
    for r in got:
        lang, score = want[r["doc_id"]]
        assert r["lang_pred"] == lang and math.isclose(r["score"], score, rel_tol=1e-6, abs_tol=1e-9)


def test_near_duplicates_lose_no_link(spark):
    """Every component of 1,000 documents, from all pairs: recall 1."""
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: (n, c) for i, n, c in plain_components(rows)}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op2_minhash_near_dedup"](spark, folder).collect()}
    assert got == want and sum(c != i for i, (_, c) in want.items()) > 50
