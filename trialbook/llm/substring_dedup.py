"""Substring dedup by super-k-mers of words.

A window is 13 consecutive words. Windows with the same minimiser (the smallest of their hashed
four-word grams) travel packed to its bucket, where the windows of all strings of one minimiser are
sorted and equal ones compared as words. A word is removed when a window over it starts in a
document with a smaller id too. See ``windows`` for places, nulls and repeated rows; a null or short
text has no window and stays as it is. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trialbook.llm import query, windows
from trialbook.llm.minhash import WordHash, mix
from trialbook.llm.text import table

WIDTH, GRAM = 13, 4
SEGMENT = 4_000_000  # bytes of a text that are split into words at a time
BLANKS = b" \t\n\v\f\r"
_HASHES = WordHash()


def segments(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a segment at a time; segments are cut at blanks."""
    at = 0
    while at < len(text):
        stop = min(at + SEGMENT, len(text))
        while stop < len(text) and text[stop] not in BLANKS:
            stop += 1
        if words := text[at:stop].split():
            yield words
        at = stop


def word_grams(words: list[bytes]) -> np.ndarray:
    h = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    n = len(words) - GRAM + 1
    total = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(GRAM if n > 0 else 0):
        total = (total + h[k : n + k]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(31)
    return mix(total)


def text_grams(text: bytes) -> np.ndarray:
    return word_grams(text.split())


def _parts(text: bytes, frequent: np.ndarray | None) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """(first word, words, minimiser per window) of each segment, which repeats the last words of the one before."""
    carried: list[bytes] = []
    base = 0
    for words in segments(text):
        words = carried + words
        if len(words) >= WIDTH:
            yield base, words, windows.least_of(windows.ordered(word_grams(words), frequent), WIDTH - GRAM + 1)
        keep = min(len(words), WIDTH - 1)
        base += len(words) - keep
        carried = words[len(words) - keep :]


def values(text: bytes, frequent: np.ndarray | None) -> Iterator[np.ndarray]:
    """Minimisers of the windows of a text."""
    for _, _, found in _parts(text, frequent):
        yield found


def split(text: bytes, frequent: np.ndarray | None, travels: Callable | None = None) -> Iterator[tuple[int, bytes, int]]:
    """(minimiser, packed words, first word) of each super-k-mer, of those that ``travels`` picks by their minimisers."""
    for base, words, found in _parts(text, frequent):
        first, last = windows.runs(found)
        if travels is not None:
            picked = travels(found[first])
            if not len(picked):
                continue
            first, last = first[picked], last[picked]
        for key, i, j in zip(found[first].tolist(), first.tolist(), (last + WIDTH).tolist(), strict=True):
            yield key, b" ".join(words[i:j]), base + i


def compare(strings: list[bytes], owners: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
    """The number of windows of each string and, given owners, the smallest owner of each window.

    Windows are sorted by a hash of the numbers of their words; neighbours of one hash are compared word by word.
    """
    counts = np.array([s.count(b" ") + 2 - WIDTH for s in strings], dtype=np.int64)
    if owners is None:
        return counts, None
    number = pa.array(b" ".join(strings).split(b" "), pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.uint64)
    starts = np.arange(counts.sum()) + np.repeat(np.arange(len(counts)) * (WIDTH - 1), counts)
    hashed = np.zeros(len(number) - WIDTH + 1, dtype=np.uint64)
    for k in range(WIDTH):
        hashed = (hashed + number[k : k + len(hashed)]) * np.uint64(0x9E3779B97F4A7C15)
        hashed ^= hashed >> np.uint64(29)
    hashed = mix(hashed)[starts]
    order = np.argsort(hashed, kind="stable")
    hashed, at = hashed[order], starts[order]
    begin = np.flatnonzero(np.append(True, hashed[1:] != hashed[:-1]))
    sizes = np.diff(np.append(begin, len(order)))
    head = np.repeat(at[begin], sizes)
    same = np.ones(len(at), dtype=bool)
    for k in range(WIDTH):
        same &= number[at + k] == number[head + k]
    owner = np.repeat(owners, counts)
    least = np.empty(len(owner), dtype=np.int64)
    least[order] = np.repeat(np.minimum.reduceat(owner[order], begin), sizes)
    for g in np.flatnonzero(~np.logical_and.reduceat(same, begin)).tolist():  # different windows of one hash
        members = order[begin[g] : begin[g] + sizes[g]]
        _, which = np.unique(number[starts[members][:, None] + np.arange(WIDTH)], axis=0, return_inverse=True)
        smallest = np.full(which.max() + 1, windows.NULL_ID)
        np.minimum.at(smallest, which.ravel(), owner[members])
        least[members] = smallest[which.ravel()]
    return counts, least


def strip(ids: list, texts: pa.ChunkedArray, spans: list, with_text: bool) -> pa.Table:
    """Rows without the words of their spans."""
    rows = []
    for one, t, found in zip(ids, texts, spans, strict=True):
        words = t.as_py().encode().split()
        n, removed, runs = len(words), 0, 0
        if found is not None:
            first, last = found
            removed, runs = int((last - first).sum()), len(first)
            words = [w for a, b in zip([0, *last.tolist()], [*first.tolist(), n], strict=True) for w in words[a:b]]
        kept = b" ".join(words)
        rows.append((one, n, removed, runs, hashlib.sha256(kept).hexdigest(), *[kept.decode()] * with_text))
    names = ["doc_id", "n_words", "n_removed", "n_spans", "kept_sha256", *["kept_text"] * with_text]
    types = [*[pa.int64()] * 4, *[pa.string()] * (1 + with_text)]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, n_spans, kept_sha256[, kept_text]) of every row."""
    schema = "doc_id long, n_words long, n_removed long, n_spans long, kept_sha256 string" + (", kept_text string" if with_text else "")
    return windows.without_repeats(windows.identified(docs, doc_id, text), sys.modules[__name__], WIDTH, schema, with_text)


@query("op7_substring_dedup")
def _(spark, folder):
    return substring_dedup(table(spark, folder, "documents"), with_text=False)
