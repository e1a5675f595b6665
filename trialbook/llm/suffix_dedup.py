"""Suffix-array dedup of bytes by deep-shallow sorting.

Suffixes matter here up to 50 bytes. They meet by minimiser (see ``windows``): the suffixes of one
text that share the smallest hashed 24-byte gram travel as one packed string. In a bucket the
suffixes of strings that differ but share a minimiser are sorted: to a shallow depth of 16 bytes by
a multikey sort whose characters are eight bytes wide, and groups with a longer common prefix by
blind tries, which look at the branching bytes only and compare one whole string per insertion. A
group that equals its first member to the full depth is a trie of one leaf and is taken as such.

A byte is removed when a 50-byte string over it starts in a document with a smaller id too. A null
or short text has no such string and stays as it is; see ``windows`` for null ids and repeated rows.
Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trialbook.llm import query, windows
from trialbook.llm.minhash import mix
from trialbook.llm.text import table

WIDTH, GRAM, SHALLOW = 50, 24, 16
SEGMENT = 1 << 16  # windows of a text worked on at a time


def eights(b: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number whose order is theirs."""
    twos = (b[:-1].astype(np.uint64) << np.uint64(8)) | b[1:]
    fours = (twos[:-2] << np.uint64(16)) | twos[2:]
    return (fours[:-4] << np.uint64(32)) | fours[4:]


def byte_grams(b: np.ndarray) -> np.ndarray:
    if len(b) < GRAM:
        return np.empty(0, dtype=np.uint64)
    x, n = eights(b), len(b) - GRAM + 1
    total = np.zeros(n, dtype=np.uint64)
    for k in range(0, GRAM, 8):
        total = (total + x[k : n + k]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(31)
    return mix(total)


def text_grams(text: bytes) -> np.ndarray:
    return byte_grams(np.frombuffer(text, dtype=np.uint8))


def _parts(text: bytes, frequent: np.ndarray | None) -> Iterator[tuple[int, np.ndarray]]:
    """(first byte, minimiser per window) of each segment of a text."""
    b = np.frombuffer(text, dtype=np.uint8)
    for at in range(0, len(b) - WIDTH + 1, SEGMENT):
        yield at, windows.least_of(windows.ordered(byte_grams(b[at : at + SEGMENT + WIDTH - 1]), frequent), WIDTH - GRAM + 1)


def values(text: bytes, frequent: np.ndarray | None) -> Iterator[np.ndarray]:
    """Minimisers of the runs of windows of a text."""
    for _, found in _parts(text, frequent):
        yield found[windows.runs(found)[0]]


def split(text: bytes, frequent: np.ndarray | None, travels: Callable | None = None) -> Iterator[tuple[int, bytes, int]]:
    """(minimiser, packed bytes, first byte) of each run of suffixes, of those that ``travels`` picks by their minimisers."""
    for at, found in _parts(text, frequent):
        first, last = windows.runs(found)
        if travels is not None:
            picked = travels(found[first])
            first, last = first[picked], last[picked]
        for key, i, j in zip(found[first].tolist(), (first + at).tolist(), (last + at + WIDTH).tolist(), strict=True):
            yield key, text[i:j], i


class BlindTrie:
    """Strings of one length by their branching bytes. Inner nodes are (depth, children), leaves (string, places)."""

    def __init__(self, string: bytes, place: int):
        self.root: list = [None, string, [place]]

    def insert(self, string: bytes, place: int) -> None:
        node = self.root
        while node[0] is not None:
            node = node[1].get(string[node[0]]) or next(iter(node[1].values()))
        if node[1] == string:
            node[2].append(place)
            return
        apart = int.from_bytes(node[1]) ^ int.from_bytes(string)
        depth = len(string) - (apart.bit_length() + 7) // 8
        other = node[1][depth]
        above, node = None, self.root
        while node[0] is not None and node[0] < depth:
            above, node = node, node[1][string[node[0]]]
        leaf = [None, string, [place]]
        if node[0] == depth:
            node[1][string[depth]] = leaf
            return
        inner = [depth, {other: node, string[depth]: leaf}]
        if above is None:
            self.root = inner
        else:
            above[1][string[above[0]]] = inner

    def leaves(self) -> Iterator[list[int]]:
        """The places of equal strings, in the order of the strings."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node[0] is None:
                yield node[2]
            else:
                stack += [child for _, child in sorted(node[1].items(), reverse=True)]


def shallow(buffer: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of the suffixes by their first bytes, where each group of equal ones begins in it, and which groups
    are equal to the full depth."""
    x = eights(np.frombuffer(buffer, dtype=np.uint8))
    order = np.lexsort([x[starts + d] for d in range(SHALLOW - 8, -1, -8)])
    at = starts[order]
    same = np.ones(len(at) - 1, dtype=bool)
    for d in range(0, SHALLOW, 8):
        same &= x[at[1:] + d] == x[at[:-1] + d]
    begin = np.flatnonzero(np.append(True, ~same))
    head = np.repeat(at[begin], np.diff(np.append(begin, len(at))))
    equal = np.ones(len(at), dtype=bool)
    for d in [*range(SHALLOW, WIDTH - 8, 8), WIDTH - 8]:
        equal &= x[at + d] == x[head + d]
    return order, begin, np.logical_and.reduceat(equal, begin)


def deep(buffer: bytes, starts: np.ndarray, members: np.ndarray) -> Iterator[list[int]]:
    """The equal ones among suffixes that agree to the shallow depth, in order, through a blind trie."""
    trie = None
    for m, at in zip(members.tolist(), starts[members].tolist(), strict=True):
        string = buffer[at : at + WIDTH]
        if trie is None:
            trie = BlindTrie(string, m)
        else:
            trie.insert(string, m)
    yield from trie.leaves()


def sorted_groups(buffer: bytes, starts: np.ndarray) -> Iterator[np.ndarray]:
    """Indexes into ``starts`` of equal suffixes, group by group, for groups of two or more in order."""
    order, begin, whole = shallow(buffer, starts)
    for a, b, one in zip(begin.tolist(), [*begin[1:].tolist(), len(order)], whole.tolist(), strict=True):
        if one and b - a > 1:
            yield order[a:b]
        elif not one:
            yield from (np.array(leaf) for leaf in deep(buffer, starts, order[a:b]) if len(leaf) > 1)


def compare(strings: list[bytes], owners: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
    """The number of windows of each string and, given owners, the smallest owner of each window."""
    counts = np.array([len(s) - WIDTH + 1 for s in strings], dtype=np.int64)
    if owners is None:
        return counts, None
    buffer = b"".join(strings) + bytes(8)
    begins = np.cumsum([0, *map(len, strings[:-1])])
    first = np.cumsum(np.append(0, counts[:-1]))
    starts = np.arange(counts.sum()) + np.repeat(begins - first, counts)
    owner = np.repeat(owners, counts)
    order, begin, whole = shallow(buffer, starts)
    sizes = np.diff(np.append(begin, len(order)))
    least = np.empty(len(owner), dtype=np.int64)
    least[order] = np.repeat(np.minimum.reduceat(owner[order], begin), sizes)
    for g in np.flatnonzero(~whole).tolist():
        members = order[begin[g] : begin[g] + sizes[g]]
        for leaf in deep(buffer, starts, members):
            least[leaf] = owner[leaf[0]] if len(leaf) == 1 else owner[leaf].min()
    return counts, least


def strip(ids: list, texts: pa.ChunkedArray, spans: list, with_bytes: bool) -> pa.Table:
    """Rows without the bytes of their spans."""
    rows = []
    for one, t, found in zip(ids, texts, spans, strict=True):
        text = kept = t.as_py().encode()
        removed = runs = 0
        if found is not None:
            first, last = found
            removed, runs = int((last - first).sum()), len(first)
            kept = b"".join(text[a:b] for a, b in zip([0, *last.tolist()], [*first.tolist(), len(text)], strict=True))
        rows.append((one, len(text), removed, runs, hashlib.sha256(kept).hexdigest(), *[kept] * with_bytes))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_bytes]
    types = [*[pa.int64()] * 4, pa.string(), *[pa.binary()] * with_bytes]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def suffix_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_bytes: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) of every row."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_bytes else "")
    return windows.without_repeats(windows.identified(docs, doc_id, text), sys.modules[__name__], WIDTH, schema, with_bytes)


@query("op4_suffix_array_dedup")
def _(spark, folder):
    return suffix_dedup(table(spark, folder, "documents"), with_bytes=False)
