"""Families of texts around the threshold, and windows that share a hash."""

from collections import defaultdict

import numpy as np
import pytest

from trialbook.llm import minhash, substring_dedup, suffix_dedup


def plain_links(sets):
    """All pairs (i, j) of similarity 0.75 or more, by counting common shingles."""
    where = defaultdict(list)
    for i, x in enumerate(sets):
        for v in x:
            where[v].append(i)
    common = defaultdict(int)
    for members in where.values():
        for k, a in enumerate(members):
            for b in members[k + 1 :]:
                common[a, b] += 1
    return [(a, b) for (a, b), n in common.items() if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]


def test_a_family_around_the_threshold_loses_no_link_and_lists_few_pairs(spark, monkeypatch):
    rng = np.random.default_rng(4)
    base = [f"w{k}" for k in range(140)]
    edits = [(int(p), f"edit{k}") for k, p in enumerate(rng.choice(140, 45, replace=False))]
    texts = []
    for _ in range(700):
        words = list(base)
        for k in rng.choice(len(edits), rng.integers(2, 7), replace=False):  # edits that many texts share
            words[edits[k][0]] = edits[k][1]
        texts.append(" ".join(words))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(136)} for t in texts]
    least = list(range(len(texts)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    links = plain_links(sets)
    for a, b in links:
        a, b = sorted((root(a), root(b)))
        least[b] = a
    listed = []
    plain = minhash.confirmed

    def counted(pairs, full):
        listed.append(pairs.count())
        return plain(pairs, full)

    monkeypatch.setattr(minhash, "confirmed", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_dedup(docs).collect()}
    assert got == {i: root(i) for i in range(len(texts))}
    assert 1 < len(set(got.values()))
    assert len(links) > 5000
    assert sum(listed) < 20 * len(texts)  # of 244,650 pairs


@pytest.mark.parametrize("one_hash", [False, True])
def test_windows_of_words_are_compared_as_words(monkeypatch, one_hash):
    if one_hash:
        monkeypatch.setattr(substring_dedup, "mix", np.zeros_like)
    rng = np.random.default_rng(5)
    words = [b"a", b"bb", b"c"]
    passage = [words[k] for k in rng.integers(0, 3, 40)]
    strings = [b" ".join(passage[a:b]) for a, b in ((0, 40), (5, 30), (7, 20), (20, 33))] + [b" ".join(words[k] for k in rng.integers(0, 3, 25))]
    owners = np.array([9, 4, 7, 1, 3])
    smallest = defaultdict(list)
    for s, owner in zip(strings, owners.tolist(), strict=True):
        parts = s.split()
        for k in range(len(parts) - 12):
            smallest[tuple(parts[k : k + 13])].append(owner)
    want = [min(smallest[tuple(s.split()[k : k + 13])]) for s in strings for k in range(len(s.split()) - 12)]
    counts, least = substring_dedup.compare(strings, owners)
    assert counts.tolist() == [len(s.split()) - 12 for s in strings]
    assert least.tolist() == want


def test_windows_of_bytes_meet_their_smallest_owner():
    rng = np.random.default_rng(6)
    passage = bytes(rng.choice(list(b"ab"), 400))
    strings = [passage[a:b] for a, b in ((0, 400), (30, 200), (31, 120), (150, 399))] + [bytes(rng.choice(list(b"ab"), 300))]
    owners = np.array([9, 4, 7, 1, 3])
    smallest = defaultdict(list)
    for s, owner in zip(strings, owners.tolist(), strict=True):
        for k in range(len(s) - 49):
            smallest[s[k : k + 50]].append(owner)
    counts, least = suffix_dedup.compare(strings, owners)
    assert counts.tolist() == [len(s) - 49 for s in strings]
    assert least.tolist() == [min(smallest[s[k : k + 50]]) for s in strings for k in range(len(s) - 49)]
