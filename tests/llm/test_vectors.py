"""Vector codes and hard negatives against brute force, on tables of odd rows and a hot vector."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from trialbook.llm import hard_negatives, vector_codes
from trialbook.llm.text import table

CLASH = ["n", "part", "row", "slot", "rank", "score", "v", "x", "codes", "error", "label_error", "windows", "block", "anchors", "of_label"]
SCHEMA = "vec_id long, embedding array<float>, label int"


def made(seed, n=400, dims=16):
    """Vectors with repeated rows, a third of them equal, odd components and nulls everywhere."""
    rng = np.random.default_rng(seed)
    hot = rng.normal(0, 0.3, dims).astype("float32").tolist()
    rows = []
    for i in range(n):
        v = hot if i % 3 == 1 else rng.normal(0, 0.3, dims).astype("float32").tolist()
        rows.append((i, v, None if i % 41 == 5 else int(rng.integers(0, 4))))
    rows += [(n, None, 1), (n + 1, [math.nan, *hot[1:]], 1), (n + 2, [*hot[1:], math.inf], 1), (n + 3, [None, *hot[1:]], 1), (n + 4, [], 1)]
    return [*rows, rows[7], rows[7], (None, rows[2][1], 2), (None, hot, None)]


@pytest.fixture(scope="module", params=[1, 2])
def rows(request):
    return made(request.param)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in CLASH}).repartition(6)


def usable(rows, scale):
    ok = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    return [(i, [math.floor(scale * x) for x in v], c) for i, v, c in ok]


# -- vector codes


def plain_codes(rows, parts, entries, rounds):
    kept = sorted(usable(rows, 4096), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([v for _, v, _ in kept], dtype=np.int64).reshape(len(kept), parts, -1)
    books = [x[:entries, p].copy() for p in range(parts)]

    def nearest(p):
        d = ((x[:, p, None] - books[p][None]) ** 2).sum(axis=2)
        return d.argmin(axis=1), d.min(axis=1)

    for _ in range(rounds):
        for p in range(parts):
            at, _ = nearest(p)
            for j in set(at.tolist()):
                own = x[at == j, p]
                books[p][j] = [int(s) // len(own) for s in own.sum(axis=0)]
    found = [nearest(p) for p in range(parts)]
    return [(i, tuple(int(a[k]) for a, _ in found), int(sum(d[k] for _, d in found))) for k, (i, _, _) in enumerate(kept)], [b.tolist() for b in books]


@pytest.mark.parametrize("cell_bits", [6, 9, 12])
def test_codes(spark, rows, cell_bits):
    v, books = vector_codes.codebooks(vector_codes.vectors(frame(spark, rows)), parts=8, cell_bits=cell_bits)
    want, want_books = plain_codes(rows, 8, 16, 6)
    assert books == want_books
    got = [(r["vec_id"], tuple(r["codes"]), r["error"]) for r in vector_codes.coded(v, books, cell_bits).collect()]
    assert Counter(got) == Counter(want)


def test_cells_leave_out_only_dominated_entries():
    rng = np.random.default_rng(3)
    for dims, bits in ((1, 3), (2, 4), (8, 9)):
        book = rng.integers(-1000, 1000, (16, dims))
        book[9] = book[4]  # ties go to the lower index
        assigner = vector_codes.Assigner(book, bits)
        x = np.concatenate([rng.integers(-1200, 1200, (3000, dims)), book])
        for _ in range(2):  # the second time from memory
            index, distance = assigner(x)
            d = ((x[:, None] - book[None]) ** 2).sum(axis=2)
            assert (index == d.argmin(axis=1)).all() and (distance == d.min(axis=1)).all()
        assert assigner.evaluated < 2 * 16 * len(x)


def test_a_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(vector_codes, "CELLS", 50)
    rng = np.random.default_rng(4)
    book, x = rng.integers(-500, 500, (5, 3)), rng.integers(-900, 900, (2000, 3))
    assigner = vector_codes.Assigner(book, 6)
    for part in np.split(x, 10):
        index, _ = assigner(part)
        assert (index == ((part[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
        assert len(assigner.cells) <= 50


def test_codes_of_few_and_of_no_vectors(spark, rows):
    some = frame(spark, rows[:3])
    v, books = vector_codes.codebooks(vector_codes.vectors(some))
    assert [len(b) for b in books] == [3] * 8
    assert {r["error"] for r in vector_codes.coded(v, books).collect()} == {0}
    v, books = vector_codes.codebooks(vector_codes.vectors(some.filter("false")))
    assert books == [] and vector_codes.coded(v, books).collect() == []
    with pytest.raises(Exception, match="beyond"):
        vector_codes.vectors(frame(spark, [(1, [1e9] * 8, 1)]))


def test_labels_share_their_errors(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    from trialbook.llm import QUERIES

    got = QUERIES["op12_vector_codes"](spark, str(tmp_path)).collect()
    want, books = plain_codes(rows, 8, 16, 6)
    kept = sorted(usable(rows, 4096), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    totals = defaultdict(int)
    for (_, _, c), (_, _, e) in zip(kept, want, strict=True):
        totals[c] += e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    assert Counter(tuple(r) for r in got) == Counter((i, "".join(f"{c:02x}" for c in codes), e, totals[label], sha) for (_, _, label), (i, codes, e) in zip(kept, want, strict=True))


# -- hard negatives


def plain_negatives(rows, k=5):
    kept = [(i, v, (c + 1) % 10 if i is not None and i % 7 == 0 else c) for i, v, c in usable(rows, 256) if c is not None]
    last = math.inf
    out = []
    for a, av, ac in kept:
        if a is None or a % 10:
            continue
        scored = sorted(((-int(np.dot(av, v)), last if i is None else i, c) for i, v, c in kept if i != a), key=lambda r: r[:2])
        for s, p, _ in [r for r in scored if r[2] == ac][:k]:
            fit = [(n, t) for t, n, c in scored if c != ac and 80 * -s <= 100 * -t <= 100 * -s][:k]
            out += [(a, None if p == last else p, rank, None if n == last else n, -s, -t) for rank, (n, t) in enumerate(fit, 1)]
    return out


@pytest.mark.parametrize("block_rows, anchor_block", [(4096, 256), (16, 3)])
def test_negatives(spark, rows, monkeypatch, block_rows, anchor_block):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", anchor_block)
    monkeypatch.setattr(hard_negatives, "GROUP_ROWS", 64)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    taking = hard_negatives.taking_part(frame(spark, rows), label)
    got = [tuple(r) for r in hard_negatives.hard_negatives(taking, F.col("vec_id") % 10 == 0).collect()]
    assert len(got) > 50
    assert Counter(got) == Counter(plain_negatives(rows))


def test_the_scan_reads_few_dimensions_of_far_rows():
    """Rows that cannot enter a list leave it after their first dimensions."""
    rng = np.random.default_rng(5)
    near, far = rng.integers(90, 110, (64, 50)), rng.integers(-20, 20, (64, 4000))
    columns = np.concatenate([near, far], axis=1).astype("<i4")
    n = columns.shape[1]
    block = hard_negatives.Block(n, np.zeros(n, dtype=np.int64).tobytes(), np.arange(1, n + 1).tobytes(), columns.tobytes())
    v = rng.integers(50, 100, 64)
    scan = hard_negatives.Scan(0, 0, v, [(-np.inf, np.inf)], 5, True)
    scan.scan(block)
    scores = v @ columns
    want = np.lexsort((np.arange(1, n + 1), -scores))[:5]
    assert scan.lists[0][0].tolist() == (want + 1).tolist() and scan.lists[0][1].tolist() == scores[want].tolist()
    assert scan.read < 0.8 * 64 * n


def test_no_vectors_no_negatives(spark, rows):
    none = hard_negatives.taking_part(frame(spark, rows).filter("false"), F.col("label"))
    assert hard_negatives.hard_negatives(none, F.col("vec_id") % 10 == 0).collect() == []
    one = hard_negatives.taking_part(frame(spark, rows[:1]), F.col("label"))
    assert hard_negatives.hard_negatives(one, F.col("vec_id") % 10 == 0).collect() == []
    with pytest.raises(Exception, match="beyond"):
        hard_negatives.taking_part(frame(spark, [(1, [1e9] * 8, 1)]), F.col("label"))


def test_the_given_table(spark):
    """Every anchor of sf0.1 against plain products."""
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.1", "embeddings").select("vec_id", "embedding", "label").collect()]
    x = np.array([[math.floor(256 * c) for c in v] for _, v, _ in rows])
    ids, labels = np.array([r[0] for r in rows]), np.array([(r[2] + 1) % 10 if r[0] % 7 == 0 else r[2] for r in rows])
    want = set()
    for a in np.flatnonzero(ids % 100 == 0):
        s = x @ x[a]
        order = np.lexsort((ids, -s))
        for p in [i for i in order if labels[i] == labels[a] and i != a][:5]:
            fit = [i for i in order if labels[i] != labels[a] and 80 * s[p] <= 100 * s[i] <= 100 * s[p]][:5]
            want |= {(int(ids[a]), int(ids[p]), k, int(ids[i]), int(s[p]), int(s[i])) for k, i in enumerate(fit, 1)}
    from trialbook.llm import QUERIES

    assert {tuple(r) for r in QUERIES["op13_hard_negatives"](spark, "/root/testdata/sf0.1").collect()} == want
