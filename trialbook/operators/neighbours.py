"""Exact nearest neighbours without comparing all pairs.

Equal vectors of a fold are one candidate and one question, so copies cost nothing. A bounded number of pivots cuts the
rest into cells, each with its least and largest distance to its pivot. A question is first answered in its own cell.
The triangle inequality then tells which other cells may hold something nearer, and within a cell, whose rows are sorted
by the distance to the pivot, which stretch may. Rows travel as packed blocks of bounded size. Blocks of rows and blocks of
questions are dealt to parts of bounded size, and a task compares one part of each, so a row travels once per part and
not once per cell, and no task holds a whole cell. Distances of two blocks come from one product of matrices; those that
rounding could have made the least are computed again from the differences, so results do not depend on it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialbook.plans.scan import join_groups
from trialbook.session import stage

MOST_PIVOTS, BLOCK_ROWS, SALT_ROWS = 512, 1024, 65_536
# Rows of a part, and the number of parts that fewer rows are dealt to.
PART_ROWS, LEAST_PARTS = 32_768, 8
# Pairs of rows whose distances are computed again at once.
EXACT_ROWS = 65_536
# Bounds from the triangle inequality give way by this share, for rounding.
SLACK = 1e-9
BLOCK = "cell int, n int, keys binary, folds binary, away binary, bounds binary, vectors binary"
FOUND = "key long, square double, neighbour long"


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


def _batch(columns: Sequence, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def assign(batches: Iterator[pa.RecordBatch], pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(key, fold, v) with the nearest pivot and the distance to it."""
    for batch in batches:
        d = _distances(_matrix(batch.column("v")), pivots) if batch.num_rows else np.zeros((0, 1))
        cell = d.argmin(axis=1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(cell)), cell])], names=[*batch.schema.names, "cell", "away"])


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, key, fold, away, bound, v), sorted by cell and distance, as blocks."""
    schema = pa.schema([("cell", pa.int32()), ("n", pa.int32()), *[(c, pa.binary()) for c in ("keys", "folds", "away", "bounds", "vectors")]])
    for batch in batches:
        if not batch.num_rows:
            continue
        cells = batch.column("cell").to_numpy()
        numbers = [batch.column(c).to_numpy().astype(t) for c, t in (("key", "<i8"), ("fold", "<i8"), ("away", "<f8"), ("bound", "<f8"))]
        x = _matrix(batch.column("v"))
        edges = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
        for low, high in zip(edges, edges[1:], strict=False):
            for at in range(low, high, BLOCK_ROWS):
                some = slice(at, min(at + BLOCK_ROWS, high))
                yield _batch([[int(cells[at])], [some.stop - at], *[[a[some].tobytes()] for a in numbers], [x[some].tobytes()]], schema)


class Block:
    def __init__(self, n: int, keys: bytes, folds: bytes, away: bytes, bounds: bytes, vectors: bytes):
        self.keys, self.folds = np.frombuffer(keys, "<i8"), np.frombuffer(folds, "<i8")
        self.away, self.bounds = np.frombuffer(away, "<f8"), np.frombuffer(bounds, "<f8")
        self.vectors = np.frombuffer(vectors, "<f8").reshape(n, -1)
        with np.errstate(over="ignore"):
            self.norms = (self.vectors**2).sum(axis=1)


class Questions:
    """A block of questions with the nearest row of another fold so far: its squared distance, and its key (the least of equals)."""

    def __init__(self, block: Block):
        self.block, n = block, len(block.keys)
        self.square, self.neighbour = block.bounds.copy(), np.full(n, -1, dtype=np.int64)
        self.compared = 0

    def ask(self, rows: Block, away: np.ndarray | None = None, some: np.ndarray | None = None) -> None:
        """Compare with the rows of a cell; ``away`` are the distances to its pivot (default: that of the block), ``some`` the questions to ask."""
        away = self.block.away if away is None else away
        reach = np.sqrt(self.square) * (1 + SLACK) + SLACK
        first, last = np.searchsorted(rows.away, away - reach), np.searchsorted(rows.away, away + reach, side="right")
        asked = np.flatnonzero(first < last if some is None else some & (first < last))
        self._ask(rows, asked[np.argsort(away[asked], kind="stable")], first, last)

    def _ask(self, rows: Block, asked: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        """Questions with much the same stretch are answered together, others in halves."""
        if not len(asked):
            return
        low, high = first[asked].min(), last[asked].max()
        if len(asked) > 8 and 2 * (last[asked] - first[asked]).sum() < len(asked) * (high - low):
            half = len(asked) // 2
            self._ask(rows, asked[:half], first, last)
            self._ask(rows, asked[half:], first, last)
            return
        self.compared += len(asked) * int(high - low)
        b, part = self.block, slice(low, high)
        x, y = b.vectors[asked], rows.vectors[part]
        with np.errstate(all="ignore"):
            square = (b.norms[asked][:, None] + rows.norms[part]) - 2 * (x @ y.T)
            # What rounding may have changed, at most; without a bound every pair is computed again.
            error = (2 * x.shape[1] + 16) * np.finfo(float).eps * (np.sqrt(b.norms[asked]) + np.sqrt(rows.norms[part].max())) ** 2
        certain = np.isfinite(error)
        square[~certain] = 0
        error[~certain] = 0
        square[b.folds[asked][:, None] == rows.folds[part]] = np.inf
        least = square.min(axis=1)
        alive = np.flatnonzero((least - error <= self.square[asked]) & (least < np.inf))
        i, j = np.nonzero(square[alive] <= (least + 2 * error)[alive, None])
        i = alive[i]
        for at in range(0, len(i), EXACT_ROWS):
            self._settle(asked[i[at : at + EXACT_ROWS]], j[at : at + EXACT_ROWS] + low, rows)

    def _settle(self, i: np.ndarray, j: np.ndarray, rows: Block) -> None:
        """The questions ``i`` against the rows ``j``, pair by pair."""
        with np.errstate(all="ignore"):
            exact = ((rows.vectors[j] - self.block.vectors[i]) ** 2).sum(axis=1)
        exact[np.isnan(exact)] = np.inf
        keys = rows.keys[j]
        order = np.lexsort((keys, exact, i))
        order = order[np.flatnonzero(np.diff(i[order], prepend=-1))]
        i, exact, keys = i[order], exact[order], keys[order]
        old = self.neighbour[i]
        nearer = (exact < self.square[i]) | ((exact == self.square[i]) & (exact < np.inf) & ((old < 0) | (keys < old)))
        self.square[i[nearer]], self.neighbour[i[nearer]] = exact[nearer], keys[nearer]


def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For pairs of blocks of questions and of rows: the nearest row of each question among those of this task."""
    schema = pa.schema([("key", pa.int64()), ("square", pa.float64()), ("neighbour", pa.int64())])
    here, asked = None, None
    names = ("n", "keys", "folds", "away", "bounds", "vectors")

    def found() -> pa.RecordBatch:
        known = asked.neighbour >= 0
        return _batch([asked.block.keys[known], asked.square[known], asked.neighbour[known]], schema)

    for batch in batches:
        for i in range(batch.num_rows):
            value = {c: batch.column(f"q_{c}")[i].as_py() for c in names}
            if here != (batch.column("cell")[i].as_py(), value["keys"]):
                if asked is not None:
                    yield found()
                here, asked = (batch.column("cell")[i].as_py(), value["keys"]), Questions(Block(**value))
            asked.ask(Block(**{c: batch.column(c)[i].as_py() for c in names}))
    if asked is not None:
        yield found()


def _near(vectors: np.ndarray, square: np.ndarray, pivots: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distances to pivots, which of their cells may hold a row within the bound)."""
    d = _distances(vectors, pivots)
    reach = (np.sqrt(square) * (1 + SLACK) + SLACK)[:, None]
    return d, (d - most <= reach) & (least - d <= reach)


def _questions(batch: pa.RecordBatch | pa.Table, i: int) -> Block:
    return Block(**{c: batch.column(c)[i].as_py() for c in ("n", "keys", "folds", "away", "bounds", "vectors")})


def visits(batches: Iterator[pa.RecordBatch], pivots: np.ndarray, least: np.ndarray, most: np.ndarray, parts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Blocks of questions, once for every part with a cell other than their own that may hold a row within the bound of one of
    them; ``parts`` are the first and last part of each cell."""
    for batch in batches:
        for i in range(batch.num_rows):
            block = _questions(batch, i)
            near = _near(block.vectors, block.bounds, pivots, least, most)[1].any(axis=0)
            near[batch.column("cell")[i].as_py()] = False
            wanted = sorted({p for low, high in parts[near].tolist() for p in range(low, high + 1)})
            for at in range(0, len(wanted), 8):
                some = wanted[at : at + 8]
                taken = batch.take(pa.array([i] * len(some)))
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *taken.columns], names=["part", *taken.schema.names])


def compare(questions: pa.Table, rows: pa.Table, pivots: np.ndarray, least: np.ndarray, most: np.ndarray) -> pa.Table:
    """The nearest row of each question of a part among the rows of a part, but for those of its own cell."""
    schema = pa.schema([("key", pa.int64()), ("square", pa.float64()), ("neighbour", pa.int64())])
    blocks: dict[int, list[Block]] = {}
    for i in range(rows.num_rows):
        blocks.setdefault(rows.column("cell")[i].as_py(), []).append(_questions(rows, i))
    cells = np.array(sorted(blocks), dtype=int)
    found = []
    for i in range(questions.num_rows if len(cells) else 0):
        asked = Questions(_questions(questions, i))
        own = questions.column("cell")[i].as_py()
        d, _ = _near(asked.block.vectors, asked.square, pivots[cells], least[cells], most[cells])
        # Near cells first, so that the bounds shrink early.
        for at in np.argsort((d - most[cells]).mean(axis=0), kind="stable"):
            if cells[at] != own:
                reach = np.sqrt(asked.square) * (1 + SLACK) + SLACK
                some = (d[:, at] - most[cells[at]] <= reach) & (least[cells[at]] - d[:, at] <= reach)
                if some.any():
                    for block in blocks[int(cells[at])]:
                        asked.ask(block, d[:, at], some)
        known = asked.neighbour >= 0
        found.append(_batch([asked.block.keys[known], asked.square[known], asked.neighbour[known]], schema))
    return pa.Table.from_batches(found, schema)


def _blocks(rows: DataFrame, salts: int) -> DataFrame:
    dealt = rows.repartition("cell", F.pmod(F.xxhash64("key"), F.lit(salts))).sortWithinPartitions("cell", "away")
    return dealt.select("cell", "key", "fold", "away", "bound", "v").mapInArrow(pack, BLOCK)


def _asked(questions: DataFrame, rows: DataFrame) -> DataFrame:
    """Answers of all pairs of blocks of one cell; the join streams the blocks of questions."""
    q = questions.withColumnsRenamed({c: f"q_{c}" for c in ("n", "keys", "folds", "away", "bounds", "vectors")})
    return q.hint("merge").join(rows, "cell").mapInArrow(answer, FOUND)


def _elsewhere(questions: DataFrame, blocks: DataFrame, n: int, pivots: np.ndarray, sizes: Sequence, least: np.ndarray, most: np.ndarray) -> DataFrame:
    """Answers from other cells than a question's own: a task for every pair of a part of the questions and a part of the rows."""
    count = max(-(-n // PART_ROWS), min(LEAST_PARTS, -(-n // BLOCK_ROWS)))
    held, parts, seen = {r["cell"]: r["n"] for r in sizes}, np.zeros((len(pivots), 2), dtype=int), 0
    for cell in range(len(pivots)):
        # A cell lies in the parts that its rows would fill, one cell after the other.
        parts[cell] = seen * count // n, max(seen, seen + held.get(cell, 0) - 1) * count // n
        seen += held.get(cell, 0)
    parts = np.minimum(parts, count - 1)
    low, high = (F.get(F.lit(parts[:, k].tolist()), F.col("cell")) for k in (0, 1))
    number = F.xxhash64("keys")
    keyed = [F.col(c) for c in ("cell", "n", "keys", "folds", "away", "bounds", "vectors")]
    theirs = blocks.select((low + F.pmod(number, high - low + 1)).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("asking"), *keyed)
    asked = questions.select(*keyed).mapInArrow(lambda b: visits(b, pivots, least, most, parts), f"part int, {BLOCK}")
    asked = asked.withColumn("asking", F.pmod(number, F.lit(count)).cast("int"))
    pair = ["part", "asking"]
    sides = [side.repartition(count * count, *pair).groupBy(*pair) for side in (asked, theirs)]
    return sides[0].cogroup(sides[1]).applyInArrow(lambda q, r: compare(q, r, pivots, least, most), FOUND)


def nearest(rows: DataFrame, rowid: str = "rowid", fold: str = "fold", vector: str = "features") -> DataFrame:
    """(rowid, neighbour, square): for every row the nearest one of another fold, the least id among equally near ones.

    ``vector`` is an array of numbers, all of one length. Rows without a vector or a fold take no part; a row that no
    other fold has a neighbour for gets NULL.
    """
    points = stage(rows.select(F.col(rowid).cast("long").alias("rowid"), F.col(fold).cast("long").alias("fold"), F.col(vector).cast("array<double>").alias("v")).filter("v IS NOT NULL AND fold IS NOT NULL"), "points")
    distinct = stage(points.groupBy("v", "fold").agg(F.min("rowid").alias("key")).select("key", "fold", "v"), "distinct")
    n = distinct.count()
    # A bounded sample, the same on every run.
    chosen = distinct.orderBy(F.md5(F.col("key").cast("string")), "key").limit(max(1, min(MOST_PIVOTS, math.isqrt(n)))).collect()
    if not chosen:
        return points.select(F.col("rowid").alias(rowid), F.lit(None).cast("long").alias("neighbour"), F.lit(None).cast("double").alias("square"))
    pivots = np.array([r["v"] for r in chosen])
    cells = stage(distinct.mapInArrow(lambda b: assign(b, pivots), "key long, fold long, v array<double>, cell int, away double"), "cells")
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("away").alias("least"), F.max("away").alias("most")).collect()  # a row per pivot
    least, most = np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf)
    for r in sizes:
        least[r["cell"]], most[r["cell"]] = r["least"], r["most"]
    salts = max(1, -(-max(r["n"] for r in sizes) // SALT_ROWS))
    blocks = stage(_blocks(cells.withColumn("bound", F.lit(float("inf"))), salts), "blocks")
    own = stage(_asked(blocks, blocks), "own-cell").groupBy("key").agg(F.min(F.struct("square", "neighbour")).alias("near"))
    bounded = cells.join(own, "key", "left").select("key", "fold", "v", "cell", "away", F.coalesce("near.square", F.lit(float("inf"))).alias("bound"))
    far = _elsewhere(stage(_blocks(bounded, salts), "bounded"), blocks, n, pivots, sizes, least, most).groupBy("key").agg(F.min(F.struct("square", "neighbour")).alias("near"))
    best = own.unionByName(far).groupBy("key").agg(F.min("near").alias("near"))
    answers = distinct.join(best, "key", "left").select("v", "fold", "near")
    return join_groups(points, answers, ["v", "fold"]).select(F.col("rowid").alias(rowid), F.col("near.neighbour").alias("neighbour"), F.col("near.square").alias("square"))


def predictions(rows: DataFrame, vector: str = "features") -> DataFrame:
    """(repeat, fold, sample, row_id, prediction, correct) of the nearest row of another fold, over rows of one repeat (fold, rowid, label, vector)."""
    near = nearest(rows, vector=vector)
    labels = rows.select(F.col("rowid").alias("neighbour"), F.col("label").alias("prediction"))
    return rows.select("rowid", "fold", F.col("label").alias("correct")).join(near, "rowid").join(labels, "neighbour", "left").select(
        F.lit(0).alias("repeat"), "fold", F.lit(0).alias("sample"), F.col("rowid").alias("row_id"), "prediction", "correct")
