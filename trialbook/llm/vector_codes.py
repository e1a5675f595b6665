"""Vector codes: every vector becomes one codebook entry per part (product quantisation).

Components become integers, a vector is cut into equal parts, and each part position has a codebook that Lloyd rounds
refine with integer means. A round reads the written vectors once: tasks assign their parts and return the sums and
counts per codebook entry, so what reaches the driver is (parts x entries) rows however many vectors there are.

Assignment goes through memoised grid cells. A part falls into a coarse cell of side ``2**cell_bits`` per dimension.
For a cell seen first, the least and the largest distance of its box to every entry are computed; an entry whose least
distance exceeds another's largest one is dominated everywhere in the box, and so is one that is farther than the
entry of the least largest distance in every corner. The entries that are left are remembered
under the cell, and only these are evaluated exactly for the parts in it. A task forgets all cells when it remembers
``CELLS`` of them, which changes no result. All arithmetic is on integers, so results do not depend on the layout.

Nulls and edges: vectors that are null or hold a null, NaN or infinite component are dropped; so are vectors without
components, and those of another length than the first one kept (smallest vec_id, nulls last), whose length must be a
multiple of ``parts``; a component beyond ``LARGEST`` in size raises an error, since distances would leave 64 bits.
With fewer vectors than entries the codebooks are shorter. Rows of one vec_id follow by their components, equal rows
are coded each; null labels form one group; an empty table gives no rows; other columns, whatever their names, are
ignored. Texts do not occur.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialbook.llm import query
from trialbook.llm.tasks import remote
from trialbook.llm.text import table
from trialbook.session import stage

SCALE, PARTS, ENTRIES, ROUNDS, CELL_BITS = 4096, 8, 16, 6, 9
CELLS = 1 << 16
# Distances of up to 64 components of this size fit 62 bits.
LARGEST = 1 << 27
SUMS = "part int, entry int, n long, sums array<long>"
CODES = "vec_id long, label long, codes array<int>, error long"


def finite(vector: str) -> F.Column:
    """Whether a vector has components, all of them numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad


def integers(vector: str, scale: int) -> F.Column:
    """floor(scale * x) of every component, as doubles."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


class Assigner:
    """Nearest entries of one codebook (entries x width), through memoised cells."""

    def __init__(self, codebook: np.ndarray, cell_bits: int = CELL_BITS):
        self.codebook, self.bits = codebook, cell_bits
        self.cells: dict[bytes, int] = {}
        self.evaluated = 0

    def _masks(self, cells: np.ndarray) -> np.ndarray:
        """For each cell, True for the entries that no other one dominates across its box."""
        low = cells[:, None, :] << self.bits
        high = low + (1 << self.bits) - 1
        least, most = low - self.codebook, high - self.codebook
        nearest = np.maximum(np.maximum(least, -most), 0)
        farthest = np.maximum(np.abs(least), np.abs(most))
        nearest, farthest = (nearest * nearest).sum(axis=2), (farthest * farthest).sum(axis=2)
        masks = nearest <= farthest.min(axis=1, keepdims=True)
        # The entry with the least largest distance, against each other one: the difference of the two distances is
        # linear in the part, so its maximum over the box is at a corner.
        leader = self.codebook[farthest.argmin(axis=1)][:, None, :]
        ahead = leader - self.codebook
        most_behind = (leader * leader - self.codebook * self.codebook - 2 * ahead * np.where(ahead > 0, low, high)).sum(axis=2)
        return masks & (most_behind >= 0)

    def candidates(self, values: np.ndarray) -> np.ndarray:
        """(rows, entries): the entries to evaluate for each row."""
        cells = np.ascontiguousarray(values >> self.bits)
        packed = cells.view(np.dtype((np.void, cells.shape[1] * 8))).ravel()
        _, first, where = np.unique(packed, return_index=True, return_inverse=True)
        keys = [packed[i].tobytes() for i in first]
        fresh = [k for k, key in enumerate(keys) if key not in self.cells]
        known = [self.cells.get(key) for key in keys]
        weights = 1 << np.arange(len(self.codebook), dtype=object)
        for low in range(0, len(fresh), 4096):
            some = fresh[low : low + 4096]
            for k, mask in zip(some, self._masks(cells[first[some]]), strict=True):
                known[k] = mask
        masks = np.array([m if isinstance(m, np.ndarray) else self._bits(m) for m in known], dtype=bool).reshape(len(keys), len(self.codebook))
        if len(self.cells) + len(fresh) > CELLS:
            self.cells.clear()
        for k in fresh[:CELLS]:
            self.cells[keys[k]] = int(weights[masks[k]].sum())
        return masks[where]

    def _bits(self, value: int) -> np.ndarray:
        return np.array([value >> j & 1 for j in range(len(self.codebook))], dtype=bool)

    def __call__(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index and the squared distance of the nearest entry of each row; the first one of equals."""
        wanted = self.candidates(values)
        best, index = np.full(len(values), np.iinfo(np.int64).max), np.zeros(len(values), dtype=np.int32)
        for j, entry in enumerate(self.codebook):
            rows = np.flatnonzero(wanted[:, j])
            away = values[rows] - entry
            distance = (away * away).sum(axis=1)
            self.evaluated += len(rows)
            closer = distance < best[rows]
            best[rows[closer]], index[rows[closer]] = distance[closer], j
        return index, best


def _parts(column: pa.Array, books: list) -> np.ndarray:
    """The batch's vectors as (rows, parts, width)."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), len(books), -1)


def partial_sums(batches: Iterator[pa.RecordBatch], books: list, cell_bits: int) -> Iterator[pa.RecordBatch]:
    """For batches of (vector), one row per part and entry that is nearest to some part: count and sums."""
    arrays = [np.array(b, dtype=np.int64) for b in books]
    assigners = [Assigner(b, cell_bits) for b in arrays]
    counts, sums = [np.zeros(len(b), dtype=np.int64) for b in arrays], [np.zeros(b.shape, dtype=np.int64) for b in arrays]
    for batch in batches:
        values = _parts(batch.column(0), books)
        for p, assigner in enumerate(assigners):
            index, _ = assigner(values[:, p])
            counts[p] += np.bincount(index, minlength=len(arrays[p]))
            np.add.at(sums[p], index, values[:, p])
    rows = [(p, j, int(n), sums[p][j].tolist()) for p in range(len(arrays)) for j, n in enumerate(counts[p]) if n]
    columns = list(zip(*rows, strict=True)) if rows else [()] * 4
    types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["part", "entry", "n", "sums"])


def assign(batches: Iterator[pa.RecordBatch], books: list, cell_bits: int) -> Iterator[pa.RecordBatch]:
    """For batches of (vec_id, label, vector): codes and the summed squared distance."""
    assigners = [Assigner(np.array(b, dtype=np.int64), cell_bits) for b in books]
    for batch in batches:
        values = _parts(batch.column(2), books)
        found = [assigner(values[:, p]) for p, assigner in enumerate(assigners)]
        codes = np.stack([index for index, _ in found], axis=1)
        error = np.sum([distance for _, distance in found], axis=0, dtype=np.int64)
        offsets = np.arange(0, codes.size + 1, len(books), dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, codes.ravel().astype(np.int32)), pa.array(error)],
            names=["vec_id", "label", "codes", "error"])


def vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v): the rows that take part, with integer components, written once."""
    kept = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("x")).filter(finite("x"))
    too_large = F.raise_error(F.lit(f"a component is beyond {LARGEST / scale:g}"))
    value = F.transform("x", lambda x: F.when(F.abs(x.cast("double") * scale) <= LARGEST, F.floor(x.cast("double") * scale)).otherwise(too_large).cast("int"))
    return stage(kept.select("vec_id", "label", value.alias("v")), "vectors")


def codebooks(v: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, cell_bits: int = CELL_BITS) -> tuple[DataFrame, list]:
    """The vectors of one length, and a codebook (a list of integer entries) for each part position."""
    first = [r["v"] for r in v.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(1).collect()]
    if not first:
        return v, []
    length = len(first[0])
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    v = v.filter(F.size("v") == length)
    width = length // parts
    start = [r["v"] for r in v.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()]
    books = [[x[p * width : (p + 1) * width] for x in start] for p in range(parts)]
    for _ in range(rounds):
        sums = v.select("v").mapInArrow(remote(partial_sums, books, cell_bits), SUMS)
        total = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])
        for r in total.collect():  # parts x entries rows
            books[r["part"]][r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    return v, books


def coded(v: DataFrame, books: list, cell_bits: int = CELL_BITS) -> DataFrame:
    """(vec_id, label, codes, error) of vectors, under given codebooks."""
    if not books:
        return v.sparkSession.createDataFrame([], CODES)
    return v.select("vec_id", "label", "v").mapInArrow(remote(assign, books, cell_bits), CODES)


def digest(books: list) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def _sql(scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, width: int = 8) -> str:
    """The rounds unrolled: distances of all parts to all entries, in plain SQL."""
    away = " + ".join(f"(p.x[{i}] - b.x[{i}]) * (p.x[{i}] - b.x[{i}])" for i in range(1, width + 1))
    mean = ", ".join(f"CAST(floor(sum(p.x[{i}]) / count(*)) AS BIGINT)" for i in range(1, width + 1))
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT n, part, min({{'d': {away}, 'entry': b.entry}}) AS best
            FROM parts p JOIN b{r} b USING (part) GROUP BY n, part)""")
        if r < rounds:
            steps.append(f"""b{r + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.x, b.x) AS x FROM b{r} b LEFT JOIN (
                SELECT part, best.entry AS entry, [{mean}] AS x FROM parts p JOIN a{r} a USING (n, part) GROUP BY ALL) m USING (part, entry))""")
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS n, vec_id, label, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
parts AS MATERIALIZED (SELECT n, part, v[part * {width} + 1 : part * {width} + {width}] AS x FROM kept, range({parts}) r(part)),
b0 AS MATERIALIZED (SELECT part, n - 1 AS entry, x FROM parts WHERE n <= {entries}),
{", ".join(steps)},
codes AS (SELECT n, string_agg(printf('%02x', CAST(best.entry AS INT)), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{rounds} GROUP BY n),
book AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS h FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT h FROM book) AS codebooks_sha256
FROM kept JOIN codes USING (n)"""


@query("op12_vector_codes", sql=_sql())
def _(spark, folder):
    v, books = codebooks(vectors(table(spark, folder, "embeddings")))
    rows = stage(coded(v, books), "codes")
    labels = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of_label")
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return rows.join(labels, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", code.alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
