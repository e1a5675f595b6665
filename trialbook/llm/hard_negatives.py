"""Hard negatives: for anchors and their nearest rows of the same label, rows of other labels that score almost as high.

Vertical scan (BOND). Rows are kept as blocks of columnar dimensions with each dimension's least and largest value in
the block. An anchor reads a block's dimensions in descending order of its own components' size, a few at a time, and
adds their products to the partial scores of the rows that are still candidates. What the remaining dimensions can add
at least and at most is a sum over the block's bounds; a row whose largest possible score cannot enter a list, or
whose possible scores miss every window, leaves the candidate bitmap. Rows that stay to the last dimension have exact
scores. The first scan finds each anchor's positives, the second one, with the windows that these set, the negatives.

Anchors and rows both grow with the data and meet in blocks: rows are dealt to groups of at most ``GROUP_ROWS``, blocks
of ``ANCHOR_BLOCK`` anchors are repeated for each group (anchors are the few), and a sort-merge join streams the pairs of
blocks of a group past a task, which holds one block of each kind and the lists of the anchors in hand. It returns at
most ``k`` rows per list and group; a last grouping by anchor keeps the first ones. Nothing is broadcast or collected.

Nulls and edges: rows with a null label, a null or empty vector, or a null, NaN or infinite component take no part, nor do
vectors of another length than the anchor's (they are scored with none); a null vec_id is no anchor and comes last among
ties. Rows of one vec_id are rows of their own, but never positives of each other; equal rows may stand in one list
twice. A component beyond ``LARGEST`` in size raises an error, since scores would not be exact. An empty table gives no
rows; other columns, whatever their names, are ignored. Texts do not occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialbook.llm import query
from trialbook.llm.tasks import remote
from trialbook.llm.text import table
from trialbook.llm.vector_codes import finite
from trialbook.session import stage

SCALE = 256
# With components up to this size the sums of a thousand products are exact as doubles.
LARGEST = 1 << 21
GROUP_ROWS, BLOCK_ROWS, ANCHOR_BLOCK, STEP = 1 << 17, 4096, 256, 8
BLOCKS = "part int, block long, dims int, n int, label binary, vec_id binary, columns binary"
FOUND = "row long, slot int, vec_id long, score long"


def taking_part(rows: DataFrame, label: Column, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(row, vec_id, label, v): the rows that take part, with integer components; ``row`` tells equal ones apart."""
    kept = rows.select(F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector).alias("x"))
    kept = kept.filter(F.col("label").isNotNull() & finite("x"))
    too_large = F.raise_error(F.lit(f"a component is beyond {LARGEST / scale:g}"))
    value = F.transform("x", lambda x: F.when(F.abs(x.cast("double") * scale) <= LARGEST, F.floor(x.cast("double") * scale)).otherwise(too_large).cast("int"))
    return stage(kept.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", value.alias("v")), "rows")


def columnar(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[pa.RecordBatch]:
    """Blocks of rows (part, vec_id, label, v), one after the other, with a null vec_id as the largest number."""
    last = np.iinfo(np.int64).max
    number = 0
    for batch in batches:
        part, lengths = batch.column(0).to_numpy(), batch.column(3).value_lengths().to_numpy()
        ids = np.array([last if i is None else i for i in batch.column(1).to_pylist()], dtype=np.int64)
        labels, flat = batch.column(2).to_numpy(), batch.column(3).flatten().to_numpy()
        starts = np.cumsum(lengths) - lengths
        rows = []
        for p, dims in sorted(set(zip(part.tolist(), lengths.tolist(), strict=True))):
            own = np.flatnonzero((part == p) & (lengths == dims))
            for low in range(0, len(own), block_rows):
                some = own[low : low + block_rows]
                columns = np.ascontiguousarray(flat[starts[some][:, None] + np.arange(dims)].T.astype("<i4"))
                rows.append((p, number, dims, len(some), labels[some].tobytes(), ids[some].tobytes(), columns.tobytes()))
                number += 1
        columns_ = list(zip(*rows, strict=True)) if rows else [()] * 7
        types = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 3]
        names = ["part", "block", "dims", "n", "label", "vec_id", "columns"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns_, types, strict=True)], names=names)


def row_blocks(rows: DataFrame) -> tuple[DataFrame, int]:
    """Columnar blocks of rows, written once, and the number of groups they are dealt to: enough for all cores, none over ``GROUP_ROWS``."""
    n, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-n // GROUP_ROWS), min(4 * cores, n // 512))
    dealt = rows.select("vec_id", "label", "v").repartition(parts).withColumn("part", F.spark_partition_id())
    return stage(dealt.select("part", "vec_id", "label", "v").mapInArrow(remote(columnar, BLOCK_ROWS), BLOCKS), "blocks"), parts


class Block:
    """A block of rows with the bounds of its dimensions."""

    def __init__(self, n: int, label: bytes, vec_id: bytes, columns: bytes):
        self.label, self.vec_id = np.frombuffer(label, dtype=np.int64), np.frombuffer(vec_id, dtype=np.int64)
        self.columns = np.frombuffer(columns, dtype="<i4").reshape(-1, n).astype(np.float64)
        self.least, self.most = self.columns.min(axis=1), self.columns.max(axis=1)


class Scan:
    """One anchor's vertical scan, and the first ``k`` (score descending, vec_id ascending) of each of its windows so far.

    A window is (lowest score, highest score), both included.
    """

    def __init__(self, vec_id: int, label: int, v: np.ndarray, windows: list[tuple[float, float]], k: int, same_label: bool):
        self.vec_id, self.label, self.k, self.same_label = vec_id, label, k, same_label
        self.order = np.argsort(-np.abs(v), kind="stable")
        self.v = v.astype(np.float64)[self.order]
        self.low, self.high = np.array([w[0] for w in windows]), np.array([w[1] for w in windows])
        self.lists: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, dtype=np.int64), np.zeros(0))] * len(windows)
        self.read = 0

    def floors(self) -> np.ndarray:
        """The least score that can still enter each window's list."""
        return np.array([max(low, scores[-1]) if len(scores) == self.k else low for low, (_, scores) in zip(self.low, self.lists, strict=True)])

    def possible(self, least: np.ndarray, most: np.ndarray, floors: np.ndarray) -> np.ndarray:
        """Rows whose scores, between ``least`` and ``most``, may enter some window's list."""
        keep = np.zeros(len(least), dtype=bool)
        for floor, high in zip(floors, self.high, strict=True):
            keep |= (most >= floor) & (least <= high)
        return keep

    def scan(self, block: Block) -> None:
        bitmap = block.label == self.label if self.same_label else block.label != self.label
        if self.same_label:
            bitmap &= block.vec_id != self.vec_id
        rows = np.flatnonzero(bitmap)
        ends = np.sort(self.v[:, None] * np.stack([block.least[self.order], block.most[self.order]], axis=1), axis=1)
        # What the dimensions from each place on add at least and at most.
        rest = np.vstack([np.cumsum(ends[::-1], axis=0)[::-1], [0, 0]])
        partial, floors = np.zeros(len(rows)), self.floors()
        for at in range(0, len(self.v), STEP):
            if not len(rows):
                return
            dims = self.order[at : at + STEP]
            some = block.columns[dims] if len(rows) == block.columns.shape[1] else block.columns[np.ix_(dims, rows)]
            partial = partial + self.v[at : at + STEP] @ some
            self.read += some.size
            least, most = rest[min(at + STEP, len(self.v))]
            if self.same_label and len(rows) > self.k:
                # The lower bounds of the candidates themselves raise the floor of a list without an upper end.
                best = np.partition(partial, len(rows) - self.k)[len(rows) - self.k] + least
                floors = np.maximum(floors, best)
            keep = self.possible(partial + least, partial + most, floors)
            if not keep.all():
                rows, partial = rows[keep], partial[keep]
        for w, (ids, scores) in enumerate(self.lists):
            inside = (partial >= floors[w]) & (partial <= self.high[w])
            ids, scores = np.concatenate([ids, block.vec_id[rows[inside]]]), np.concatenate([scores, partial[inside]])
            first = np.lexsort((ids, -scores))[: self.k]
            self.lists[w] = ids[first], scores[first]


def _windows(scores: list[int], least: int, of: int) -> list[tuple[float, float]]:
    """least/of * score <= score of the negative <= score, in integers."""
    return [(float(-(-least * s // of)), float(s)) for s in scores]


def scan(batches: Iterator[pa.RecordBatch], k: int, ratio: tuple[int, int] | None) -> Iterator[pa.RecordBatch]:
    """For pairs of blocks: the first ``k`` rows of each anchor's lists. Pairs of one anchor block that follow each
    other share their lists; if others come between, there are more rows to rank, and the same result.

    Without a ratio one list of the same label, with it a list of other labels for each score in ``windows``.
    """
    last = np.iinfo(np.int64).max
    types, names = [pa.int64(), pa.int32(), pa.int64(), pa.int64()], ["row", "slot", "vec_id", "score"]
    here: tuple | None = None
    scans: list[tuple[int, Scan]] = []
    held: tuple[tuple | None, Block | None] = (None, None)

    def found() -> pa.RecordBatch:
        rows = [(row, slot, None if i == last else int(i), int(s)) for row, one in scans for slot, (ids, scores) in enumerate(one.lists) for i, s in zip(ids.tolist(), scores.tolist(), strict=True)]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    for batch in batches:
        for i in range(batch.num_rows):
            key = (batch.column("part")[i].as_py(), batch.column("anchors")[i].as_py())
            if key != here:
                if scans:
                    yield found()
                here, scans = key, []
                for a in batch.column("a")[i].as_py():
                    windows = [(-np.inf, np.inf)] if ratio is None else _windows(a["windows"], *ratio)
                    scans.append((a["row"], Scan(a["vec_id"], a["label"], np.array(a["v"]), windows, k, ratio is None)))
            block_key = (key[0], batch.column("block")[i].as_py(), batch.column("dims")[i].as_py())
            if held[0] != block_key:
                held = block_key, Block(batch.column("n")[i].as_py(), *[batch.column(c)[i].as_py() for c in ("ids_label", "ids_vec_id", "columns")])
            for _, one in scans:
                if len(one.v) == block_key[2]:
                    one.scan(held[1])
    if scans:
        yield found()


def first_rows(anchors: DataFrame, blocks: DataFrame, parts: int, k: int, ratio: tuple[int, int] | None) -> DataFrame:
    """(row, slot, rank, vec_id, score): the first ``k`` rows of each list of ``anchors`` (row, vec_id, label, v, windows)."""
    n = anchors.count()
    dealt = anchors.repartition(max(1, -(-n // ANCHOR_BLOCK))).withColumn("anchors", F.spark_partition_id())
    packed = dealt.groupBy("anchors").agg(F.collect_list(F.struct("row", "vec_id", "label", "v", "windows")).alias("a"))  # ANCHOR_BLOCK anchors each
    everywhere = packed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    rows = blocks.withColumnsRenamed({"label": "ids_label", "vec_id": "ids_vec_id"})
    # A sort-merge join streams its left side, so all pairs of an anchor block follow each other.
    pairs = everywhere.hint("merge").join(rows, "part")
    found = pairs.select("part", "anchors", "a", "block", "dims", "n", "ids_label", "ids_vec_id", "columns").mapInArrow(remote(scan, k, ratio), FOUND)
    rank = F.row_number().over(Window.partitionBy("row", "slot").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last()))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, ratio: tuple[int, int] = (80, 100)) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over rows that ``taking_part`` gives.

    ``ratio`` (least, of): a negative's score is at least least/of of the positive's, and at most the positive's.
    """
    blocks, parts = row_blocks(rows)
    anchors = stage(rows.filter(is_anchor), "anchors")
    none = F.array().cast("array<long>")
    near = stage(first_rows(anchors.withColumn("windows", none), blocks, parts, positives, None), "positives")
    lists = near.groupBy("row").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("windows"))
    found = first_rows(anchors.join(lists, "row"), blocks, parts, negatives, ratio)
    far = found.select("row", (F.col("slot") + 1).alias("at"), F.col("rank").alias("place"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = near.join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row").select(
        F.col("row"), F.col("rank").alias("at"), "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return named.join(far, ["row", "at"]).select("anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


@query("op13_hard_negatives", sql="""
WITH kept AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS s
  FROM kept a, kept b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT * FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.b AS negative_id, p.s AS positive_score, n.s AS negative_score
FROM positives p JOIN pairs n ON n.a = p.a AND NOT n.same AND 80 * p.s <= 100 * n.s AND 100 * n.s <= 100 * p.s
WINDOW w AS (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.b) QUALIFY row_number() OVER w <= 5""")
def _(spark, folder):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(taking_part(table(spark, folder, "embeddings"), label), F.col("vec_id") % 100 == 0)
