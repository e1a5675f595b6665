"""Best-fit packing by exact complements.

Documents become token ids, longer ones are cut, and only the number of pieces of each length goes
to the driver: at most ``capacity`` numbers, whatever the size of the corpus. On them the plan is
made. Going down from the longest length, the gap a piece leaves is looked up among the lengths,
the sums of two and the sums of three lengths still available, and the combination is consumed as
often as its scarcest length allows. What finds no exact complement is placed best-fit, longest
first. The plan lists, for each length, which ranks go to which sequences and offsets; its size
depends on ``capacity`` alone.

Pieces are ranked within their length in hash buckets, so no length, however common, meets in one
task. Nulls and edges: a null text is an empty one, which still has its end id; repeated rows are
packed each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialbook.llm import query
from trialbook.llm.tasks import remote
from trialbook.llm.text import table, whole
from trialbook.session import stage

# Fixed value: how byte-level BPE of this kind cuts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
FEWEST_BUCKETS, BUCKET_ROWS = 64, 100_000


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones stand for
    themselves, the others follow from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of a byte-level BPE file. The merges run in tiktoken, which gives the same ids several times as
    fast where, as checked here, ids follow the order of the merges; texts that it refuses (runs of a
    million blanks, say) and other vocabularies go through ``tokenizers``. As there, an added token of the file
    (``<|endoftext|>``) that stands in a text is its one id."""

    def __init__(self, path: str):
        self.path, self.fast = path, None
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, added = file["model"], file.get("added_tokens") or []
        vocab, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ids = [vocab["".join(m)] for m in merges]
        if ids == sorted(ids) and len(added) <= 1 and not any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            import tiktoken

            byte = _byte_of()
            ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items() if all(c in byte for c in token)}
            specials = {a["content"]: a["id"] for a in added}
            merged = {k: v for k, v in ranks.items() if k not in {s.encode() for s in specials}}
            self.fast = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=merged, special_tokens=specials)

    @functools.cached_property
    def slow(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return np.asarray(self.fast.encode_to_numpy(text, allowed_special="all"), dtype="<u4")
            except BaseException as e:
                if type(e).__name__ != "PanicException":
                    raise
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int | None, with_ids: bool) -> Iterator[pa.RecordBatch]:
    """Pieces of batches of (id, text)."""
    encode = encoder(path)
    end = np.array([] if end_id is None else [end_id], dtype="<u4")
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * with_ids]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    for batch in batches:
        rows: list[tuple] = []
        for one, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids = np.concatenate([encode(t.as_py()), end])
            first = len(ids) % capacity or min(len(ids), capacity)
            for k, start in enumerate([0, *range(first, len(ids), capacity)] if len(ids) else []):
                part = ids[start : first if k == 0 else start + capacity]
                rows.append((one, k, start, len(part), zlib.crc32(part.tobytes()), *[part.astype("int64")] * with_ids))
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(types)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def pieces(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 1024, end_id: int | None = 2, with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document.

    A document of more than ``capacity`` ids is cut; all its pieces but the first are full.
    """
    schema = PIECES + (", ids array<long>" if with_ids else "")
    return docs.select(F.col(doc_id).cast("long"), whole(text)).mapInArrow(remote(cut, path, capacity, end_id, with_ids), schema)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how many sequences follow each: every piece once, no sequence over ``capacity``."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        if not 0 <= length <= capacity:
            raise ValueError(f"a piece has {length} tokens, a sequence {capacity}")
        left[length] = n
    out: list[tuple[tuple[int, ...], int]] = []

    def pair(gap: int) -> tuple[int, ...] | None:
        """The pair of available lengths with this sum whose longer one is the longest."""
        if gap < 2:
            return None
        here = left[1:gap]
        fits = np.flatnonzero((here > 0) & (here[::-1] > 0))
        for a in fits[::-1] + 1:
            if 2 * a < gap:
                break
            if 2 * a > gap or left[a] > 1:
                return int(a), int(gap - a)
        return None

    def complement(gap: int) -> tuple[int, ...] | None:
        if left[gap] > 0:
            return (gap,)
        if two := pair(gap):
            return two
        for a in np.flatnonzero(left[: gap - 1] > 0)[::-1]:
            if 3 * a < gap:
                break
            left[a] -= 1
            two = pair(gap - int(a)) if a else None
            left[a] += 1
            if two:
                return (int(a), *two)
        return None

    rest: list[tuple[int, int]] = []
    for length in range(capacity, 0, -1):
        while left[length] > 0:
            if length == capacity:
                found: tuple[int, ...] | None = ()
            else:
                left[length] -= 1
                found = complement(capacity - length)
                left[length] += 1
            if found is None:
                rest.append((length, int(left[length])))
                left[length] = 0
                break
            pattern = (length, *found)
            times = min(int(left[x]) // pattern.count(x) for x in set(pattern))
            for x in pattern:
                left[x] -= times
            out.append((pattern, times))

    # Best fit, longest first, over groups of equal sequences: gap -> [(pattern, number)].
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length, n in rest:
        for gap in range(length, capacity):
            while n and open_.get(gap):
                pattern, m = open_[gap].pop()
                each = min(gap // length, n)
                used = min(m, n // each)
                if used < m:
                    open_[gap].append((pattern, m - used))
                open_.setdefault(gap - each * length, []).append((pattern + (length,) * each, used))
                n -= used * each
            if not n:
                break
        each = capacity // length
        if n // each:
            open_.setdefault(capacity - each * length, []).append(((length,) * each, n // each))
        if n % each:
            open_.setdefault(capacity - n % each * length, []).append(((length,) * (n % each), 1))
    out += [x for group in open_.values() for x in group]
    if left[0]:
        out.append(((0,), int(left[0])))
    return out


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, first sequence, offset): the ranks from the first one on, up to
    the next row's, go to consecutive sequences at that offset."""
    taken: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for pattern, times in patterns:
        at = 0
        for length in pattern:
            rows.setdefault(length, []).append((taken.get(length, 0), sequence, at))
            taken[length] = taken.get(length, 0) + times
            at += length
        sequence += times
    return {k: np.array(v, dtype=np.int64) for k, v in rows.items()}


def place(batches: Iterator[pa.RecordBatch], table_: dict[int, np.ndarray], length: str) -> Iterator[pa.RecordBatch]:
    """The batches with sequence_id and offset in place of the last column, the rank within a length."""
    for batch in batches:
        lengths, ranks = batch.column(length).to_numpy(), batch.column(batch.num_columns - 1).to_numpy()
        sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
        for one in np.unique(lengths):
            at = np.flatnonzero(lengths == one)
            rows = table_[int(one)]
            k = np.searchsorted(rows[:, 0], ranks[at], side="right") - 1
            sequence[at], offset[at] = rows[k, 1] + ranks[at] - rows[k, 0], rows[k, 2]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names=[*batch.schema.names[:-1], "sequence_id", "offset"])


def pack(cut: DataFrame, length: str = "length", capacity: int = 1024) -> DataFrame:
    """``cut`` with sequence_id and offset: pieces of at most ``capacity`` in as few sequences as found.

    ``cut`` is written once, so that ranks stay what they are when a task runs again.
    """
    written = stage(cut.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    sizes = {r[length]: r["n"] for r in written.groupBy(length).agg(F.count(F.lit(1)).alias("n")).collect()}  # at most capacity + 1 rows
    table_ = places(plan(sizes, capacity))
    buckets = max(FEWEST_BUCKETS, sum(sizes.values()) // BUCKET_ROWS)
    dealt = written.withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.lit(buckets)))
    by = [length, "_bucket"]
    before = Window.partitionBy(length).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).select(*by, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    here = Window.partitionBy(*by).orderBy("_row")
    ranked = dealt.join(starts, by).withColumn("_rank", F.col("_start") + F.row_number().over(here) - 1)

    names = [*cut.columns, "_rank"]
    schema = T.StructType([*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.select(*names).mapInArrow(remote(place, table_, length), schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids) of packed pieces that carry their ids; a sequence holds ``capacity`` ids at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"), F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"))


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op9_best_fit_packing")
def _(spark, folder):
    return pack(pieces(table(spark, folder, "documents"), byte_bpe()))
