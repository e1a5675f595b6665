"""Repeated windows: what substring dedup over words and over bytes have in common.

A window is ``width`` consecutive units (words, bytes) of one text. Its minimiser is the smallest
value among its grams of ``gram`` units. Consecutive windows with the same minimiser travel as one
packed string to the bucket of that value, so equal windows meet there whatever lies around them.

Only values that two texts have in common need strings. So values go first, as four bytes each: texts are
dealt into groups by a hash, a group sends the values of its texts to their buckets, and the buckets
answer which ones others have too. Then the strings of those values travel, in one compressed block per
group and bucket that holds each string once for all its places. The spans found go back to the
groups. All three passes over the texts read one and the same shuffle of them.

Grams that are frequent in a bounded sample of texts come last in the order of minimisers. The order
never changes a result; it keeps strings around a very common passage from sharing one value.

A place is (document id, hash of the text, first unit). A null id counts as the largest. Rows that
repeat both id and text are one document; no row is removed for a row of the same id.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialbook.llm.minhash import mix
from trialbook.llm.tasks import remote, remote_pair
from trialbook.llm.text import whole

GROUPS_PER_PARTITION = 2
BUCKETS_PER_PARTITION = 2
SAMPLE_TEXTS, SAMPLE_CHARS, FREQUENT = 1000, 20_000, 8  # texts, their length at most, and in how many of them a gram is frequent
_SLOTS = 1 << 20
EXPANDED = 1 << 20  # runs of windows of all places looked at together
NULL_ID = np.iinfo(np.int64).max
SPANS = "doc_id long, text_hash long, start long, stop long"


def least_of(values: np.ndarray, n: int) -> np.ndarray:
    """The smallest of each ``n`` consecutive values, by doubling."""
    done = 1
    while done * 2 <= n:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return values if done == n else np.minimum(values[: done - n], values[n - done :])


def ordered(grams: np.ndarray, frequent: np.ndarray | None) -> np.ndarray:
    """The order of minimisers: by hash, frequent ones last."""
    if frequent is None:
        return grams
    return (grams >> np.uint64(1)) | (frequent[(grams >> np.uint64(44)).astype(np.int64)].astype(np.uint64) << np.uint64(63))


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of equal values."""
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return first, np.append(first[1:], len(values)) - 1


class Blocks:
    """Packed strings with their places, until they are sent."""

    def __init__(self, buckets: int):
        self.buckets, self.size = buckets, 0
        self.places: dict[tuple[int, bytes], list[int]] = {}

    def add(self, key: int, packed: bytes, place: tuple[int, int, int]) -> None:
        found = self.places.get((key, packed))
        if found is None:
            self.places[key, packed] = [*place]
            self.size += len(packed) + 150
        else:
            found += place
            self.size += 24

    def drain(self) -> Iterator[tuple[int, bytes]]:
        by: dict[int, list[tuple[int, bytes]]] = {}
        for item in self.places:
            by.setdefault(item[0] % self.buckets, []).append(item)
        pack = zstandard.ZstdCompressor(level=1)
        for bucket, items in by.items():
            places = [self.places[x] for x in items]
            yield bucket, pack.compress(b"".join([
                np.array([len(items), sum(map(len, places)) // 3], dtype=np.int64).tobytes(),
                np.array([k for k, _ in items], dtype=np.uint64).tobytes(),
                np.array([len(p) for _, p in items], dtype=np.int32).tobytes(),
                np.array([len(p) // 3 for p in places], dtype=np.int32).tobytes(),
                np.array([v for p in places for v in p], dtype=np.int64).tobytes(),
                *[p for _, p in items]]))
        self.places, self.size = {}, 0


def _opened(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    n, m = np.frombuffer(raw, np.int64, 2)
    at = 16
    parts = []
    for kind, count in ((np.uint64, n), (np.int32, n), (np.int32, n), (np.int64, 3 * m)):
        parts.append(np.frombuffer(raw, kind, count, at))
        at += parts[-1].nbytes
    return parts[0], parts[1], parts[2], parts[3].reshape(-1, 3), raw[at:]


def digests(values: np.ndarray) -> np.ndarray:
    """What stands for a minimiser value until its strings travel: a bucket in the lower half, four bytes in the upper."""
    return mix(values ^ np.uint64(0x5851F42D4C957F2D))


def send_values(batches: Iterator[pa.RecordBatch], values: Callable, buckets: int, frequent: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """(bucket, g, found, several): the values of each group by bucket, and which of them two of its texts have,
    from batches of (g, doc_id, text_hash, text)."""
    own: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for g, t in zip(batch.column(0).to_pylist(), batch.column(3), strict=True):
            parts = [np.unique(v) for v in values(t.as_py().encode(), frequent)]
            if parts:
                own.setdefault(g, []).append(parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts)))
    for g, parts in own.items():
        found, counts = np.unique(digests(np.concatenate(parts)), return_counts=True)
        bucket = ((found & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, upper, twice = bucket[order], (found[order] >> np.uint64(32)).astype(np.uint32), counts[order] > 1
        cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        stop = np.append(cut[1:], len(bucket))
        yield pa.RecordBatch.from_arrays([
            pa.array(bucket[cut], pa.int32()), pa.array(np.full(len(cut), g), pa.int32()),
            pa.array([upper[i:j].tobytes() for i, j in zip(cut, stop, strict=True)], pa.binary()),
            pa.array([np.packbits(twice[i:j]).tobytes() for i, j in zip(cut, stop, strict=True)], pa.binary())], names=["bucket", "g", "found", "several"])


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of each bucket, from batches sorted by their first column."""
    now, held = None, []
    for batch in batches:
        for bucket, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if bucket != now:
                if held:
                    yield now, held
                now, held = bucket, []
            held.append(rest)
    if held:
        yield now, held


def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, bucket, shared): the values of each group that another text has too."""
    for bucket, rows in by_bucket(batches):
        parts = [np.frombuffer(found, np.uint32) for _, found, _ in rows]
        twice = [np.unpackbits(np.frombuffer(s, np.uint8), count=len(v)) for v, (_, _, s) in zip(parts, rows, strict=True)]
        distinct, at = np.unique(np.concatenate(parts), return_inverse=True)
        shared = np.bincount(at, weights=1 + np.concatenate(twice), minlength=len(distinct)) > 1
        mine = np.split(shared[at], np.cumsum([len(v) for v in parts])[:-1])
        out = [(g, v[m].tobytes()) for (g, _, _), v, m in zip(rows, parts, mine, strict=True) if m.any()]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array([g for g, _ in out], pa.int32()), pa.array([bucket] * len(out), pa.int32()), pa.array([x for _, x in out], pa.binary())], names=["g", "bucket", "shared"])


def send_strings(texts: pa.Table, shared: pa.Table, split: Callable, values_in: int, buckets: int, frequent: np.ndarray | None) -> pa.Table:
    """(bucket, block) of one group: (g, doc_id, text_hash, text) and the answers (g, bucket, shared)."""
    blocks = Blocks(buckets)
    known = [np.uint64(b) << np.uint64(32) | np.frombuffer(x, np.uint32).astype(np.uint64) for b, x in zip(shared.column(1).to_pylist(), shared.column(2).to_pylist(), strict=True)]
    if known:
        wanted = np.sort(np.concatenate(known))

        def travels(values: np.ndarray) -> np.ndarray:
            d = digests(values)
            one = ((d & np.uint64(0xFFFFFFFF)) % np.uint64(values_in)) << np.uint64(32) | (d >> np.uint64(32))
            at = np.minimum(np.searchsorted(wanted, one), len(wanted) - 1)
            return np.flatnonzero(wanted[at] == one)

        for one, h, t in zip(texts.column(1).to_pylist(), texts.column(2).to_pylist(), texts.column(3), strict=True):
            one = NULL_ID if one is None else one
            for key, packed, start in split(t.as_py().encode(), frequent, travels):
                blocks.add(key, packed, (one, h, start))
    rows = list(blocks.drain())
    return pa.table({"bucket": pa.array([b for b, _ in rows], pa.int32()), "block": pa.array([x for _, x in rows], pa.binary())})


def _strings(blocks: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """The distinct packed strings of a bucket whose minimiser value has more than one place, whether others share that
    value, and their places with the number of the string of each, in the order of the strings."""
    opened = [_opened(b) for b in blocks]
    keys = np.concatenate([o[0] for o in opened])
    number = np.concatenate([o[2] for o in opened])
    values, inverse = np.unique(keys, return_inverse=True)
    several = np.bincount(inverse, weights=number, minlength=len(values)) > 1
    known: dict[bytes, int] = {}  # a string has one minimiser
    item, taken = [], []
    at = 0
    for k, lengths, counts, places, text in opened:
        take = several[inverse[at : at + len(k)]]
        at += len(k)
        ends = np.cumsum(lengths)
        item += [known.setdefault(text[i:j], len(known)) for i, j in zip((ends - lengths)[take].tolist(), ends[take].tolist(), strict=True)]
        taken.append(places[np.repeat(take, counts)])
    numbers, item = number[several[inverse]], np.array(item, dtype=np.int64)
    of = np.empty(len(known), dtype=np.int64)
    of[item] = inverse[several[inverse]]
    shared = np.bincount(of, minlength=len(values))[of] > 1
    string = np.repeat(item, numbers)
    order = np.argsort(string, kind="stable")
    return list(known), shared, string[order], np.concatenate(taken)[order]


def _covered(first: np.ndarray, last: np.ndarray, least: np.ndarray, begin: np.ndarray, number: np.ndarray, string: np.ndarray, places: np.ndarray) -> Iterator[np.ndarray]:
    """(document, hash, first unit, last window) of the maximal runs of windows with a smaller owner, a bounded number at a time.

    Windows first..last of string i have one smallest owner, for the runs begin[i] and the number[i] - 1 after it.
    """
    late = places[:, 0] > np.minimum.reduceat(least, begin)[string]
    string, places = string[late], places[late]
    ends = np.cumsum(number[string])
    at = 0
    while at < len(string):
        done = ends[at - 1] if at else 0
        stop = max(int(np.searchsorted(ends, done + EXPANDED, side="right")), at + 1)
        repeats = number[string[at:stop]]
        place = np.repeat(np.arange(at, stop), repeats)
        run = np.arange(len(place)) - np.repeat(ends[at:stop] - repeats - done, repeats) + begin[string[place]]
        own = np.flatnonzero(least[run] < places[place, 0])
        place, run = place[own], run[own]
        begins = np.append(True, (place[1:] != place[:-1]) | (first[run[1:]] != last[run[:-1]] + 1))
        ends_at = np.append(begins[1:], True)
        owner = places[place[begins]]
        yield np.column_stack([owner[:, 0], owner[:, 1], owner[:, 2] + first[run[begins]], owner[:, 2] + last[run[ends_at]]])
        at = stop


def meet(batches: Iterator[pa.RecordBatch], compare: Callable, tail: int) -> Iterator[pa.RecordBatch]:
    """Spans of units covered by windows that start in a smaller document too, from sorted (bucket, block).

    ``compare(strings, owners)`` gives the number of windows of each packed string and, for all of them in a row, the
    smallest owner; without owners the numbers only.
    """
    names = ["doc_id", "text_hash", "start", "stop"]
    for _, rows in by_bucket(batches):
        strings, shared, string, places = _strings([block for (block,) in rows])
        if not strings:
            continue
        owners = np.minimum.reduceat(places[:, 0], np.flatnonzero(np.append(True, string[1:] != string[:-1])))
        # A string that is alone has one run: whoever is not its smallest document repeats all of it.
        alone, others = np.flatnonzero(~shared), np.flatnonzero(shared)
        counts, _ = compare([strings[i] for i in alone], None)
        of, first, last, least = alone, np.zeros(len(alone), dtype=np.int64), counts - 1, owners[alone]
        if len(others):
            counts, smallest = compare([strings[i] for i in others], owners[others])
            window_of = np.repeat(others, counts)
            cut = np.flatnonzero(np.append(True, (smallest[1:] != smallest[:-1]) | (window_of[1:] != window_of[:-1])))
            window = np.arange(len(smallest)) - np.repeat(np.cumsum(counts) - counts, counts)
            of = np.concatenate([of, window_of[cut]])
            first = np.concatenate([first, window[cut]])
            last = np.concatenate([last, window[np.append(cut[1:], len(smallest)) - 1]])
            least = np.concatenate([least, smallest[cut]])
        order = np.argsort(of, kind="stable")
        number = np.bincount(of, minlength=len(strings))
        for found in _covered(first[order], last[order], least[order], np.cumsum(number) - number, number, string, places):
            if len(found):
                ids = pa.array(found[:, 0], mask=found[:, 0] == NULL_ID)
                yield pa.RecordBatch.from_arrays([ids, pa.array(found[:, 1]), pa.array(found[:, 2]), pa.array(found[:, 3] + 1 + tail)], names=names)


def frequent_grams(texts: DataFrame, grams: Callable) -> np.ndarray:
    """Which slots of gram hashes hold one that is frequent in the sample."""
    seen: Counter[int] = Counter()
    for (t,) in texts.select("text").filter(F.length("text") <= SAMPLE_CHARS).limit(SAMPLE_TEXTS).collect():
        seen.update(np.unique(grams(t.encode()) >> np.uint64(44)).tolist())
    slots = np.zeros(_SLOTS, dtype=np.uint8)
    slots[[k for k, n in seen.items() if n >= FREQUENT]] = 1
    return slots


def identified(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text_hash, text) of every row, null texts as empty ones."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(whole(text)).alias("text_hash"), whole(text).alias("text"))


def without_repeats(texts: DataFrame, module, width: int, schema: str, *options) -> DataFrame:
    """What ``module.strip(ids, texts, spans, *options)`` makes of every row and its spans to remove.

    ``module`` has ``values`` and ``split`` for texts, ``compare`` for strings of a bucket and ``text_grams``.
    """
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frequent = frequent_grams(texts, module.text_grams)
    group = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(partitions * GROUPS_PER_PARTITION)).cast("int").alias("g")
    dealt = texts.select(group, "doc_id", "text_hash", "text").repartition(partitions, "g")
    values = dealt.mapInArrow(remote(send_values, module.values, partitions, frequent), "bucket int, g int, found binary, several binary")
    answers = values.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(remote(answer), "g int, bucket int, shared binary")
    strings = remote_pair(send_strings, module.split, partitions, partitions * BUCKETS_PER_PARTITION, frequent)
    blocks = dealt.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(strings, "bucket int, block binary")
    spans = blocks.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(remote(meet, module.compare, width - 1), SPANS)
    spans = spans.select(group, "doc_id", "text_hash", "start", "stop")
    return dealt.groupBy("g").cogroup(spans.groupBy("g")).applyInArrow(remote_pair(remove, module.strip, *options), schema)


def remove(texts: pa.Table, spans: pa.Table, strip: Callable, *options) -> pa.Table:
    """The rows of one group without their spans: (g, doc_id, text_hash, text) and (g, doc_id, text_hash, start, stop)."""
    ids, hashes, starts, stops = (spans.column(i).fill_null(NULL_ID).to_numpy() for i in (1, 2, 3, 4))
    order = np.lexsort((starts, hashes, ids))
    ids, hashes, starts, stops = ids[order], hashes[order], starts[order], stops[order]
    cut = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1]))) if len(ids) else []
    own = {(int(ids[a]), int(hashes[a])): merged(starts[a:b], stops[a:b]) for a, b in zip(cut, [*cut[1:], len(ids)], strict=True)} if len(ids) else {}
    keys = zip(texts.column(1).to_pylist(), texts.column(2).to_pylist(), strict=True)
    found = [own.get((NULL_ID if i is None else i, h)) for i, h in keys]
    return strip(texts.column(1).to_pylist(), texts.column(3), found, *options)


def merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by spans that are sorted by their starts."""
    reach = np.maximum.accumulate(stops)
    cut = np.flatnonzero(starts[1:] > reach[:-1]) + 1
    return starts[np.append(0, cut)], reach[np.append(cut - 1, len(starts) - 1)]
