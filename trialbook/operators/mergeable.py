"""Models of any kind for very many cells in one job.

A model is four functions: ``partial(rows)`` makes a state of some rows, ``merge(a, b)`` joins two states, ``finish(state)``
makes the fitted model, and ``predict(model, rows)`` applies it. Rows become states where they lie, a state per batch
and cell, and only states travel. The states of all folds but one are merged from both ends: what precedes a fold
and what follows it. So states need no inverse, a cell may have any number of rows, and a job fits every cell of
every task.

Where states and models are rows of numbers (``ArrayMergeable``), all cells of a batch are worked on at once: a
batch's rows become states that are merged in pairs within their cells, and no cell costs a call of its own.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trialbook.plans.scan import join_groups
from trialbook.session import stage

# States that a task holds before it sends them on.
HELD_STATES = 4096


Columns = dict[str, np.ndarray]


class Mergeable(Protocol):
    """Rows are arrays by column name; a missing number is NaN, a missing text None."""

    def partial(self, rows: Columns) -> Any: ...

    def merge(self, a: Any, b: Any) -> Any: ...

    def finish(self, state: Any) -> Any: ...

    def predict(self, model: Any, rows: Columns) -> Sequence[Any]: ...


class ArrayMergeable(Protocol):
    """A model whose states, and fitted models, are rows of a matrix: a function works on all rows at once."""

    def singles(self, rows: Columns) -> np.ndarray: ...

    def merge_all(self, a: np.ndarray, b: np.ndarray) -> np.ndarray: ...

    def finish_all(self, states: np.ndarray) -> np.ndarray: ...

    def predict_all(self, models: np.ndarray, rows: Columns) -> np.ndarray: ...


def _keys_of(batch: pa.RecordBatch, keys: Sequence[str]) -> list[tuple]:
    return list(zip(*[batch.column(k).to_pylist() for k in keys], strict=True)) if keys else [()] * batch.num_rows


def _columns(batch: pa.RecordBatch, names: Sequence[str]) -> Columns:
    return {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}


def _rows(rows: Sequence[tuple], names: Sequence[str], types: Sequence[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=list(names))


def batch_states(batches: Iterator[pa.RecordBatch], keys: Sequence[str], partial: Callable[[Columns], Any], merge: Callable[[Any, Any], Any]) -> Iterator[pa.RecordBatch]:
    """A pickled state per cell of the batches, sent on whenever ``HELD_STATES`` cells are held: a cell may come several times."""
    states: dict[tuple, Any] = {}
    types: list[pa.DataType] = []

    def sent() -> pa.RecordBatch:
        return _rows([(*k, pickle.dumps(v)) for k, v in states.items()], [*keys, "state"], [*types, pa.binary()])

    for batch in batches:
        types = [batch.schema.field(k).type for k in keys]
        places: dict[tuple, list[int]] = {}
        for i, key in enumerate(_keys_of(batch, keys)):
            places.setdefault(key, []).append(i)
        columns = _columns(batch, [n for n in batch.schema.names if n not in keys])
        for key, at in places.items():
            state = partial({n: c[at] for n, c in columns.items()})
            states[key] = merge(states[key], state) if key in states else state
            if len(states) >= HELD_STATES:
                yield sent()
                states.clear()
    if states:
        yield sent()


def all_but_one(states: Sequence[Any], merge: Callable[[Any, Any], Any]) -> list[Any]:
    """For each place the merge of all other states, None where there is no other; about three merges a state."""
    n = len(states)
    before, after = [None] * n, [None] * n
    for i in range(1, n):
        before[i] = states[i - 1] if before[i - 1] is None else merge(before[i - 1], states[i - 1])
        j = n - 1 - i
        after[j] = states[j + 1] if after[j + 1] is None else merge(states[j + 1], after[j + 1])
    return [a if b is None else b if a is None else merge(b, a) for b, a in zip(before, after, strict=True)]


def merged(batches: Iterator[pa.RecordBatch], keys: Sequence[str], merge: Callable[[Any, Any], Any]) -> Iterator[tuple[tuple, Any, list[pa.DataType]]]:
    """(key, state, types) of every key of sorted batches of states; one state is held, however many a key has."""
    here, state, types = None, None, []
    for batch in batches:
        types = [batch.schema.field(k).type for k in keys]
        for key, blob in zip(_keys_of(batch, keys), batch.column("state").to_pylist(), strict=True):
            if key == here:
                state = merge(state, pickle.loads(blob))
            else:
                if here is not None:
                    yield here, state, types
                here, state = key, pickle.loads(blob)
    if here is not None:
        yield here, state, types


def _types(df: DataFrame, names: Sequence[str]) -> list[str]:
    kinds = dict(df.dtypes)
    return [f"`{n}` {kinds[n]}" for n in names]


def states(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], partial: Callable[[Columns], Any], merge: Callable[[Any, Any], Any], together: Sequence[str]) -> DataFrame:
    """(keys.., state): states of the rows, those with equal ``together`` columns in one task and in the order of the keys."""
    found = rows.select(*keys, *columns).mapInArrow(lambda batches: batch_states(batches, keys, partial, merge), ", ".join([*_types(rows, keys), "state binary"]))
    dealt = found.repartition(*together) if together else found.repartition(1)
    return dealt.sortWithinPartitions(*keys)


def fit(model: Mergeable, rows: DataFrame, keys: Sequence[str], fold: str, columns: Sequence[str]) -> DataFrame:
    """(keys.., fold, model): for every cell the model of all its other folds, NULL where it has no other."""
    by = [*keys, fold]

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        here, folds, kinds = None, [], []

        def models() -> list[tuple]:
            others = all_but_one([state for _, state in folds], model.merge)
            return [(*key, None if s is None else pickle.dumps(model.finish(s))) for (key, _), s in zip(folds, others, strict=True)]

        for key, state, kinds in merged(batches, by, model.merge):
            if key[:-1] != here:
                out += models()
                here, folds = key[:-1], []
            folds.append((key, state))  # a cell's folds
            if len(out) >= HELD_STATES:
                yield _rows(out, [*by, "model"], [*kinds, pa.binary()])
                out = []
        out += models()
        if out:
            yield _rows(out, [*by, "model"], [*kinds, pa.binary()])

    return states(rows, by, columns, model.partial, model.merge, keys).mapInArrow(fitted, ", ".join([*_types(rows, by), "model binary"]))


def _codes(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """A number per row, the same for rows with equal keys; NULL is a key like any other."""
    out = np.zeros(batch.num_rows, dtype=np.int64)
    for k in keys:
        codes = batch.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy()
        out = np.unique(out * (codes.max(initial=0) + 1) + codes, return_inverse=True)[1].astype(np.int64)
    return out


def _begins(codes: np.ndarray) -> np.ndarray:
    """Whether another group begins at a row."""
    return np.r_[np.ones(min(1, len(codes)), dtype=bool), codes[1:] != codes[:-1]]


def _places(begins: np.ndarray) -> np.ndarray:
    """The place of each row in its group, from 0."""
    at = np.arange(len(begins))
    return at - np.maximum.accumulate(np.where(begins, at, 0))


def merge_groups(states: np.ndarray, begins: np.ndarray, merge_all: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """One state per group of neighbouring rows, merged in pairs, so the rounds are as many as the largest group has binary digits."""
    while not begins.all():
        even = np.flatnonzero(_places(begins) % 2 == 0)
        paired = np.flatnonzero(np.diff(np.r_[even, len(states)]) == 2)
        out = states[even]
        out[paired] = merge_all(states[even[paired]], states[even[paired] + 1])
        states, begins = out, begins[even]
    return states


def others_of_groups(states: np.ndarray, begins: np.ndarray, merge_all: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each row the merge of all others of its group, and whether there are any; ``all_but_one`` for many groups."""
    before, after = states.copy(), states.copy()
    for sums, firsts, step in ((before, begins, -1), (after, np.r_[begins[1:], begins[:1]], 1)):
        # Rows at the same distance from the end of their groups are merged at once.
        distance = _places(firsts) if step < 0 else _places(firsts[::-1])[::-1]
        order = np.argsort(distance, kind="stable")
        cuts = np.r_[np.flatnonzero(np.diff(distance[order])) + 1, len(order)]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            at = order[low:high]
            sums[at] = states[at + step] if distance[at[0]] == 1 else merge_all(sums[at + step], states[at + step]) if step < 0 else merge_all(states[at + step], sums[at + step])
    first, last = begins, np.r_[begins[1:], begins[:1]]
    both = ~first & ~last
    out = np.where(last[:, None], before, after)
    out[both] = merge_all(before[both], after[both])
    return out, ~(first & last)


def _with_numbers(batch: pa.RecordBatch, keys: Sequence[str], at: np.ndarray, name: str, numbers: np.ndarray, known: np.ndarray | None = None) -> pa.RecordBatch:
    """The keys of some rows, and a row of numbers for each, NULL where it is not known."""
    width = numbers.shape[1]
    offsets = pa.array(np.arange(len(at) + 1, dtype=np.int32) * width)
    lists = pa.ListArray.from_arrays(offsets, pa.array(numbers.reshape(-1)), mask=None if known is None else pa.array(~known))
    return pa.RecordBatch.from_arrays([*[batch.column(k).take(pa.array(at)) for k in keys], lists], names=[*keys, name])


def _numbers(column: pa.Array) -> np.ndarray:
    """The rows of numbers that are not NULL."""
    n = len(column) - column.null_count
    return column.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(n, -1 if n else 0)


def fit_arrays(model: ArrayMergeable, rows: DataFrame, keys: Sequence[str], fold: str, columns: Sequence[str]) -> DataFrame:
    """``fit`` for models whose states are rows of numbers: only a state per batch and cell travels, whatever the size of a cell."""
    by = [*keys, fold]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = _codes(batch, by)
                order = np.argsort(codes, kind="stable")
                begins = _begins(codes[order])
                found = merge_groups(model.singles(_columns(batch, columns))[order], begins, model.merge_all)
                yield _with_numbers(batch, by, order[begins], "state", found)

    def models(batch: pa.RecordBatch, last: bool) -> tuple[pa.RecordBatch, pa.RecordBatch]:
        """The models of whole cells, and the states of the last cell, which may go on."""
        begins = _begins(_codes(batch, by))
        found, at = merge_groups(_numbers(batch.column("state")), begins, model.merge_all), np.flatnonzero(begins)
        cells = _begins(_codes(batch, keys)[at])
        cut = len(at) if last else int(np.flatnonzero(cells)[-1])
        others, known = others_of_groups(found[:cut], cells[:cut], model.merge_all)
        return _with_numbers(batch, by, at[:cut], "model", model.finish_all(others), known), _with_numbers(batch, by, at[cut:], "state", found[cut:])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                if held is not None:
                    batch = pa.Table.from_batches([held, batch.cast(held.schema)]).combine_chunks().to_batches()[0]
                done, held = models(batch, False)
                yield done
        if held is not None:
            yield models(held, True)[0]

    found = rows.select(*by, *columns).mapInArrow(partial, ", ".join([*_types(rows, by), "state array<double>"]))
    dealt = found.repartition(*keys) if keys else found.repartition(1)
    return dealt.sortWithinPartitions(*by).mapInArrow(fitted, ", ".join([*_types(rows, by), "model array<double>"]))


def cross_validated(
    model: Mergeable, rows: DataFrame, keys: Sequence[str], fold: str, truth: str, features: Sequence[str], kind: str = "string", rowid: str = "rowid",
) -> DataFrame:
    """(keys.., fold, row_id, prediction, truth): every row predicted by the model of its cell's other folds.

    ``rows`` is (keys.., fold, rowid, truth, features..), each row in one fold; ``kind`` is the type of predictions.
    NULL keys and folds are cells and folds like any other. Where a cell has no other fold predictions are NULL.
    """
    by, columns = [*keys, fold], list(dict.fromkeys([truth, *features]))
    rows = stage(rows.select(*by, rowid, *columns), "cells")
    arrays = hasattr(model, "merge_all")
    models = stage((fit_arrays if arrays else fit)(model, rows, keys, fold, columns), "models")
    # AQE splits the rows of a cell that is very large.
    both = join_groups(rows, models, by).select(*rows.columns, "model")

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places: dict[bytes | None, list[int]] = {}
            for i, blob in enumerate(batch.column("model").to_pylist()):
                places.setdefault(blob, []).append(i)
            values = _columns(batch, columns)
            guess: list = [None] * batch.num_rows
            for blob, at in places.items():
                if blob is not None:
                    for i, value in zip(at, model.predict(pickle.loads(blob), {n: c[at] for n, c in values.items()}), strict=True):
                        guess[i] = None if value != value else value
            out = pa.array(guess, pa.string() if kind == "string" else pa.float64())
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in [*by, rowid]], out, batch.column(truth)], names=[*by, "row_id", "prediction", "truth"])

    def predicted_at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fitted = batch.column("model").is_valid().to_numpy(zero_copy_only=False)
            guess = np.full(batch.num_rows, np.nan)
            if fitted.any():
                guess[fitted] = model.predict_all(_numbers(batch.column("model")), {n: c[fitted] for n, c in _columns(batch, columns).items()})
            out = pa.array(guess, pa.float64(), mask=np.isnan(guess))
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in [*by, rowid]], out, batch.column(truth)], names=[*by, "row_id", "prediction", "truth"])

    kinds = dict(rows.dtypes)
    return both.mapInArrow(predicted_at_once if arrays else predicted, ", ".join([*_types(rows, by), f"row_id {kinds[rowid]}", f"prediction {kind}", f"truth {kinds[truth]}"]))


class CountedBayes:
    """Naive Bayes over nominal columns from counts alone, with additive smoothing over the declared ``domains``.

    A NULL value is left out of the product. Log scores are compared to nine decimals; the first label wins a tie.
    """

    def __init__(self, target: str, domains: dict[str, Sequence[str]], labels: Sequence[str], smoothing: float = 1.0):
        self.target, self.domains, self.labels, self.smoothing = target, {k: list(v) for k, v in domains.items()}, list(labels), smoothing

    def partial(self, rows: Columns) -> Counter:
        counts: Counter = Counter()
        labels = rows[self.target].tolist()
        counts.update((None, None, c) for c in labels if c is not None)
        for column in self.domains:
            counts.update((column, v, c) for v, c in zip(rows[column].tolist(), labels, strict=True) if v is not None and c is not None)
        return counts

    def merge(self, a: Counter, b: Counter) -> Counter:
        return a + b

    def finish(self, state: Counter) -> dict:
        s, total = self.smoothing, sum(n for (column, _, _), n in state.items() if column is None)
        seen = {column: Counter() for column in self.domains}
        for (column, _, c), n in state.items():
            if column is not None:
                seen[column][c] += n
        prior = {c: math.log((state[None, None, c] + s) / (total + s * len(self.labels))) for c in self.labels}
        likely = {(column, v, c): math.log((state[column, v, c] + s) / (seen[column][c] + s * len(domain)))
                  for column, domain in self.domains.items() for v in domain for c in self.labels}
        return {"prior": prior, "likely": likely}

    def predict(self, model: dict, rows: Columns) -> list[str]:
        known: dict[tuple, str] = {}
        out = []
        for values in zip(*[rows[column].tolist() for column in self.domains], strict=True):
            if values not in known:
                likely = [sum(model["likely"].get((column, v, c), 0.0) for column, v in zip(self.domains, values, strict=True) if v is not None) for c in self.labels]
                scores = [round(model["prior"][c] + x, 9) for c, x in zip(self.labels, likely, strict=True)]
                known[values] = self.labels[scores.index(max(scores))]
            out.append(known[values])
        return out


class RidgeLine:
    """Least squares on any number of columns with a penalty on the slopes, from centred sums.

    A state is the number of rows, their means, and the sums of products of deviations, so values far from zero lose
    no digits. Rows with a NULL are not learned from, and get no prediction. Without a penalty, directions in which
    the columns do not vary have no slope.
    """

    def __init__(self, target: str, columns: Sequence[str], penalty: float = 0.0):
        self.columns, self.target, self.penalty = list(columns), target, penalty

    def partial(self, rows: Columns) -> tuple[int, np.ndarray, np.ndarray]:
        x = np.stack([rows[c].astype(float) for c in [*self.columns, self.target]], axis=1)
        x = x[~np.isnan(x).any(axis=1)]
        if not len(x):
            width = len(self.columns) + 1
            return 0, np.zeros(width), np.zeros((width, width))
        gaps = x - x[0]
        mean = gaps.mean(axis=0)
        gaps = gaps - mean
        return len(x), x[0] + mean, gaps.T @ gaps

    def merge(self, a: tuple, b: tuple) -> tuple:
        if not a[0] or not b[0]:
            return a if a[0] else b
        n, gap = a[0] + b[0], b[1] - a[1]
        return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)

    def finish(self, state: tuple) -> tuple[np.ndarray, float]:
        n, mean, products = state
        if not n:
            return np.zeros(len(self.columns)), math.nan
        square = products[:-1, :-1] + self.penalty * np.eye(len(self.columns))
        slopes = np.linalg.lstsq(square, products[:-1, -1], rcond=1e-12)[0]
        return slopes, float(mean[-1] - mean[:-1] @ slopes)

    def predict(self, model: tuple, rows: Columns) -> list[float]:
        return (np.stack([rows[c].astype(float) for c in self.columns], axis=1) @ model[0] + model[1]).tolist()

    # The same for many cells at once: a state is n, the means, and the rows of the products, one after the other.

    def singles(self, rows: Columns) -> np.ndarray:
        x = np.stack([rows[c].astype(float) for c in [*self.columns, self.target]], axis=1)
        whole = ~np.isnan(x).any(axis=1)
        return np.c_[whole, np.where(whole[:, None], x, 0.0), np.zeros((len(x), x.shape[1] ** 2))]

    def merge_all(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        w = len(self.columns) + 1
        n = a[:, :1] + b[:, :1]
        share, gap = b[:, :1] / np.maximum(n, 1), b[:, 1 : w + 1] - a[:, 1 : w + 1]
        products = a[:, w + 1 :] + b[:, w + 1 :] + (gap[:, :, None] * gap[:, None, :]).reshape(len(a), w * w) * (a[:, :1] * share)
        out = np.concatenate([n, a[:, 1 : w + 1] + gap * share, products], axis=1)
        return np.where(b[:, :1] == 0, a, np.where(a[:, :1] == 0, b, out))

    def finish_all(self, states: np.ndarray) -> np.ndarray:
        k = len(self.columns)
        mean, products = states[:, 1 : k + 2], states[:, k + 2 :].reshape(len(states), k + 1, k + 1)
        # As least squares do it: directions in which the columns do not vary get no slope.
        u, s, v = np.linalg.svd(products[:, :-1, :-1] + self.penalty * np.eye(k))
        along = np.einsum("nij,ni->nj", u, products[:, :-1, -1])
        kept = s > 1e-12 * s[:, :1]
        slopes = np.einsum("nij,ni->nj", v, np.where(kept, along / np.where(kept, s, 1.0), 0.0))
        start = mean[:, -1] - (mean[:, :-1] * slopes).sum(axis=1)
        empty = states[:, 0] == 0
        return np.c_[np.where(empty[:, None], 0.0, slopes), np.where(empty, np.nan, start)]

    def predict_all(self, models: np.ndarray, rows: Columns) -> np.ndarray:
        x = np.stack([rows[c].astype(float) for c in self.columns], axis=1)
        return (x * models[:, :-1]).sum(axis=1) + models[:, -1]
