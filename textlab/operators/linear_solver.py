"""Linear classifiers of several folds at once: every pass over the data serves all of them.

The rows of the data, `(index, fold, label, vector...)`, are dealt to shards by a hash of their index and written once, a
shard as one row of flat arrays. A fold is a column of the weight matrix; its problem is that of the rows outside of it. A pass broadcasts
the weights, a task takes one shard after the other and works on the slots that the shard holds, for all folds, and a second step adds up
the shards by ranges of slots, so that the driver gets one sum whatever their number. The number of shards depends on the data alone, and so do the results. Data of
one shard need no passes between driver and tasks: the same optimiser runs where the shard is, in a task for each fold.

Of several shards `settle` comes first: a pass gives the gradient of all rows and hands on the rows with curvature, few once most rows are on their side by far; a task for each fold
fits these, the others taken as linear, and the next pass judges what came out by all rows. Where that gets no further the methods below go on. `minimise` is a Newton method with conjugate gradients, preconditioned by the diagonal of the Hessian, and a search along each step. The folds
go in step, but none looks at another: a fold alone finds the same weights. `descend` is stochastic descent: seeded epochs
inside the shards, one decreasing step size for all, weights averaged over shards after every epoch. `ascend` is the dual of the squared hinge,
row by row inside the shards: where rows are many and badly scaled it needs a small share of the passes; `minimise` goes on from what it found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from textlab.session import ship, stage

SHARD_BYTES = 64 << 20
TASK_BYTES = 64 << 20  # a task returns sums as long as the weights, so it should have work worth that
_TOGETHER = 2.9  # shards' worth of data that one task may hold: a task for each fold then needs no passes between driver and tasks
_FEW_TASKS = 8  # sums that the driver may add up itself
_FREE = 1.0  # what a step changes the intercept by, against a weight of a value of 1
_LATER = 3  # by how much later epochs weigh more in a mean over epochs
_MOST_INNER = 200
_CHOSEN_ROWS, _CHOSEN = 1 << 12, 1 << 22  # rows and entries of the rows that one task fits, of all shards
_WEIGHTY = 1e-3  # a row with less curvature along itself, against the penalty, is taken as linear
_DIRECT, _DIRECT_ENTRIES = 2048, 1 << 20  # rows whose curvature a task inverts, and what they may have
_SETTLING, _STALLED = 40, 4  # rounds, and how many of them may pass without a third off the gradient
_ROUNDS, _LOCAL = 60, 5  # of dual ascent, and how often a round goes through the rows of a shard
_TURNS = 3  # shards take turns, other ones for other folds
_SHARES = 2.0 ** -np.concatenate([np.arange(24) / 2, np.arange(12, 36)])  # of a Newton step; very long rows that turn up allow small ones only
_RANGE = 1 << 16  # slots of a sum in one row
_ENTRIES = 1 << 21  # entries of a shard that are multiplied at once
_ROWS = 1 << 10  # rows that are packed at once
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BLOCK = "shard int, n int, index binary, fold binary, label binary, ends binary, own binary, slots binary, values array<binary>"  # slots: places in `own`, the slots of the shard


@dataclass(frozen=True)
class Problem:
    """What the tasks know of the folds."""

    size: int
    folds: tuple[int | None, ...]
    vectors: tuple[int, ...]


@dataclass(frozen=True)
class Shards:
    """The staged data: `vectors` tells which vector a fold uses, `folds` the folds, None for all rows."""

    table: DataFrame
    size: int
    folds: tuple[int | None, ...]
    vectors: tuple[int, ...]
    tasks: int
    count: int
    together: bool = False

    def only(self, fold: int | None) -> Shards:
        return replace(self, folds=(fold,), vectors=(self.vectors[self.folds.index(fold)],))

    @property
    def problem(self) -> Problem:
        return Problem(self.size, self.folds, self.vectors)


def shards_of(rows: DataFrame, columns: Sequence[str], size: int, folds: Sequence[int | None], entries: int) -> Shards:
    """Stage `(index, fold, label, columns...)`; a column holds vectors of `size` slots as `(type, size, indices, values)`, one for all folds or one for each."""
    ship(rows.sparkSession)
    count = max(1, -(-entries * (4 + 8 * len(columns)) // SHARD_BYTES))
    placed = rows.select("index", "fold", "label", *columns).withColumn("shard", F.pmod(F.xxhash64("index"), F.lit(count)).cast("int"))
    placed = placed.repartition(count, "shard").sortWithinPartitions("shard", "index")
    table = stage(placed.mapInArrow(_packed(list(columns)), _BLOCK), "shards")
    tasks = max(1, -(-entries * (4 + 8 * len(columns)) // TASK_BYTES))
    return Shards(table, size, tuple(folds), tuple(i if len(columns) > 1 else 0 for i in range(len(folds))), tasks, count, entries * (4 + 8 * len(columns)) <= _TOGETHER * SHARD_BYTES)


def _packed(columns: list[str]) -> Callable:
    def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Slots, values and lengths of vectors in their storage layout; a dense one has all slots."""
        lists = column.field("values")
        lengths = np.diff(lists.offsets.to_numpy())
        slots = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        sparse = np.repeat(column.field("type").to_numpy() == 0, lengths)
        slots[sparse] = column.field("indices").flatten().to_numpy()
        return slots.astype(np.int32), lists.flatten().fill_null(0.0).to_numpy(), lengths  # a term that no text outside of a fold has is null there

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts = -1, []
        for whole in batches:  # sorted by shard: one is held at a time
            for batch in (whole.slice(at, _ROWS) for at in range(0, whole.num_rows, _ROWS)):
                shards = batch.column("shard").to_numpy()
                for following in np.unique(shards).tolist():
                    if parts and following != shard:
                        yield packed(shard, parts)
                        parts = []
                    shard, part = following, batch.filter(pa.array(shards == following))
                    fold = part.column("fold").fill_null(-1).to_numpy().astype(np.int32)
                    found = [flat(part.column(c)) for c in columns]
                    parts.append((part.column("index").to_numpy(), fold, part.column("label").to_numpy(), found[0][2], found[0][0], *[f[1] for f in found]))
        if parts:
            yield packed(shard, parts)

    def packed(shard: int, parts: list[tuple]) -> pa.RecordBatch:
        index, fold, label, lengths, slots, *values = (np.concatenate(c) for c in zip(*parts))
        parts.clear()
        own = np.unique(slots)
        for low in range(0, len(slots), _ENTRIES):
            found, back = np.unique(slots[low : low + _ENTRIES], return_inverse=True)
            slots[low : low + _ENTRIES] = np.searchsorted(own, found)[back]
        arrays = index.astype(np.int64), fold, label.astype(np.float64), np.cumsum(lengths).astype(np.int64), own, slots
        listed = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.concat_arrays([_binary(v) for v in values]))
        names = [c.split(" ")[0] for c in _BLOCK.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([len(index)], pa.int32()), *map(_binary, arrays), listed], names)

    return apply


def _binary(array: np.ndarray) -> pa.Array:
    """The bytes of an array as one value."""
    return pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, array.nbytes], np.int32)), pa.py_buffer(np.ascontiguousarray(array))])


class Block:
    """One shard in a task; `local`: its slots are numbered by their places in `own`, so that weights and sums have only those."""

    def __init__(self, row: Mapping, local: bool = False) -> None:
        read = lambda name, kind: np.frombuffer(row[name], kind)
        self.shard, self.n = row["shard"], row["n"]
        self.index, self.fold, self.label = read("index", np.int64), read("fold", np.int32), read("label", np.float64)
        self.ends, self.slots = read("ends", np.int64), read("slots", np.int32)
        self.own = read("own", np.int32) if row.get("own") is not None else None
        if self.own is not None and not local:
            self.slots = self.own[self.slots]
        self.values = [np.frombuffer(v, np.float64) for v in row["values"]]
        lengths = np.diff(self.ends, prepend=0)
        self.row = np.repeat(np.arange(self.n, dtype=np.int32), lengths)
        self.filled = np.flatnonzero(lengths)
        self.begins = (self.ends - lengths)[self.filled]
        self._squares: dict[int, np.ndarray] = {}

    def dot(self, vector: int, weights: np.ndarray) -> np.ndarray:
        out, at = np.zeros(self.n), 0
        while at < len(self.filled):  # whole rows, some `_ENTRIES` at once
            to = max(at + 1, int(np.searchsorted(self.begins, self.begins[at] + _ENTRIES)))
            low, high = self.begins[at], self.ends[self.filled[to - 1]]
            out[self.filled[at:to]] = np.add.reduceat(self.values[vector][low:high] * weights[self.slots[low:high]], self.begins[at:to] - low)
            at = to
        return out

    def squares(self, vector: int) -> np.ndarray:
        """The squared length of each row."""
        if vector not in self._squares:
            self._squares[vector] = np.bincount(self.row, self.values[vector] ** 2, self.n)
        return self._squares[vector]

    def entries(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the entries of the rows `at`, and how many each row has."""
        lengths = np.diff(self.ends, prepend=0)[at]
        return np.arange(lengths.sum()) + np.repeat(self.ends[at] - np.cumsum(lengths), lengths), lengths

    def transposed(self, vector: int, by_row: np.ndarray, size: int, squared: bool = False) -> np.ndarray:
        out = np.zeros(size)
        for low in range(0, len(self.slots), _ENTRIES):
            part = slice(low, low + _ENTRIES)
            values = self.values[vector][part]
            out += np.bincount(self.slots[part], (values * values if squared else values) * by_row[self.row[part]], size)
        return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows whose arrays stay where they lie in the batch."""
    for batch in batches:
        for at in range(batch.num_rows):
            row = {name: batch.column(name)[at] for name in batch.schema.names}
            plain = {name: value.as_buffer() if pa.types.is_binary(value.type) else value.as_py() for name, value in row.items() if name != "values"}
            yield plain | {"values": [value.as_buffer() for value in row["values"].values]}


def _blocks(batches: Iterator[pa.RecordBatch], local: bool = False) -> Iterator[Block]:
    return (Block(row, local) for row in _rows(batches))


def joined(blocks: Sequence[Block]) -> Block:
    """Several shards as one; their slots are numbered alike."""
    if len(blocks) == 1:
        return blocks[0]
    sizes = np.cumsum([0] + [len(block.slots) for block in blocks])
    whole = {name: np.concatenate([getattr(block, name) for block in blocks]) for name in ("index", "fold", "label", "slots")}
    whole["ends"] = np.concatenate([block.ends + low for block, low in zip(blocks, sizes)])
    values = [np.concatenate(columns) for columns in zip(*[block.values for block in blocks])]
    return Block({"shard": blocks[0].shard, "n": len(whole["index"]), "values": values} | whole)


def logistic(z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss, slope and curvature by the signed margin."""
    p = np.exp(-np.logaddexp(0, z))
    return np.logaddexp(0, -z), -p, p * (1 - p)


def squared_hinge(z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    gap = np.maximum(0, 1 - z)
    return gap * gap, -2 * gap, 2.0 * (gap > 0)


def hinge(z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.maximum(0, 1 - z), -(z < 1).astype(float), np.zeros(len(z))


LOSSES = {"logistic": logistic, "squared_hinge": squared_hinge, "hinge": hinge}


def summed(blocks: Iterable[Block], problem: Problem, loss: str, weights: np.ndarray, along: np.ndarray | None) -> np.ndarray:
    """Per fold, over its rows: gradient, diagonal of the Hessian, loss and rows; or the Hessian times `along`."""
    size, of_loss = problem.size, LOSSES[loss]
    total = np.zeros((len(problem.folds), (size + 1) * (1 if along is not None else 2) + 2))
    for block in blocks:
        sign = 2 * block.label - 1
        for i, (fold, vector) in enumerate(zip(problem.folds, problem.vectors)):
            inside = np.ones(block.n) if fold is None else (block.fold != fold).astype(float)
            value, slope, curve = of_loss(sign * (block.dot(vector, weights[i, :-1]) + weights[i, -1]))
            if along is not None:
                slope = curve * inside * (block.dot(vector, along[i, :-1]) + along[i, -1])
            else:
                slope, curve = sign * slope * inside, curve * inside
                total[i, size + 1 : 2 * size + 1] += block.transposed(vector, curve, size, squared=True)
                total[i, 2 * size + 1] += curve.sum()
            total[i, :size] += block.transposed(vector, slope, size)
            total[i, size] += slope.sum()
            total[i, -2:] += (value * inside).sum(), inside.sum()
    return total


def summed_along(blocks: Iterable[Block], problem: Problem, loss: str, weights: np.ndarray, along: np.ndarray) -> np.ndarray:
    """Per fold the losses at the shares of a step."""
    total = np.zeros((len(problem.folds), len(_SHARES)))
    for block in blocks:
        sign = 2 * block.label - 1
        for i, (fold, vector) in enumerate(zip(problem.folds, problem.vectors)):
            inside = np.ones(block.n) if fold is None else (block.fold != fold).astype(float)
            here, there = (sign * (block.dot(vector, x[i, :-1]) + x[i, -1]) for x in (weights, along))
            total[i] += [(LOSSES[loss](here + share * there)[0] * inside).sum() for share in _SHARES]
    return total


def gram(lengths: np.ndarray, slots: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The products of some sparse rows with each other: of frequent slots as dense matrices, of the others by pairs of entries."""
    n = len(lengths)
    row, total = np.repeat(np.arange(n), lengths), np.zeros((n, n))
    _, slots, often = np.unique(slots, return_inverse=True, return_counts=True)
    most = max(8, n // 64)
    place = np.cumsum(often > most) - 1
    dense = often[slots] > most
    rows, columns, numbers = row[dense], place[slots[dense]], values[dense]
    order = np.argsort(columns, kind="stable")
    rows, columns, numbers = rows[order], columns[order], numbers[order]
    for low in range(0, int(place[-1]) + 1 if len(place) else 0, 512):
        part = slice(*np.searchsorted(columns, [low, low + 512]))
        wide = np.zeros((n, 512))
        wide[rows[part], columns[part] - low] = numbers[part]
        total += wide @ wide.T
    rows, columns, numbers = row[~dense], slots[~dense], values[~dense]
    order = np.argsort(columns, kind="stable")
    rows, columns, numbers = rows[order], columns[order], numbers[order]
    begins = np.searchsorted(columns, columns)
    for low in range(0, len(rows), _ENTRIES // most):
        count = often[columns[low : low + _ENTRIES // most]]
        one = np.repeat(np.arange(low, low + len(count)), count)
        other = begins[one] + np.arange(len(one)) - np.repeat(np.cumsum(count) - count, count)
        total += np.bincount(rows[one] * n + rows[other], numbers[one] * numbers[other], n * n).reshape(n, n)
    return total


def gradient_sums(blocks: Iterable[Block], problem: Problem, loss: str, weights: np.ndarray, going: Sequence[bool]) -> np.ndarray:
    """Per fold that still goes, over its rows: gradient, curvature and loss."""
    size = problem.size
    total = np.zeros((len(problem.folds), size + 3))
    for block in blocks:
        sign = 2 * block.label - 1
        for i, (fold, vector) in enumerate(zip(problem.folds, problem.vectors)):
            if not going[i]:
                continue
            inside = np.ones(block.n) if fold is None else (block.fold != fold).astype(float)
            value, slope, curve = LOSSES[loss](sign * (block.dot(vector, weights[i, :-1]) + weights[i, -1]))
            slope = sign * slope * inside
            some = np.flatnonzero(slope)
            if 2 * len(some) < block.n:  # a hinge is flat for most rows
                places, lengths = block.entries(some)
                total[i, :size] += np.bincount(block.slots[places], block.values[vector][places] * np.repeat(slope[some], lengths), size)
            else:
                total[i, :size] += block.transposed(vector, slope, size)
            total[i, size:] += slope.sum(), (curve * inside).sum(), (value * inside).sum()
    return total


@dataclass(frozen=True)
class Choice:
    """Which rows of a shard a task is to fit, so many rows and entries at most, at random in the first round; for the folds that still go."""

    first: bool
    rows: int
    entries: int
    going: tuple[bool, ...]
    penalty: float
    seed: int

    def of(self, shards: int) -> Choice:
        """What falls to each shard."""
        return replace(self, rows=-(-self.rows // shards), entries=-(-self.entries // shards))


def chosen_rows(block: Block, problem: Problem, loss: str, weights: np.ndarray, choice: Choice) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per fold that still goes: its place, and signs, lengths, slots and values of the rows that weigh most: by curvature, or by how far they are on the wrong side."""
    sign, lengths = 2 * block.label - 1, np.diff(block.ends, prepend=0)
    random = np.random.default_rng((choice.seed, block.shard)).permutation(block.n)
    for i, (fold, vector) in enumerate(zip(problem.folds, problem.vectors)):
        if not choice.going[i]:
            continue
        inside, values = np.ones(block.n, bool) if fold is None else block.fold != fold, block.values[vector]
        if choice.first:
            order = random[inside[random]]
        else:
            _, slope, curve = LOSSES[loss](sign * (block.dot(vector, weights[i, :-1]) + weights[i, -1]))
            along = np.where(inside, np.maximum(curve, slope * slope) * (block.squares(vector) + 1), 0.0)
            order = np.argsort(-along, kind="stable")
            order = order[along[order] > _WEIGHTY * choice.penalty][: choice.rows]
        at = np.sort(order[np.cumsum(lengths[order]) <= choice.entries])
        places, found = block.entries(at)
        yield i, sign[at], found, block.slots[places], values[places]


@dataclass(frozen=True)
class Fit:
    """The objective of the rows that were chosen, and how far a task fits them."""

    loss: str
    penalty: float
    intercept: bool
    penalised: bool
    iterations: int
    first: bool


def fitted_rows(parts: Sequence[tuple[np.ndarray, ...]], fit: Fit, weights: np.ndarray, gradient: np.ndarray, curve: float, norm: float) -> tuple[np.ndarray, np.ndarray, int]:
    """The slots of some rows and the weights there, the intercept last: minimum of the loss of these rows, the others being linear.

    `gradient` and `curve` are those of all rows at `weights`, the intercept last. `norm` is the gradient to get below. Of a first sample the other rows are left out.
    """
    sign, lengths, slots, values = (np.concatenate(c) for c in zip(*parts))
    own, size = np.unique(slots), len(weights) - 1
    row = {"shard": 0, "n": len(sign), "index": np.arange(len(sign)), "fold": np.zeros(len(sign), np.int32), "label": (sign + 1) / 2}
    block = Block(row | {"ends": np.cumsum(lengths).astype(np.int64), "slots": np.searchsorted(own, slots).astype(np.int32), "values": [values]})
    data, places = InTask(block, Problem(len(own), (None,), (0,)), fit.loss, direct=True), np.append(own, size)
    w = weights[places][None]
    of_rows = gradient_sums([block], data.problem, fit.loss, w, (True,))[0]
    others = None if fit.first else (gradient[places] - of_rows[:-2])[None]
    # The other rows are linear but for the intercept, which nothing else may hold.
    held = 0.0 if fit.first else max(curve - of_rows[-2], 0.0)
    at_zero = np.linalg.norm(of_rows[:-2]) if fit.first else 1.0
    found = minimise(data, fit.penalty, fit.intercept, fit.penalised, 1e-6 if fit.first else norm, fit.iterations, (w, np.array([at_zero])), others, held)
    return own, found.weights[0], data.count


_PART = "start bigint, length int, part binary"


def _parts(ranges: Iterable[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    """Ranges of a sum as compressed rows: most slots of most sums are zero. The first range is always there."""
    kept = [(start, len(numbers), pa.compress(numbers.tobytes(), codec="lz4", asbytes=True)) for start, numbers in ranges if start == 0 or numbers.any()]
    kinds = ("start", pa.int64()), ("length", pa.int32()), ("part", pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([row[i] for row in kept], kind) for i, (_, kind) in enumerate(kinds)], [name for name, _ in kinds])


def _ranges(total: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    flat = total.reshape(-1)
    return ((start, flat[start : start + _RANGE]) for start in range(0, len(flat), _RANGE))


def _own_ranges(found: np.ndarray, own: np.ndarray, sections: int, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Ranges of the sums of all folds from those that a shard has for its `own` slots, one range in memory at a time.

    A fold has `sections` times `size` numbers and some more. A range on the border of two of these comes twice, to be added up.
    """
    width, more = len(own), np.arange(found.shape[1] - sections * len(own))
    length = sections * size + len(more)
    whole = len(found) * length
    for i, numbers in enumerate(found):
        parts = [(i * length + s * size + own, numbers[s * width : (s + 1) * width]) for s in range(sections)]
        for places, values in [*parts, (i * length + sections * size + more, numbers[sections * width :])]:
            at = 0
            while at < len(places):
                start = int(places[at]) // _RANGE * _RANGE
                to = int(np.searchsorted(places, start + _RANGE))
                out = np.zeros(min(_RANGE, whole - start))
                out[places[at:to] - start] = values[at:to]
                yield start, out
                at = to


def _summed_ranges(batches: Iterable[pa.RecordBatch]) -> dict[int, np.ndarray]:
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for start, length, part in zip(*(batch.column(name).to_pylist() for name in ("start", "length", "part"))):
            numbers = np.frombuffer(pa.decompress(part, decompressed_size=8 * length, codec="lz4"), np.float64)
            held[start] = held[start] + numbers if start in held else numbers
    return held


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield _parts(_summed_ranges(batches).items())


def _collected(parts: DataFrame, tasks: int, length: int) -> np.ndarray:
    """The sum of what the tasks give, in one row of numbers; with many tasks they are added up by ranges before."""
    if tasks > _FEW_TASKS:
        parts = parts.repartition("start").mapInArrow(_added, _PART)
    total = np.zeros(length)
    for start, numbers in _summed_ranges(parts.toArrow().to_batches()).items():
        total[start : start + len(numbers)] = numbers
    return total


class Sums:
    """What the optimisers ask of the data; `count` tells how many passes there were."""

    def __init__(self, problem: Problem, loss: str) -> None:
        self.problem, self.loss, self.count = problem, loss, 0

    def sums(self, weights: np.ndarray, along: np.ndarray | None) -> np.ndarray:
        raise NotImplementedError

    def losses(self, weights: np.ndarray, along: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def epoch(self, weights: np.ndarray, averaged: np.ndarray, course: Course) -> np.ndarray:
        raise NotImplementedError

    def round(self, weights: np.ndarray, duals: np.ndarray, climb: Climb) -> np.ndarray:
        raise NotImplementedError

    def rows(self) -> dict[int, int]:
        """Rows of each shard."""
        raise NotImplementedError

    def nearly(self, weights: np.ndarray, ridge: np.ndarray, diagonal: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
        """About the inverse of the Hessian, whose diagonal is given: here that of the diagonal."""
        return lambda r: r / diagonal

    def slopes(self, weights: np.ndarray, going: Sequence[bool]) -> np.ndarray:
        raise NotImplementedError

    def fitted(self, weights: np.ndarray, sums: np.ndarray, choice: Choice, fit: Fit, norms: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Per place of a fold that still goes what `fitted_rows` gives for its chosen rows, if there are any; `sums` are the slopes at the weights."""
        raise NotImplementedError

    def along(self, weights: np.ndarray, step: np.ndarray) -> np.ndarray:
        """The loss of each fold at the shares of a step."""
        self.count += 1
        return self.losses(weights, step)

    def at(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(gradient, diagonal, loss, rows) of each fold."""
        self.count += 1
        found, d = self.sums(weights, None), self.problem.size + 1
        return found[:, :d], found[:, d : 2 * d], found[:, -2], found[:, -1]

    def hessian_times(self, weights: np.ndarray, along: np.ndarray) -> np.ndarray:
        self.count += 1
        return self.sums(weights, along)[:, : self.problem.size + 1]


class InTask(Sums):
    """One shard, or a few, in the task that has them."""

    def __init__(self, blocks: Block | Sequence[Block], problem: Problem, loss: str, direct: bool = False) -> None:
        """`direct`: the curvature of the rows that have most of it is inverted, not their diagonal alone."""
        super().__init__(problem, loss)
        self.direct = direct
        self.blocks, self.curve_at, self.curves = [blocks] if isinstance(blocks, Block) else list(blocks), None, []

    def hessian_times(self, weights: np.ndarray, along: np.ndarray) -> np.ndarray:
        """The curvature of each row is kept as long as the weights are the same array."""
        self.count += 1
        problem = self.problem
        each = [(block, i, fold, vector) for block in self.blocks for i, (fold, vector) in enumerate(zip(problem.folds, problem.vectors))]
        if self.curve_at is not weights:
            self.curves = []
            for block, i, fold, vector in each:
                sign, inside = 2 * block.label - 1, np.ones(block.n) if fold is None else (block.fold != fold).astype(float)
                self.curves.append(LOSSES[self.loss](sign * (block.dot(vector, weights[i, :-1]) + weights[i, -1]))[2] * inside)
            self.curve_at = weights
        out = np.zeros((len(problem.folds), problem.size + 1))
        for (block, i, _, vector), curve in zip(each, self.curves):
            slope = curve * (block.dot(vector, along[i, :-1]) + along[i, -1])
            out[i, :-1] += block.transposed(vector, slope, problem.size)
            out[i, -1] += slope.sum()
        return out

    def nearly(self, weights: np.ndarray, ridge: np.ndarray, diagonal: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
        """For one fold the inverse of the diagonal and the rows with the most curvature along themselves, which few rows are nearly all of."""
        if not self.direct or len(self.problem.folds) > 1 or len(self.blocks) > 1:
            return super().nearly(weights, ridge, diagonal)
        block, fold, vector, size = self.blocks[0], self.problem.folds[0], self.problem.vectors[0], self.problem.size
        sign, values = 2 * block.label - 1, block.values[vector]
        curve = LOSSES[self.loss](sign * (block.dot(vector, weights[0, :-1]) + weights[0, -1]))[2] * (True if fold is None else block.fold != fold)
        along = curve * (block.squares(vector) + 1)
        order = np.argsort(-along, kind="stable")[:_DIRECT]
        order = order[along[order] > 0]
        at = np.sort(order[np.cumsum(np.diff(block.ends, prepend=0)[order]) <= _DIRECT_ENTRIES])
        if not len(at):
            return super().nearly(weights, ridge, diagonal)
        places, lengths = block.entries(at)
        slots, scaled = block.slots[places], values[places] * np.repeat(np.sqrt(curve[at]), lengths)
        # What these rows do not have of the diagonal; the intercept may have nothing else.
        rest = diagonal[0] - np.append(np.bincount(slots, scaled * scaled, size), curve[at].sum())
        root = np.sqrt(np.maximum(rest, np.maximum(ridge[0], 1e-9 * diagonal[0])))
        root[-1] = max(root[-1], 1e-3 * np.sqrt(diagonal[0, -1]))
        slots = np.concatenate([slots, np.full(len(at), size)])
        scaled = np.concatenate([scaled, np.sqrt(curve[at])]) / root[slots]
        row = np.concatenate([np.repeat(np.arange(len(at)), lengths), np.arange(len(at))])
        order = np.argsort(row, kind="stable")
        slots, scaled, row = slots[order], scaled[order], row[order]
        inverse = np.linalg.inv(gram(lengths + 1, slots, scaled) + np.eye(len(at)))

        def apply(r: np.ndarray) -> np.ndarray:
            x = r[0] / root
            of_rows = inverse @ np.bincount(row, scaled * x[slots], len(at))
            return ((x - np.bincount(slots, scaled * of_rows[row], size + 1)) / root)[None]

        return apply

    def sums(self, weights: np.ndarray, along: np.ndarray | None) -> np.ndarray:
        return summed(self.blocks, self.problem, self.loss, weights, along)

    def losses(self, weights: np.ndarray, along: np.ndarray) -> np.ndarray:
        return summed_along(self.blocks, self.problem, self.loss, weights, along)

    def epoch(self, weights: np.ndarray, averaged: np.ndarray, course: Course) -> np.ndarray:
        return epoch_sums(self.blocks, self.problem, weights, averaged, course)

    def round(self, weights: np.ndarray, duals: np.ndarray, climb: Climb) -> np.ndarray:
        return round_sums(self.blocks, self.problem, weights, duals, climb)

    def rows(self) -> dict[int, int]:
        return {block.shard: block.n for block in self.blocks}

    def slopes(self, weights: np.ndarray, going: Sequence[bool]) -> np.ndarray:
        return gradient_sums(self.blocks, self.problem, self.loss, weights, going)

    def fitted(self, weights: np.ndarray, sums: np.ndarray, choice: Choice, fit: Fit, norms: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        held: dict[int, list] = {}
        for block in self.blocks:
            for i, *arrays in chosen_rows(block, self.problem, self.loss, weights, choice.of(len(self.blocks))):
                held.setdefault(i, []).append(arrays)
        return {i: fitted_rows(parts, fit, weights[i], sums[i, :-2], sums[i, -2], norms[i])[:2] for i, parts in held.items() if sum(len(part[0]) for part in parts)}


def _cut(sent: Sequence[Broadcast], places: np.ndarray) -> np.ndarray:
    """Some columns of a matrix that was sent by rows; no more than one row is in memory at a time."""
    out = np.empty((len(sent), len(places)))
    for i, one in enumerate(sent):
        out[i] = one.value[places]
        vars(one).pop("_value", None)  # read again where it is needed again
    return out


_ROWS_OF = "place int, shard int, sign binary, lengths binary, slots binary, values binary"


class OverShards(Sums):
    """All shards, a Spark job for each pass.

    The files that a pass shuffles go when it ends: sums as long as the weights, from every task, would fill the disk in hundreds of passes.
    Weights are sent once for the passes that use the same array.
    """

    def __init__(self, shards: Shards, loss: str) -> None:
        super().__init__(shards.problem, loss)
        self.tasks, self.table = shards.tasks, shards.table.coalesce(shards.tasks).persist()
        self.held, self.held_of = None, None
        conf = self.table.sparkSession.conf
        self.cleanup = conf.get(_CLEANUP, "false")
        conf.set(_CLEANUP, "true")

    def close(self) -> None:
        self.table.sparkSession.conf.set(_CLEANUP, self.cleanup)
        self._hold(None)
        self.table.unpersist()

    def _sent(self, matrix: np.ndarray) -> list[Broadcast]:
        """A row each: a task reads one after the other and keeps what its slots have."""
        return [self.table.sparkSession.sparkContext.broadcast(row) for row in matrix]

    def _hold(self, weights: np.ndarray | None) -> list[Broadcast] | None:
        if self.held_of is not weights:
            for one in self.held or []:
                one.destroy()
            self.held = None if weights is None else self._sent(weights)
            self.held_of = weights
        return self.held

    def _run(self, of_block: Callable, sections: int, more: int, weights: np.ndarray, *others: np.ndarray, whole: np.ndarray | None = None) -> np.ndarray:
        """The sums of what `of_block` gives for a shard: for each fold `sections` times a number for each weight, and `more` numbers.

        A task holds, of one shard after the other, the weights and sums for the slots of that shard, and all weights of one fold at a time; `whole` is not cut.
        """
        context, problem = self.table.sparkSession.sparkContext, self.problem
        rest = [self._sent(m) for m in others]
        sent, uncut = [self._hold(weights), *rest], [] if whole is None else [context.broadcast(whole)]

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in _blocks(batches, local=True):
                own = np.append(block.own, problem.size).astype(np.int64)  # the intercept's place, too
                found = of_block(block, replace(problem, size=len(block.own)), *[_cut(m, own) for m in sent], *[m.value for m in uncut])
                yield _parts(_own_ranges(found, own, sections, problem.size + 1))

        length = sections * (problem.size + 1) + more
        found = _collected(self.table.mapInArrow(apply, _PART), self.tasks, length * len(problem.folds))
        for one in [*uncut, *[m for matrix in rest for m in matrix]]:
            one.destroy()
        return found.reshape(len(problem.folds), -1)

    def sums(self, weights: np.ndarray, along: np.ndarray | None) -> np.ndarray:
        loss = self.loss
        if along is None:
            return self._run(lambda block, problem, w: summed([block], problem, loss, w, None), 2, 2, weights)
        return self._run(lambda block, problem, w, a: summed([block], problem, loss, w, a), 1, 2, weights, along)

    def losses(self, weights: np.ndarray, along: np.ndarray) -> np.ndarray:
        loss = self.loss
        return self._run(lambda block, problem, w, a: summed_along([block], problem, loss, w, a), 0, len(_SHARES), weights, along)

    def epoch(self, weights: np.ndarray, averaged: np.ndarray, course: Course) -> np.ndarray:
        return self._run(lambda block, problem, w, a: epoch_sums([block], problem, w, a, course), 2, 3, weights, averaged)

    def round(self, weights: np.ndarray, duals: np.ndarray, climb: Climb) -> np.ndarray:
        return self._run(lambda block, problem, w, d: round_sums([block], problem, w, d, climb), 2, duals.shape[1], weights, whole=duals)

    def slopes(self, weights: np.ndarray, going: Sequence[bool]) -> np.ndarray:
        loss = self.loss
        return self._run(lambda block, problem, w: gradient_sums([block], problem, loss, w, going), 1, 2, weights)

    def fitted(self, weights: np.ndarray, sums: np.ndarray, choice: Choice, fit: Fit, norms: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        context, problem, loss = self.table.sparkSession.sparkContext, self.problem, self.loss
        choice, sent = choice.of(len(self.rows())), self._hold(weights)
        both = {i: context.broadcast(np.stack([weights[i], sums[i, :-2]])) for i in np.flatnonzero(choice.going).tolist()}  # a task reads those of its fold
        curves, names = sums[:, -2].copy(), [c.split(" ")[0] for c in _ROWS_OF.split(", ")]

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in _blocks(batches, local=True):
                own = np.append(block.own, problem.size).astype(np.int64)
                for i, sign, lengths, slots, values in chosen_rows(block, replace(problem, size=len(block.own)), loss, _cut(sent, own), choice):
                    arrays = sign, lengths.astype(np.int64), block.own[slots], values
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([block.shard], pa.int32()), *map(_binary, arrays)], names)

        def fit_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, list] = {}
            for batch in batches:
                for i, shard, *arrays in zip(*(batch.column(name).to_pylist() for name in names)):
                    read = [np.frombuffer(a, kind) for a, kind in zip(arrays, (np.float64, np.int64, np.int32, np.float64))]
                    held.setdefault(i, []).append((shard, read))
            for i in sorted(held):
                parts = [read for _, read in sorted(held.pop(i), key=lambda part: part[0])]
                if sum(len(part[0]) for part in parts):
                    weights, gradient = both[i].value
                    own, found, _ = fitted_rows(parts, fit, weights, gradient, curves[i], norms[i])
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), _binary(own.astype(np.int32)), _binary(found)], ["place", "own", "weights"])

        rows = self.table.mapInArrow(choose, _ROWS_OF).repartitionById(len(problem.folds), F.col("place"))
        out = rows.mapInArrow(fit_each, "place int, own binary, weights binary").toArrow().to_pylist()
        for one in both.values():
            one.destroy()
        return {row["place"]: (np.frombuffer(row["own"], np.int32), np.frombuffer(row["weights"], np.float64)) for row in out}

    def rows(self) -> dict[int, int]:
        return {row["shard"]: row["n"] for row in self.table.select("shard", "n").collect()}


@dataclass(frozen=True)
class Found:
    """Weights by fold, the intercept last; the norms of the gradients at the start and at the end, passes over the data."""

    weights: np.ndarray
    start: np.ndarray
    norms: np.ndarray
    objective: np.ndarray
    passes: int


def solve(shards: Shards, loss: str, method: Callable[[Sums], Found]) -> Found:
    """Run an optimiser over the data, `method` being made for any number of folds."""
    if shards.count > 1 and not shards.together:
        data = OverShards(shards, loss)
        try:
            return method(data)
        finally:
            data.close()
    problem = shards.problem

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[Block]] = {}
        for row in _rows(batches):
            held.setdefault(row["place"], []).append(Block(row))
        for at, blocks in sorted(held.items()):
            blocks.sort(key=lambda b: b.shard)
            # Descent goes through all rows as one shard: in less epochs than a mean over several.
            found = method(InTask(joined(blocks) if loss == "hinge" else blocks, Problem(problem.size, (problem.folds[at],), (problem.vectors[at],)), loss))
            numbers = [float(found.start[0]), float(found.norms[0]), float(found.objective[0])]
            values = [at, found.weights.tobytes(), *numbers, found.passes]
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], ["place", "weights", "start", "norm", "objective", "passes"])

    # Each task reads the files by itself, so nothing is shuffled; a batch is a shard, and the union keeps a task for each fold.
    conf, own = shards.table.sparkSession.conf, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1", "spark.sql.unionOutputPartitioning": "false"}
    before = {name: conf.get(name) for name in own}
    try:
        for name, value in own.items():
            conf.set(name, value)
        each = reduce(DataFrame.unionAll, [shards.table.coalesce(1).withColumn("place", F.lit(i).cast("long")) for i in range(len(problem.folds))])
        found = each.mapInArrow(apply, "place bigint, weights binary, start double, norm double, objective double, passes bigint").toArrow()
    finally:
        for name, value in before.items():
            conf.set(name, value)
    rows = found.sort_by("place").to_pydict()
    if not rows["place"]:  # no data at all
        zero = np.zeros(len(problem.folds))
        return Found(np.zeros((len(problem.folds), problem.size + 1)), zero, zero, zero, 0)
    numbers = [np.array(rows[name]) for name in ("start", "norm", "objective")]
    return Found(np.stack([np.frombuffer(w, np.float64) for w in rows["weights"]]), *numbers, max(rows["passes"]))


def minimise(data: Sums, penalty: float, intercept: bool, penalised: bool, tolerance: float, iterations: int, first: tuple[np.ndarray, np.ndarray] | None = None, others: np.ndarray | None = None, held: float = 0.0) -> Found:
    """Minimise, per fold, the sum of the losses plus penalty / 2 times the squared weights, with or without the intercept's.

    A fold is done when its gradient is below `tolerance` times that at zero. `first` are weights to begin with and the norms at zero.
    `others` are slopes of a further linear term, and `held` the curvature of the intercept around its first place.
    """
    count, d = len(data.problem.folds), data.problem.size + 1
    ridge = np.full((count, d), float(penalty))
    free = np.ones(d)
    free[-1] = float(intercept)
    if not penalised:
        ridge[:, -1] = 0.0
    w = np.zeros((count, d)) if first is None else first[0]
    dots = lambda a, b: (a * b).sum(axis=1)
    linear = np.zeros((count, d)) if others is None else others.copy()
    linear[:, -1] -= held * w[:, -1]
    ridge[:, -1] += held

    def evaluate(weights: np.ndarray):
        gradient, diagonal, value, _ = data.at(weights)
        scale = np.where(free > 0, diagonal + ridge, 1.0)
        return value + dots(ridge, weights * weights) / 2 + dots(linear, weights), (gradient + ridge * weights + linear) * free, np.maximum(scale, 1e-12)

    f, g, m = evaluate(w)
    start = np.sqrt(dots(g, g)) if first is None else first[1]
    active = start > 0
    for _ in range(iterations):
        active &= np.sqrt(dots(g, g)) > tolerance * start
        if not active.any():
            break
        step, r = np.zeros_like(w), -g
        inverse = data.nearly(w, ridge, m)
        z = inverse(r) * free
        p, rz = z.copy(), dots(r, z)
        # Far from the minimum a rough step is enough.
        limit = np.sqrt(rz) * np.clip(np.sqrt(np.sqrt(dots(g, g)) / np.where(start > 0, start, 1)), 0.05, 0.5)
        going = active & (rz > 0)
        for _ in range(_MOST_INNER):
            if not going.any():
                break
            h = (data.hessian_times(w, p * going[:, None]) + ridge * p) * free
            curve = dots(p, h)
            going &= curve > 0
            alpha = np.where(going, rz / np.where(curve > 0, curve, 1), 0.0)
            step, r = step + alpha[:, None] * p, r - alpha[:, None] * h
            z = inverse(r) * free
            following = dots(r, z)
            going &= np.sqrt(np.maximum(following, 0)) > limit
            p = z + np.where(rz > 0, following / np.where(rz > 0, rz, 1), 0.0)[:, None] * p
            rz = following
        # The objective at shares of the step, all in one pass; the best one is taken.
        square = dots(ridge, w * w)[:, None] + 2 * dots(ridge, w * step)[:, None] * _SHARES + dots(ridge, step * step)[:, None] * _SHARES**2
        values = data.along(w, step) + square / 2 + dots(linear, w)[:, None] + dots(linear, step)[:, None] * _SHARES
        best = values.argmin(axis=1)
        lower = active & (values[np.arange(count), best] < f)
        w = w + np.where(lower, _SHARES[best], 0.0)[:, None] * step
        active &= lower  # else it is as low as doubles can tell
        f, g, m = evaluate(w)
    return Found(w, start, np.sqrt(dots(g, g)), f, data.count)


def settle(data: Sums, penalty: float, intercept: bool, penalised: bool, tolerance: float, iterations: int, seed: int = 42) -> tuple[Found, bool]:
    """What `minimise` finds, by fits of the rows that have curvature, and whether all folds got there.

    A first sample gives weights to begin with. The gradient of all rows ends a fold. Rows that no task fits count as linear, so the minimum of a fit is below that of all rows and
    rises with the rows that the next choice adds; the objective of all rows may rise meanwhile. Of a fold that gets no further the best weights are returned.
    """
    count, d = len(data.problem.folds), data.problem.size + 1
    ridge, free = np.full(d, float(penalty)), np.ones(d)
    free[-1], ridge[-1] = float(intercept), float(penalty) * penalised
    dots = lambda a, b: np.einsum("ij,ij->i", a, b)

    def judged(weights: np.ndarray, going: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(slopes, objective, norm of the gradient)."""
        data.count += 1
        sums = data.slopes(weights, tuple(going.tolist()))
        whole = [np.linalg.norm((sums[i, :d] + ridge * weights[i]) * free) for i in range(count)]
        return sums, sums[:, -1] + dots(weights * ridge, weights) / 2, np.array(whole)

    w, going = np.zeros((count, d)), np.ones(count, bool)
    sums, objective, norms = judged(w, going)
    start, least, since = norms.copy(), norms.copy(), np.zeros(count, int)
    best, lowest = w.copy(), objective.copy()
    going = start > 0
    for number in range(_SETTLING):
        going &= (norms > tolerance * start) & (since < _STALLED)
        if not going.any():
            break
        data.count += 1
        choice = Choice(number == 0, _CHOSEN_ROWS, _CHOSEN // 16 if number == 0 else _CHOSEN, tuple(going.tolist()), penalty, seed)
        fit = Fit(data.loss, penalty, intercept, penalised, iterations, number == 0)
        found = data.fitted(w, sums, choice, fit, np.maximum(tolerance * start / 20, norms * 1e-3))
        trial = w.copy()
        for i, (own, weights) in found.items():
            if number:
                trial[i, :-1] = -sums[i, : d - 1] / penalty  # slots that only linear rows have
            trial[i, own], trial[i, -1] = weights[:-1], weights[-1]
        going &= np.array([i in found for i in range(count)])
        after = judged(trial, going)
        w[going] = trial[going]
        for now, then in zip((sums, objective, norms), after):
            now[going] = then[going]
        better = going & (objective < lowest)
        best[better], lowest[better] = w[better], objective[better]
        since = np.where(norms < least * 2 / 3, 0, since + 1)
        least = np.minimum(least, norms)
    done = norms <= tolerance * start
    return Found(np.where(done[:, None], w, best), start, norms, np.where(done, objective, lowest), data.count), bool(done.all())


@dataclass(frozen=True)
class Climb:
    """A round of dual ascent: which folds still go, and where the duals of a shard begin."""

    round: int
    penalty: float
    intercept: bool
    seed: int
    going: tuple[bool, ...]
    begins: Mapping[int, int]


def round_sums(blocks: Iterable[Block], problem: Problem, weights: np.ndarray, duals: np.ndarray, climb: Climb) -> np.ndarray:
    """Each shard goes through its rows from the common weights and sets the dual of one row after the other to its best.

    Shards take turns, so that tasks have different folds to do. A shard takes its own changes as if all shards of its turn made the same, so
    that the changes of all may be added. Per fold: the changes of the weights, the gradient of the losses at the common weights, the
    changes of the duals.
    """
    size, turns = problem.size, min(len(climb.begins), _TURNS)
    shards = -(-len(climb.begins) // turns)
    place = {shard: at for at, shard in enumerate(sorted(climb.begins))}
    total = np.zeros((len(problem.folds), 2 * (size + 1) + duals.shape[1]))
    for block in blocks:
        begins, ends, sign = (block.ends - np.diff(block.ends, prepend=0)).tolist(), block.ends.tolist(), 2 * block.label - 1
        signs, random = sign.tolist(), np.random.default_rng((climb.seed, climb.round, block.shard))
        orders = [random.permutation(block.n) for _ in range(_LOCAL)]
        low = climb.begins[block.shard]
        for i, (fold, vector) in enumerate(zip(problem.folds, problem.vectors)):
            if not climb.going[i]:
                continue
            values, slots = block.values[vector], block.slots
            inside = np.ones(block.n, bool) if fold is None else block.fold != fold
            slope = sign * np.where(inside, squared_hinge(sign * (block.dot(vector, weights[i, :-1]) + weights[i, -1]))[1], 0.0)
            total[i, size + 1 : 2 * size + 1] += block.transposed(vector, slope, size)
            total[i, 2 * size + 1] += slope.sum()
            if (place[block.shard] + (fold or 0) + climb.round) % turns:
                continue
            curve = (0.5 + shards / climb.penalty * (np.bincount(block.row, values * values, block.n) + climb.intercept)).tolist()
            w, b, share = weights[i, :-1].copy(), float(weights[i, -1]), shards / climb.penalty
            before = duals[i, low : low + block.n]
            dual = before.tolist()
            for order in orders:
                for at in order[inside[order]].tolist():
                    own, x = slots[begins[at] : ends[at]], values[begins[at] : ends[at]]
                    new = max(0.0, dual[at] + (1.0 - dual[at] / 2 - signs[at] * (w[own] @ x + b)) / curve[at])
                    if new != dual[at]:
                        change = share * signs[at] * (new - dual[at])
                        dual[at] = new
                        w[own] += change * x
                        if climb.intercept:
                            b += change
            total[i, :size] += (w - weights[i, :-1]) / shards
            total[i, size] += (b - weights[i, -1]) / shards
            total[i, 2 * (size + 1) + low : 2 * (size + 1) + low + block.n] = np.array(dual) - before
    return total


def ascend(data: Sums, penalty: float, intercept: bool, tolerance: float, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Weights by dual ascent on the squared hinge plus penalty / 2 times the squared weights, the intercept's too, and the norms of the gradient at zero.

    A fold is done when its gradient is below `tolerance` times that at zero, or after so many rounds; then the weights with the least gradient
    are returned, and what they lack is left to `minimise`.
    """
    count, d, rows = len(data.problem.folds), data.problem.size + 1, data.rows()
    ends = np.cumsum([rows[shard] for shard in sorted(rows)])
    begins = {shard: int(end) - rows[shard] for shard, end in zip(sorted(rows), ends)}
    free = np.ones(d)
    free[-1] = float(intercept)
    w, duals, start, going = np.zeros((count, d)), np.zeros((count, int(ends[-1]) if len(ends) else 0)), np.zeros(count), np.ones(count, bool)
    best, least = w, np.full(count, np.inf)
    for number in range(_ROUNDS):
        data.count += 1
        found = data.round(w, duals, Climb(number, penalty, intercept, seed, tuple(going.tolist()), begins))
        gradient = (found[:, d : 2 * d] + penalty * w) * free
        norms = np.sqrt((gradient * gradient).sum(axis=1))
        if number == 0:
            start = norms
        better = going & (norms < least)
        best, least = np.where(better[:, None], w, best), np.where(better, norms, least)
        going &= norms > tolerance * start
        if not going.any():
            break
        w = w + np.where(going[:, None], found[:, :d], 0.0)
        duals = np.maximum(duals + np.where(going[:, None], found[:, 2 * d :], 0.0), 0.0)
    return best, start


@dataclass(frozen=True)
class Course:
    """The steps of an epoch: the clock at the start of all, and the rows of each fold."""

    epoch: int
    first: float
    alpha: float
    seed: int
    intercept: bool
    rows: tuple[int, ...]
    shards: int


def epoch_sums(blocks: Iterable[Block], problem: Problem, weights: np.ndarray, averaged: np.ndarray, course: Course) -> np.ndarray:
    """Each shard goes once through its rows, from the common weights, with the step sizes of the common clock.

    Per fold: what the steps of rows add to the weights at the end, in parts by rows, and to the sum of the weights over the steps; by how much both
    hold the weights of the start; the loss at `averaged`, which the epoch before left. Slots without a step stay zero.
    """
    size = problem.size
    total = np.zeros((len(problem.folds), 2 * (size + 1) + 3))
    for block in blocks:
        signs = 2 * block.label - 1
        order = np.random.default_rng((course.seed, course.epoch, block.shard)).permutation(block.n)
        begins = block.ends - np.diff(block.ends, prepend=0)
        for i, (fold, vector) in enumerate(zip(problem.folds, problem.vectors)):
            values, count = block.values[vector], max(course.rows[i], 1)
            lengths = block.squares(vector) + _FREE * course.intercept
            w, b, scale = weights[i, :-1].copy(), weights[i, -1], 1.0
            # The sum over the steps as a sum of changes: a step touches only the slots of its row.
            mean, mean_b, clock, passed = np.zeros(size), 0.0, course.first + course.epoch * count / course.shards, 0.0
            own = order if fold is None else order[block.fold[order] != fold]
            for at in own.tolist():
                low, high = begins[at], block.ends[at]
                slots, x, sign = block.slots[low:high], values[low:high], 2.0 * block.label[at] - 1.0
                eta = 1.0 / (course.alpha * clock)
                gap = 1.0 - sign * (scale * (w[slots] @ x) + b)
                scale *= 1.0 - eta * course.alpha
                if gap > 0 and lengths[at] > 0:
                    step = min(eta, gap / lengths[at]) * sign  # no further than to where the loss ends
                    change = step / scale * x
                    w[slots] += change
                    mean[slots] -= change * passed
                    if course.intercept:
                        b += step * _FREE
                passed += scale
                mean_b += b
                clock += 1
            w -= weights[i, :-1]
            part = len(own) / count
            total[i, :size] += part * scale * w
            total[i, size] += part * b
            total[i, size + 1 : 2 * size + 1] += (mean + w * passed) / count
            total[i, 2 * size + 1] += mean_b / count
            inside = np.ones(block.n, bool) if fold is None else block.fold != fold
            loss = hinge(signs * (block.dot(vector, averaged[i, :-1]) + averaged[i, -1]))[0]
            total[i, -3:] += part * scale, passed / count, loss[inside].sum()
    return total


def descend(data: Sums, shards: int, alpha: float, intercept: bool, tolerance: float, iterations: int, seed: int = 42, patience: int = 5) -> Found:
    """Stochastic descent on the mean hinge plus alpha / 2 times the squared weights; the intercept is free.

    Steps are 1 / (alpha (t0 + t)), cut where a row's loss ends, so that long texts do not throw the weights far off. After an epoch the
    weights are the mean over the shards by their rows. The result is a mean over all steps, later epochs weighing more. It
    ends if the mean objective of no fold has improved by `tolerance` in `patience` epochs.
    """
    count, size = len(data.problem.folds), data.problem.size
    first = 1.0 / (alpha * np.sqrt(1.0 / np.sqrt(alpha)))  # the first step is about the size of a typical weight
    w = np.zeros((count, size + 1))
    averaged = w.copy()
    _, _, loss, rows = data.at(w)
    objective = lambda weights, loss: loss / np.maximum(rows, 1) + alpha / 2 * (weights[:, :-1] ** 2).sum(axis=1)
    best, best_at, found = objective(w, loss), np.zeros(count, int), w.copy()
    going = np.ones(count, bool)

    def judge(epoch: int, loss: np.ndarray) -> bool:
        """Take the mean that `epoch` left if it is better; whether any fold goes on."""
        nonlocal best, best_at, going
        value = objective(averaged, loss)
        better = going & (value < best)  # a fold that is done stays as it is, as it would alone
        found[better] = averaged[better]
        best_at = np.where(going & (value < best * (1 - tolerance)), epoch, best_at)
        best = np.where(better, value, best)
        going &= epoch - best_at < patience
        return bool(going.any())

    for epoch in range(iterations):
        data.count += 1
        both = data.epoch(w, averaged, Course(epoch, first, alpha, seed, intercept, tuple(int(r) for r in rows), shards))
        # The loss of the mean comes with the next epoch, so that an epoch is one pass; the last one's steps are not used.
        if epoch and not judge(epoch - 1, both[:, -1]):
            break
        held = w.copy()
        held[:, -1] = 0.0  # the intercept is whole in the sums
        w = both[:, : size + 1] + both[:, -3:-2] * held
        share = (_LATER + 1) / (epoch + 1 + _LATER)
        averaged = (1 - share) * averaged + share * (both[:, size + 1 : 2 * (size + 1)] + both[:, -2:-1] * held)
    else:
        if iterations > 0:
            judge(iterations - 1, data.at(averaged)[2])
    return Found(found, np.zeros(count), np.zeros(count), best, data.count)


def margins(shards: Shards, weights: np.ndarray) -> DataFrame:
    """`(index, fold, label, margin)` of the rows that each fold's weights have not seen; all rows for the fold None."""
    folds, vectors = shards.folds, shards.vectors
    sent = shards.table.sparkSession.sparkContext.broadcast(weights)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            for i, (fold, vector) in enumerate(zip(folds, vectors)):
                at = np.arange(block.n) if fold is None else np.flatnonzero(block.fold == fold)
                margin = block.dot(vector, sent.value[i, :-1])[at] + sent.value[i, -1]
                yield pa.RecordBatch.from_arrays([pa.array(block.index[at]), pa.array(block.fold[at]), pa.array(block.label[at].astype(np.int32)), pa.array(margin)], ["index", "fold", "label", "margin"])

    return shards.table.mapInArrow(apply, "index bigint, fold int, label int, margin double")
