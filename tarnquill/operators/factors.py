"""Nonnegative factorisation, weighted PCA and clusters.

The topic matrix has topics x vocabulary entries: a bounded model that lives on the driver and goes to every task; the
documents never leave the executors. ``fit_online`` keeps a matrix of more than ``MOST_HELD`` cells as a table of its
columns instead (``SpreadModel``). Each pass solves every document's weights on its own (multiplicative steps from the
document's mean until they settle, so the result doesn't depend on how rows are batched), sums partial products inside
the task, and adds the partials by blocks of columns in a tree. ``fit`` updates the topics after each whole pass,
``fit_online`` after each mini-batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnquill.functions.assignment import least_cost
from tarnquill.operators.integrity import ContractError
from tarnquill.operators.vectors import adjusted_rand
from tarnquill.session import drop_folder, kept_folder

EPS = float(np.finfo(np.float32).eps)
MOST_CELLS = 32_000_000
#: Cells of a topic matrix that the driver and every task hold in a mini-batch fit; larger ones are spread.
MOST_HELD = 4_000_000
#: Rows that are solved together: a few of their weights' arrays fit a core's cache.
SOLVED_ROWS = 512
#: Epochs after which a fit ends that hasn't settled.
MOST_EPOCHS = 60


def sparse_rows(weights: DataFrame, index: DataFrame) -> DataFrame:
    """(row_id, cols, vals) from (row_id, keyword_id, weight) and (keyword_id, col)."""
    cells = weights.join(index, "keyword_id")
    return cells.groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("col", "weight"))).alias("c")).select(
        "row_id", F.transform("c", lambda x: x["col"].cast("int")).alias("cols"), F.transform("c", lambda x: x["weight"]).alias("vals")
    )


def solve(cols: np.ndarray, vals: np.ndarray, h: np.ndarray, gram: np.ndarray, steps: int) -> np.ndarray:
    """Weights of one row by multiplicative updates with h fixed."""
    numerator = h[:, cols] @ vals
    w = np.full(len(h), np.sqrt(max(vals.sum(), 0.0) / h.shape[1] / len(h)))
    for _ in range(steps):
        denominator = gram @ w
        denominator[denominator == 0] = EPS
        w = w * numerator / denominator
    return w


def solve_rows(
    part: pd.DataFrame, h: np.ndarray, gram: np.ndarray, steps: int, tolerance: float = 0.0, n_terms: int | None = None
) -> Iterator[tuple[np.ndarray, ...]]:
    """``solve`` for pieces of a batch: (weights, numerators, row of each cell, its column, its value). A row whose weights
    change by no more than ``tolerance`` of their length is done; rows don't wait for each other, so the result of a row
    doesn't depend on its batch. ``n_terms``: where h has only some of the columns, how many there are."""
    turned = np.ascontiguousarray(h.T)
    n_terms = h.shape[1] if n_terms is None else n_terms
    for at in range(0, len(part), SOLVED_ROWS):
        cols, vals = ([np.asarray(x, kind) for x in part[name].iloc[at : at + SOLVED_ROWS]] for name, kind in (("cols", int), ("vals", h.dtype)))
        sizes = np.array([len(c) for c in cols])
        row = np.repeat(np.arange(len(cols)), sizes)
        col, val = np.concatenate(cols), np.concatenate(vals)
        numerator = np.zeros((len(cols), len(h)), h.dtype)
        some = sizes > 0
        if len(col):
            starts = (np.cumsum(sizes) - sizes)[some]
            numerator[some] = np.add.reduceat(turned[col] * val[:, None], starts, axis=0)
        mass = np.maximum(np.bincount(row, val, len(cols)), 0.0)
        w = np.repeat(np.sqrt(mass / n_terms / len(h))[:, None], len(h), axis=1).astype(h.dtype)
        # in place: the products are the work, and copies of the weights would cost as much again
        open_, now, above, below = np.arange(len(cols)), w.copy(), numerator, np.empty(w.shape, np.result_type(w, gram))
        for step in range(steps):
            before = now.copy() if tolerance and step % 5 == 4 else None
            np.matmul(now, gram, out=below)
            if not below.all():
                below[below == 0] = EPS
            now *= above
            now /= below
            if before is not None:
                moved = np.linalg.norm(np.subtract(now, before, out=before), axis=1) > tolerance * np.linalg.norm(now, axis=1)
                if not moved.all():
                    w[open_] = now
                    open_, now, above, below = open_[moved], now[moved], above[moved], below[: moved.sum()]
                    if not len(open_):
                        break
        w[open_] = now
        yield w, numerator, row, col, val


#: Columns of the topic matrix that make one block of partial sums.
BLOCK_COLUMNS = 2048
_SUMS = "block int, branch int, cols array<int>, part binary"


def _add_piece(wx: np.ndarray, w: np.ndarray, row: np.ndarray, slot: np.ndarray, val: np.ndarray) -> None:
    """Adds a piece's X'W to the rows of wx that its cells belong to."""
    if len(slot):
        order = np.argsort(slot, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(slot[order]) > 0])
        wx[slot[order][starts]] += np.add.reduceat(w[row[order]] * val[order][:, None], starts, axis=0)


def _pass_sums(rows: DataFrame, h: np.ndarray, steps: int, tolerance: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(W'X as topics x terms, W'W, [square, cross, fitted], rows) of one pass with h fixed.

    A task sums its rows sparsely: it sends, for each block of columns, only columns that its rows have. The blocks are
    added in a tree: first over branches of about the root of the number of tasks, then over those. They are added in 64
    bits and sent in those of h.
    """
    shared = rows.sparkSession.sparkContext.broadcast(h)
    branches, topics, kind = max(1, int(np.sqrt(rows.rdd.getNumPartitions()))), len(h), h.dtype

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        h = shared.value
        gram = h @ h.T
        slots, wx, ww = np.full(h.shape[1], -1), np.zeros((0, topics)), np.zeros((topics, topics))
        used, totals = 0, np.zeros(4)
        for part in parts:
            for w, numerator, row, col, val in solve_rows(part, h, gram, steps, tolerance):
                fresh = np.unique(col[slots[col] < 0])
                slots[fresh] = used + np.arange(len(fresh))
                used += len(fresh)
                if used > len(wx):
                    wx = np.concatenate([wx, np.zeros((max(used, 2 * len(wx)) - len(wx), topics))])
                _add_piece(wx, w, row, slots[col], val)
                ww += w.T @ w
                totals += [float(val @ val), float((w * numerator).sum()), float(((w @ gram) * w).sum()), len(w)]
        branch = TaskContext.get().partitionId() % branches
        yield pd.DataFrame({"block": [-1], "branch": [branch], "cols": [[]], "part": [np.r_[totals, ww.ravel()].tobytes()]})
        have = np.flatnonzero(slots >= 0)
        for block in np.unique(have // BLOCK_COLUMNS):
            cols = have[have // BLOCK_COLUMNS == block]
            yield pd.DataFrame({"block": [block], "branch": [branch], "cols": [cols.tolist()], "part": [wx[slots[cols]].astype(h.dtype).tobytes()]})

    def add(part: pd.DataFrame) -> pd.DataFrame:
        block, branch = int(part["block"].iloc[0]), int(part["branch"].iloc[0])
        values = [np.frombuffer(x, float if block < 0 else kind) for x in part["part"]]
        if block < 0:
            cols, total = [], np.sum(values, axis=0)
        else:
            each = [np.asarray(c, int) for c in part["cols"]]
            cols = np.unique(np.concatenate(each))
            total = np.zeros((len(cols), topics))
            for c, v in zip(each, values):
                total[np.searchsorted(cols, c)] += v.reshape(len(c), -1)
            cols, total = cols.tolist(), total.astype(kind)
        return pd.DataFrame({"block": [block], "branch": [branch], "cols": [cols], "part": [total.tobytes()]})

    sums = rows.select("cols", "vals").mapInPandas(run, _SUMS)
    if branches > 4:
        sums = sums.groupBy("block", "branch").applyInPandas(add, _SUMS)
    found = sums.groupBy("block").applyInPandas(add, _SUMS).collect()  # the model's size, bounded by MOST_CELLS
    shared.destroy()
    wx = np.zeros((h.shape[1], topics), kind)
    for r in found:
        if r.block < 0:
            head = np.frombuffer(r.part)
        else:
            wx[r.cols] = np.frombuffer(r.part, kind).reshape(len(r.cols), -1)
    return wx.T, head[4:].reshape(topics, topics), head[:3], int(head[3])


def _error(square: float, cross: float, fitted: float) -> float:
    return float(np.sqrt(max(square - 2 * cross + fitted, 0.0) / max(square, 1e-30)))


#: Steps of the passes that measure a model.
MEASURE_STEPS = 200
_TOTALS = "square double, cross double, fitted double"


def _totals(solved: Iterator[tuple[np.ndarray, ...]], gram: np.ndarray) -> pd.DataFrame:
    """The sums of ``_error`` over solved rows."""
    totals = np.zeros(3)
    for w, numerator, _, _, val in solved:
        totals += [(val * val).sum(dtype=float), (w * numerator).sum(dtype=float), ((w @ gram) * w).sum(dtype=float)]
    return pd.DataFrame([totals], columns=["square", "cross", "fitted"])


def _summed(totals: DataFrame) -> np.ndarray:
    return np.array([x or 0.0 for x in totals.groupBy().sum().first()])


def _measured(rows: DataFrame, h: np.ndarray, tolerance: float) -> np.ndarray:
    """[square, cross, fitted] over all rows with h fixed."""
    shared = rows.sparkSession.sparkContext.broadcast(h)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        h = shared.value
        gram = h @ h.T
        for part in parts:
            yield _totals(solve_rows(part, h, gram, MEASURE_STEPS, tolerance), gram)

    found = _summed(rows.select("cols", "vals").mapInPandas(run, _TOTALS))
    shared.destroy()
    return found


def _start(topics: int, n_terms: int, seed: int) -> np.ndarray:
    if n_terms * topics > MOST_CELLS:
        raise ValueError("the topic matrix is too large for the driver")
    return np.random.default_rng(seed).random((topics, n_terms)) / np.sqrt(topics)


def fit(
    rows: DataFrame, n_terms: int, topics: int, epochs: int = 5, steps: int = 30, seed: int = 17, inner: int = 1, settle: float | None = None,
    tolerance: float = 1e-4,
) -> tuple[np.ndarray, list[float]]:
    """(h, relative error before each update). Each epoch makes ``inner`` updates of h from the sums of one pass. With
    ``settle``, epochs go on until the error falls by no more than this share of it, and the last error is that of h."""
    h, errors = _start(topics, n_terms, seed), []
    for epoch in range(epochs if settle is None else MOST_EPOCHS):
        a, b, sums, _ = _pass_sums(rows, h, steps, tolerance)
        errors.append(_error(*sums))
        if settle is not None and epoch + 1 >= max(epochs, 2) and errors[-2] - errors[-1] <= settle * errors[-2]:
            break
        for _ in range(inner):
            h = h * a / np.maximum(b @ h, EPS)
    return h, errors


BATCH_ROWS, MOST_BATCHES = 4096, 8


class OnlineFit(NamedTuple):
    h: np.ndarray | SpreadModel
    errors: list[float]
    visits: int


#: Of a spread model: columns of a block, and cells of the rows that one group has at most, about, whatever their number.
SPREAD_COLUMNS, GROUP_CELLS = 512, 1 << 17
_MODEL = "block int, col int, h binary, b binary"
#: Branches in which sums of topics squared are added before the driver gets them, where there are many.
BRANCHES = 16


class SpreadModel(NamedTuple):
    """A topic matrix too large for the driver: ``columns`` has (block, col, h, b), h and b as 32-bit numbers by topic; the
    driver has ``gram``, the products of its rows, which is as large as the number of topics squared."""

    columns: DataFrame
    n_terms: int
    topics: int
    gram: np.ndarray

    def read(self, cols: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of some columns, the columns as topics x columns)."""
        found = self.columns.join(cols, "col").select("col", "h").orderBy("col").toPandas()
        return found["col"].to_numpy(), _stacked(found["h"], self.topics).T.astype(float)


def _stacked(parts: pd.Series, topics: int) -> np.ndarray:
    return np.frombuffer(b"".join(parts), np.float32).reshape(-1, topics)


def _texts(values: np.ndarray) -> list[bytes]:
    return [x.tobytes() for x in values.astype(np.float32)]


def _write(df: DataFrame, name: str, *by: str) -> tuple[DataFrame, str]:
    path = kept_folder(df.sparkSession, name)
    df.write.partitionBy(*by).option("compression", "none").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _in_tree(sums: DataFrame, n: int) -> np.ndarray:
    """The sum of ``n`` rows (branch, part): where they aren't few, first of each branch, then over the branches."""

    def add(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"branch": part["branch"].iloc[:1], "part": [np.sum([np.frombuffer(x) for x in part["part"]], axis=0).tobytes()]})

    if n > 2 * BRANCHES:
        sums = sums.groupBy("branch").applyInPandas(add, "branch int, part binary")
    return np.sum([np.frombuffer(r.part) for r in sums.collect()], axis=0)


def _gram(columns: DataFrame, topics: int) -> np.ndarray:
    tasks = columns.rdd.getNumPartitions()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        gram = np.zeros((topics, topics))
        for part in parts:
            h = _stacked(part["h"], topics).astype(float)
            gram += h.T @ h
        yield pd.DataFrame({"branch": [TaskContext.get().partitionId() % BRANCHES], "part": [gram.tobytes()]})

    return _in_tree(columns.select("h").mapInPandas(run, "branch int, part binary"), tasks).reshape(topics, topics)


def _spread_start(spark, topics: int, n_terms: int, seed: int) -> tuple[SpreadModel, str]:
    """The columns of ``_start``, each block from its places in the generator's sequence."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.random.default_rng(seed).bit_generator
        first = bits.state
        for block in (int(x) for part in parts for x in part["id"]):
            cols = np.arange(block * SPREAD_COLUMNS, min((block + 1) * SPREAD_COLUMNS, n_terms))
            h = np.zeros((topics, len(cols)))
            for topic in range(topics):
                bits.state = first
                bits.advance(topic * n_terms + int(cols[0]))
                h[topic] = np.random.Generator(bits).random(len(cols))
            yield pd.DataFrame({"block": np.full(len(cols), block), "col": cols, "h": _texts(h.T / np.sqrt(topics)), "b": _texts(np.zeros(h.T.shape))})

    blocks = -(-n_terms // SPREAD_COLUMNS)
    tasks = min(blocks, max(spark.sparkContext.defaultParallelism, blocks // 8))
    columns, path = _write(spark.range(0, blocks, 1, tasks).mapInPandas(run, _MODEL), "model")
    return SpreadModel(columns, n_terms, topics, _gram(columns, topics)), path


def _groups(rows: DataFrame, cells: int) -> int:
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return cores * max(1, -(-cells // (GROUP_CELLS * cores)))


def _grouped(rows: DataFrame, groups: int) -> DataFrame:
    """Adds ``part``, the group of a row: a whole number of groups for each core. Their keys are chosen so that each has
    an exchange's partition of its own, as far as there are as many."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.col("id").cast("int")
    spots: dict[int, list[int]] = {}
    for r in spark.range(16 * (n + groups)).select(key.alias("id"), F.pmod(F.hash(key), F.lit(n)).alias("spot")).collect():
        spots.setdefault(r.spot, []).append(r.id)
    dealt = [i for turn in range(max(map(len, spots.values()))) for i in (ids[turn] for ids in spots.values() if turn < len(ids))]
    place = F.pmod(F.xxhash64("row_id", F.lit("group")), F.lit(groups)).cast("int")
    return rows.withColumn("part", F.element_at(F.array(*map(F.lit, dealt[:groups])), place + 1))


def _cells(rows: DataFrame) -> int:
    return rows.agg(F.sum(F.size("cols"))).first()[0] or 0


def _needs(rows: DataFrame, *by: str) -> DataFrame:
    """The columns that the rows of each group have."""
    return rows.select(*by, F.explode("cols").alias("col")).distinct()


def _met(rows: DataFrame, needs: DataFrame, model: SpreadModel):
    """The rows of each group with the columns of the model that they have."""
    columns = needs.join(model.columns.select("col", "h"), "col").select("part", "col", "h")
    return rows.groupBy("part").cogroup(columns.groupBy("part"))


def _local(rows: pd.DataFrame, columns: pd.DataFrame, topics: int) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """(rows with the places of their columns, the columns' numbers, h of these columns)."""
    columns = columns.sort_values("col")
    have, h = columns["col"].to_numpy(), _stacked(columns["h"], topics).T
    return _placed(rows, have), have, h


def _placed(rows: pd.DataFrame, have: np.ndarray) -> pd.DataFrame:
    sizes = rows["cols"].map(len).to_numpy()
    flat = np.concatenate([np.asarray(c, int) for c in rows["cols"]])
    place = np.searchsorted(have, flat)
    if len(flat) and (place.max() >= len(have) or (have[place] != flat).any()):
        raise ContractError("rows have columns that the model lacks")
    return rows.assign(cols=np.split(place, np.cumsum(sizes)[:-1]))


def _spread_sums(rows: DataFrame, needs: DataFrame, groups: int, model: SpreadModel, steps: int, tolerance: float) -> tuple[DataFrame, str, np.ndarray, int]:
    """(table of (block, col, branch, part), the parts of X'W by column, its folder, W'W, rows) of one pass."""
    n_terms, topics, shared = model.n_terms, model.topics, rows.sparkSession.sparkContext.broadcast(model.gram.astype(np.float32))

    def run(rows: pd.DataFrame, columns: pd.DataFrame) -> pd.DataFrame:
        part, have, h = _local(rows, columns, topics)
        wx, head = np.zeros((len(have), topics)), np.zeros(1 + topics * topics)
        for w, _, row, col, val in solve_rows(part, h, shared.value, steps, tolerance, n_terms):
            _add_piece(wx, w, row, col, val)
            head += np.r_[len(w), (w.T @ w).ravel()]
        return pd.DataFrame({
            "block": np.r_[-1, have // SPREAD_COLUMNS], "col": np.r_[-1, have], "branch": int(rows["part"].iloc[0]) % BRANCHES, "part": [head.tobytes(), *_texts(wx)],
        })

    sums, path = _write(_met(rows, needs, model).applyInPandas(run, "block int, col int, branch int, part binary"), "sums")
    head = _in_tree(sums.where("col < 0").select("branch", "part"), groups)
    shared.destroy()
    return sums.where("col >= 0"), path, head[1:].reshape(topics, topics), int(head[0])


def _spread_measured(rows: DataFrame, needs: DataFrame, model: SpreadModel, tolerance: float) -> np.ndarray:
    """``_measured`` with a spread model."""
    n_terms, topics, shared = model.n_terms, model.topics, rows.sparkSession.sparkContext.broadcast(model.gram.astype(np.float32))

    def run(rows: pd.DataFrame, columns: pd.DataFrame) -> pd.DataFrame:
        part, _, h = _local(rows, columns, topics)
        return _totals(solve_rows(part, h, shared.value, MEASURE_STEPS, tolerance, n_terms), shared.value)

    found = _summed(_met(rows, needs, model).applyInPandas(run, _TOTALS))
    shared.destroy()
    return found


def _spread_step(model: SpreadModel, sums: DataFrame, ww: np.ndarray, forget: float, first: bool) -> tuple[SpreadModel, str]:
    """The model after a batch. Of the running sums A and B only B is kept, since A = h x B but for the first batch."""
    topics, shared = model.topics, sums.sparkSession.sparkContext.broadcast(ww)

    def run(columns: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
        columns = columns.sort_values("col")
        h, b = (_stacked(columns[name], topics).astype(float) for name in ("h", "b"))
        wx, at = np.zeros(h.shape), np.searchsorted(columns["col"].to_numpy(), sums["col"].to_numpy())
        for i, x in zip(at, sums["part"]):
            wx[i] += np.frombuffer(x, np.float32)
        a = (0 if first else forget * h * np.maximum(b, EPS)) + h * wx
        b = forget * b + h @ shared.value
        return columns.assign(h=_texts(a / np.maximum(b, EPS)), b=_texts(b))

    parts = model.columns.groupBy("block").cogroup(sums.select("block", "col", "part").groupBy("block"))
    columns, path = _write(parts.applyInPandas(run, _MODEL), "model")
    shared.destroy()
    return SpreadModel(columns, model.n_terms, topics, _gram(columns, topics)), path


def _fit_spread(
    kept: DataFrame, n_terms: int, topics: int, epochs: int, batches: int, steps: int, seed: int, forget: float, tolerance: float, measured: bool,
) -> OnlineFit:
    """``fit_online`` with a spread model: rows meet the columns they have in groups, and each block of columns is updated
    by a task of its own. Tables that have been replaced are deleted."""
    spark = kept.sparkSession
    groups = _groups(kept, -(-_cells(kept) // batches))
    rows, rows_path = _write(_grouped(kept, groups), "groups", "batch")
    needs, needs_path = _write(_needs(rows, "batch", "part"), "needs", "batch")
    (model, path), visits, errors = _spread_start(spark, topics, n_terms, seed), 0, []
    for epoch in range(epochs):
        for batch in np.random.default_rng([seed, epoch]).permutation(batches):
            here = F.col("batch") == int(batch)
            sums, sums_path, ww, n = _spread_sums(rows.where(here).select("part", "cols", "vals"), needs.where(here).select("part", "col"), groups, model, steps, tolerance)
            if n:
                old, (model, path) = path, _spread_step(model, sums, ww, forget, not visits)
                drop_folder(spark, old)
            drop_folder(spark, sums_path)
            spark.sparkContext._jvm.System.gc()  # else the exchanges' files stay until the driver happens to collect its garbage
            visits += n
        if measured:
            found = np.zeros(3)
            for batch in range(batches):  # one at a time, else the columns for all groups are on disk at once
                here = F.col("batch") == batch
                found += _spread_measured(rows.where(here).select("part", "cols", "vals"), needs.where(here).select("part", "col"), model, tolerance)
                spark.sparkContext._jvm.System.gc()
            errors.append(_error(*found))
    drop_folder(spark, rows_path)
    drop_folder(spark, needs_path)
    return OnlineFit(model, errors, visits)


def fit_online(
    rows: DataFrame, n_terms: int, topics: int, epochs: int = 5, batches: int | None = None, steps: int = 30, seed: int = 17, forget: float = 1.0,
    tolerance: float = 1e-4, measured: bool = True,
) -> OnlineFit:
    """A fit in mini-batches: every row is in one of ``batches`` batches (where not stated, of ``BATCH_ROWS`` rows at least and
    ``MOST_BATCHES`` at most) and is visited once an epoch, the batches in an order of their own each epoch. After a batch the running sums A and B, the older ones weighted by ``forget``, give h = A / B.

    ``errors`` has the relative error over all rows after each epoch, by a pass of its own; they only measure, and are left
    out where not ``measured``.
    The visits are counted in the tasks and have to be the epochs times the rows. Beyond ``MOST_HELD`` cells h is spread.
    """
    spark = rows.sparkSession
    total = rows.count()
    batches = min(MOST_BATCHES, max(1, -(-total // BATCH_ROWS))) if batches is None else batches
    path = kept_folder(spark, "batches")
    spread = rows.select("row_id", F.col("cols").cast("array<int>"), F.col("vals").cast("array<double>")).repartition(max(spark.sparkContext.defaultParallelism, rows.rdd.getNumPartitions()))
    spread.withColumn("batch", F.pmod(F.xxhash64("row_id"), F.lit(batches)).cast("int")).write.partitionBy("batch").parquet(path)
    kept = spark.read.schema("row_id bigint, cols array<int>, vals array<double>, batch int").parquet(path)
    if n_terms * topics > MOST_HELD:
        found = _fit_spread(kept, n_terms, topics, epochs, batches, steps, seed, forget, tolerance, measured)
        drop_folder(spark, path)
        return _checked(found, epochs, total)
    h, visits, errors = _start(topics, n_terms, seed), 0, []
    a, b = np.zeros_like(h), np.zeros_like(h)
    for epoch in range(epochs):
        for batch in np.random.default_rng([seed, epoch]).permutation(batches):
            wx, ww, _, n = _pass_sums(kept.where(F.col("batch") == int(batch)), h.astype(np.float32), steps, tolerance)
            visits += n
            if n:
                a *= forget
                a += h * wx
                b *= forget
                b += ww @ h
                np.divide(a, np.maximum(b, EPS, out=h), out=h)
        if measured:
            errors.append(_error(*_measured(kept, h.astype(np.float32), tolerance)))
    return _checked(OnlineFit(h, errors, visits), epochs, total)


def _checked(found: OnlineFit, epochs: int, total: int) -> OnlineFit:
    if found.visits != epochs * total:
        raise ContractError(f"{found.visits} visits of {epochs} x {total} rows")
    return found


def infer(rows: DataFrame, h: np.ndarray, steps: int = 60) -> DataFrame:
    """(row_id, topic_id, contribution): weights times the length of the topic's row, so scaling of factors cancels."""
    shared = rows.sparkSession.sparkContext.broadcast(h)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        h = shared.value
        gram, length = h @ h.T, np.linalg.norm(h, axis=1)
        for part in parts:
            found = [(w * length).ravel() for w, *_ in solve_rows(part, h, gram, steps)]
            yield pd.DataFrame({
                "row_id": np.repeat(part["row_id"].to_numpy(), len(h)), "topic_id": np.tile(np.arange(len(h), dtype=np.int32), len(part)),
                "contribution": np.concatenate(found) if found else np.array([]),
            })

    return rows.mapInPandas(run, "row_id bigint, topic_id int, contribution double")


def infer_hard(rows: DataFrame, h: np.ndarray | SpreadModel, steps: int = 200, tolerance: float = 1e-4) -> DataFrame:
    """(row_id, topic_id, top1, margin): the topic of the greatest contribution, its share of the row's and the distance to
    the second, found in the pass itself; -1 without mass, ties to the lower topic."""
    schema = "row_id bigint, topic_id int, top1 double, margin double"
    if isinstance(h, SpreadModel):
        return _infer_spread(rows, h, steps, tolerance, schema)
    shared = rows.sparkSession.sparkContext.broadcast(h.astype(np.float32))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        h = shared.value
        gram, length = h @ h.T, np.linalg.norm(h.astype(float), axis=1)
        for part in parts:
            yield from _hardest(part, length, solve_rows(part, h, gram, steps, tolerance))

    return rows.mapInPandas(run, schema)


def _infer_spread(rows: DataFrame, model: SpreadModel, steps: int, tolerance: float, schema: str) -> DataFrame:
    n_terms, topics, shared = model.n_terms, model.topics, rows.sparkSession.sparkContext.broadcast(model.gram)
    rows, _ = _write(_grouped(rows.select("row_id", "cols", "vals"), _groups(rows, _cells(rows))), "groups")
    needs, _ = _write(_needs(rows, "part"), "needs")

    def run(rows: pd.DataFrame, columns: pd.DataFrame) -> pd.DataFrame:
        part, _, h = _local(rows, columns, topics)
        gram, length = shared.value.astype(np.float32), np.sqrt(np.diag(shared.value))
        return pd.concat(_hardest(part, length, solve_rows(part, h, gram, steps, tolerance, n_terms)))

    return _met(rows, needs, model).applyInPandas(run, schema)


def _hardest(part: pd.DataFrame, length: np.ndarray, solved: Iterator[tuple[np.ndarray, ...]]) -> Iterator[pd.DataFrame]:
    at = 0
    for w, *_ in solved:
        mass = (w * length).sum(axis=1)
        some = mass > 1e-12
        p = np.round(w * length / np.maximum(mass, 1e-12)[:, None], 9)
        best = p.argmax(axis=1)
        top = p[np.arange(len(p)), best]
        p[np.arange(len(p)), best] = 0.0
        yield pd.DataFrame({
            "row_id": part["row_id"].iloc[at : at + len(w)].to_numpy(), "topic_id": np.where(some, best, -1).astype(np.int32),
            "top1": np.where(some, top, 0.0), "margin": np.where(some, top - p.max(axis=1), 0.0),
        })
        at += len(w)


def matched_components(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, float]]:
    """Pairs of topics of two models with the greatest total cosine."""
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
    cosine = unit(a) @ unit(b).T
    return [(i, j, float(cosine[i, j])) for i, j in enumerate(least_cost((1 - cosine).tolist()))]


def stability(rows: DataFrame, base: np.ndarray, other: np.ndarray) -> DataFrame:
    """(matched_topics, cosine_mean, cosine_p10, ari): topics of two models matched, and the agreement of the rows' labels
    where both models give one."""
    pairs = matched_components(base, other)
    cosines = np.array([c for _, _, c in pairs])
    mapped = F.create_map(*(F.lit(x) for i, j, _ in pairs for x in (j, i)))
    left = infer_hard(rows, base).where("topic_id >= 0").select("row_id", F.col("topic_id").alias("a"))
    right = infer_hard(rows, other).where("topic_id >= 0").select("row_id", mapped[F.col("topic_id")].alias("b")).where("b IS NOT NULL")
    agreed = adjusted_rand(left.join(right, "row_id"), "a", "b")
    return agreed.select(
        F.lit(len(pairs)).alias("matched_topics"), F.lit(float(cosines.mean())).alias("cosine_mean"),
        F.lit(float(np.quantile(cosines, 0.1))).alias("cosine_p10"), "ari",
    )


def near_duplicates(h: np.ndarray, least: float = 0.95) -> list[tuple[int, int, float]]:
    """Topic pairs of one model whose rows point the same way."""
    unit = h / np.maximum(np.linalg.norm(h, axis=1, keepdims=True), 1e-12)
    cosine = np.triu(unit @ unit.T, 1)
    return [(int(i), int(j), float(cosine[i, j])) for i, j in np.argwhere(cosine >= least)]


def weighted_pca(vectors: DataFrame, components: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(mean, components) of (embedding, weight) rows from one pass of summed moments."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, s, q = 0.0, None, None
        for part in parts:
            if part.empty:
                continue
            x, w = np.array(part["embedding"].tolist(), float), part["weight"].to_numpy(float)
            s = (0 if s is None else s) + w @ x
            q = (0 if q is None else q) + (x * w[:, None]).T @ x
            n += w.sum()
        if s is not None:
            yield pd.DataFrame({"n": [n], "s": [s.tolist()], "q": [q.ravel().tolist()]})

    sums = vectors.select("embedding", "weight").mapInPandas(run, "n double, s array<double>, q array<double>")
    long = sums.select("n", F.posexplode(F.concat("s", "q")).alias("i", "x"))
    rows = long.groupBy("i").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).orderBy("i").collect()  # dimensions squared
    n, x = rows[0].n, np.array([r.x for r in rows])
    d = int((np.sqrt(1 + 4 * len(x)) - 1) / 2)
    mean = x[:d] / n
    values, axes = np.linalg.eigh(x[d:].reshape(d, d) / n - np.outer(mean, mean))
    axes = axes[:, np.argsort(values)[::-1][:components]]
    return mean, (axes * np.sign(axes[np.abs(axes).argmax(axis=0), range(axes.shape[1])])).T


def clusters(vectors: DataFrame, k: int, seed: int = 17) -> DataFrame:
    """(vec_id, cluster, second, margin): weighted k-means, with the second nearest centre and the distance between."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = vectors.select("vec_id", "weight", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"), "embedding")
    model = KMeans(k=k, seed=seed, weightCol="weight", maxIter=20).fit(rows)
    centres = np.array(model.clusterCenters())

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if part.empty:
                continue
            x = np.array(part["embedding"].tolist(), float)
            distance = (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)
            order = np.argsort(distance, axis=1, kind="stable")
            rows_ = np.arange(len(part))
            second = order[:, min(1, len(centres) - 1)]
            yield pd.DataFrame({
                "vec_id": part["vec_id"], "cluster": order[:, 0].astype(np.int32), "second": second.astype(np.int32),
                "margin": distance[rows_, second] - distance[rows_, order[:, 0]],
            })

    return rows.select("vec_id", "embedding").mapInPandas(run, "vec_id bigint, cluster int, second int, margin double")


def save_model(spark, h: np.ndarray, path: str) -> None:
    """The topic matrix as a table (topic_id, col, weight) without zeros."""
    cells = pd.DataFrame({"topic_id": np.nonzero(h)[0].astype(np.int32), "col": np.nonzero(h)[1].astype(np.int32), "weight": h[np.nonzero(h)]})
    spark.createDataFrame(cells).write.mode("overwrite").parquet(path)


def load_model(spark, path: str, shape: tuple[int, int]) -> np.ndarray:
    h = np.zeros(shape)
    cells = spark.read.parquet(path).toPandas()  # a model, bounded by MOST_CELLS
    h[cells["topic_id"], cells["col"]] = cells["weight"]
    return h


def fit_grid(rows: DataFrame, n_terms: int, topic_numbers: list[int], seeds: list[int], **how: int) -> list[dict[str, float]]:
    """The last relative error of each (topics, seed), and how well each seed's topics match the first seed's."""
    out = []
    for topics in topic_numbers:
        first = None
        for seed in seeds:
            h, errors = fit(rows, n_terms, topics, seed=seed, **how)
            first = h if first is None else first
            cosine = float(np.mean([c for _, _, c in matched_components(first, h)]))
            out.append({"topics": topics, "seed": seed, "relative_error": errors[-1], "cosine_to_first": cosine})
    return out
