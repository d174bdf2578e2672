"""Support vector machines of a whole grid, fitted together.

A polynomial kernel of degree d is a linear model over the monomials of the features up to d, and those
of a lower degree come first, so all models of a week share one expansion. It is made once: one pass sums
its second moments, whose principal directions (all that the weakest penalty lets matter) take the place
of up to thousands of monomials, and the rows are kept in these coordinates.

Then every model of every week - each fold left out and none, each penalty, each degree - takes Newton
steps on the hinge loss with its corner rounded off, ever less. One pass over the rows gives losses along
the step, slopes and curvatures of all models that are not done; tasks that share the models add these
up and solve for the next steps, and find a week's directions. The driver sees steps and directions, no
matrix of moments or curvatures. Passes hold as many models as `CELLS` allows. Of a week whose rows fit a task
(`ALONE`) tasks that share its models take all their steps alone, the same ones, without a pass for each.

The loss is the mean of max(0, 1 - y f(x)), the penalty 1 / (2 c n) times the squared weights but
for the constant; f is the smoothed solution's, whose distance from the optimum `certificates` measures.
"""

from __future__ import annotations

import pickle
import uuid
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from copy import copy
from dataclasses import dataclass, field
from itertools import combinations_with_replacement, count

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVCModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from learnertrace.functions.arrow import finished, mapped, totals

#: Widths of the rounded corner, one after the other.
CORNERS = (2.0, 0.3, 0.05, 0.01)
#: Shares of a step that are tried.
SHARES = np.array([0.0, 0.01, 0.03, 0.1, 0.2, 0.35, 0.5, 0.7, 0.85, 1.0])
#: A step that promises less than this ends a corner.
LITTLE = 1e-9
#: What the directions left out may be worth, in units of the loss.
LEFT_OUT = 5e-4
#: Numbers that one week's models may sum in a pass.
CELLS = 8 << 20
#: Numbers that a week's rows may be, in the coordinates of a degree, for a task to hold them all.
ALONE = 48 << 20
#: Passes after which a fit ends as it is.
MOST = 600
#: Rows that are expanded at once.
CHUNK = 1024


def exponents(n_features: int, degree: int) -> list[tuple[int, ...]]:
    """The monomials up to a degree, those of lower degrees first, as the features they multiply."""
    return [m for d in range(1, degree + 1) for m in combinations_with_replacement(range(n_features), d)]


def expanded(rows: np.ndarray, degree: int) -> np.ndarray:
    """Monomials (one per line) of rows of features, in the order of `exponents`."""
    n_features = rows.shape[1]
    lines, lower = [rows.T], rows.T
    place = {(j,): j for j in range(n_features)}
    for d in range(2, degree + 1):
        names = list(combinations_with_replacement(range(n_features), d))
        lower = lower[[place[m[:-1]] for m in names]] * rows.T[[m[-1] for m in names]]
        place = {m: k for k, m in enumerate(names)}
        lines.append(lower)
    return np.concatenate(lines)


def blocks(training: DataFrame, columns: Sequence[str], fold: Column) -> DataFrame:
    """Rows (model_week, label, fold and the columns) of one week and task as blocks of arrays."""
    names = list(columns)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            week = batch.column("model_week").to_numpy()
            rows = np.column_stack([batch.column(c).to_numpy() for c in names])
            y = np.where(batch.column("label").to_numpy() > 0, 1.0, -1.0)
            part = batch.column("fold").to_numpy()
            found = np.unique(week)
            made = [pickle.dumps({"rows": rows[week == w], "y": y[week == w], "fold": part[week == w]})
                    for w in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int32()), pa.array(made, pa.binary())], ["model_week", "block"])

    plain = training.select(F.col("model_week").cast("int").alias("model_week"), "label", fold.alias("fold"),
                            *[F.col(c).cast("double").alias(c) for c in names])
    return mapped(plain, pack, "model_week int, block binary")


def _moments(block: dict, degree: int) -> np.ndarray:
    """Sums of products of monomials."""
    rows, total = block["rows"], 0.0
    for start in range(0, len(rows), CHUNK):
        lines = expanded(rows[start:start + CHUNK], degree)
        total = total + lines @ lines.T
    return total


def directions(moments: np.ndarray, weakest: float, seed: int = 0) -> np.ndarray:
    """Principal directions (as lines, scaled to second moment 1) of a matrix of second moments.

    A direction of moment s can lower the loss by at most s / (2 * penalty). Those are left out that
    could do so by LEFT_OUT together under the weakest penalty; the trace tells what is left, so
    a random start, widened until it holds enough, loses nothing unnoticed.
    """
    size, whole = len(moments), float(np.trace(moments))
    least = 2 * weakest * LEFT_OUT
    width = min(size, 64)
    while True:
        if 2 * width >= size:
            values, vectors = np.linalg.eigh(moments)
        else:
            start = np.random.default_rng(seed).normal(size=(size, width))
            basis = np.linalg.qr(moments @ np.linalg.qr(moments @ start)[0])[0]
            values, inner = np.linalg.eigh(basis.T @ moments @ basis)
            vectors = basis @ inner
        values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
        rest = whole - np.cumsum(values)
        if 2 * width >= size or rest[-1] <= least:
            break
        width *= 2
    enough = np.flatnonzero(rest <= least)
    kept = values > 1e-14 * max(whole, 1e-300)
    if len(enough):
        kept[enough[0] + 1:] = False
    if not kept.any():
        kept[0] = True
    return (vectors[:, kept] / np.sqrt(np.maximum(values[kept], 1e-300))).T


@dataclass
class Machine:
    """One model: what it is, and where its descent stands."""

    week: int
    degree: int
    penalty: float
    fold: int
    rows: int
    weak: np.ndarray  # the penalty of each coordinate
    at: np.ndarray = field(init=False)
    step: np.ndarray = field(init=False)
    corner: int = 0
    damping: float = 1e-9
    done: bool = False

    def __post_init__(self) -> None:
        self.at, self.step = np.zeros(len(self.weak) + 1), np.zeros(len(self.weak) + 1)

    @property
    def size(self) -> int:
        return len(self.at)

    @property
    def cells(self) -> int:
        return len(SHARES) + self.size + self.size * self.size

    def told(self, sums: np.ndarray) -> None:
        """Go on with the sums of a pass: losses along the step, slope and curvature at its end."""
        if self.step.any() and self.moved(sums[:len(SHARES)]) != len(SHARES) - 1:
            # What was measured at the whole step's end does not count; it is measured again where this one ended.
            self.step = np.zeros(self.size)
            return
        self.aim(sums[len(SHARES):len(SHARES) + self.size],
                 sums[len(SHARES) + self.size:].reshape(self.size, self.size))

    def moved(self, losses: np.ndarray) -> int:
        """Go along the step as far as pays most; the number of that share of it."""
        pen = np.append(self.weak, 0.0)
        points = self.at + SHARES[:, None] * self.step
        best = int((losses / self.rows + (pen * points * points).sum(1) / 2).argmin())
        if best == 0:
            # No share of it helps: a more careful step from the same place.
            self.damping = max(100 * self.damping, 1e-5)
        else:
            self.damping = max(self.damping / 10, 1e-9)
            self.at = self.at + SHARES[best] * self.step
        return best

    def aim(self, slope: np.ndarray, curve: np.ndarray) -> None:
        """The next step, or the next corner where it promises little, from sums of slopes and curvatures."""
        pen = np.append(self.weak, 0.0)
        slope, curve = slope / self.rows + pen * self.at, curve / self.rows + np.diag(pen)
        # The coordinates have second moments of 1, so one number damps them all alike.
        self.step = -np.linalg.solve(curve + self.damping * np.eye(self.size), slope)
        if -float(slope @ self.step) < LITTLE:
            self.rounder()

    def rounder(self) -> None:
        """The next corner, or the end."""
        self.step, self.damping = np.zeros(self.size), 1e-9
        self.corner += 1
        self.done = self.corner == len(CORNERS)


def _losses(short: np.ndarray, corner: float) -> np.ndarray:
    """Per line, the summed loss of rows that lack so much of the margin."""
    return np.where(short >= corner, short - corner / 2, np.maximum(short, 0) ** 2 / (2 * corner)).sum(1)


def _measured(block: dict, asked: Mapping[int, Machine]) -> Iterator[tuple[int, np.ndarray]]:
    """Losses, slopes and curvatures of a week's models over a block."""
    for number, machine in asked.items():
        corner, at, step = CORNERS[machine.corner], machine.at, machine.step
        rows, mine = block[machine.degree], block["fold"] != machine.fold
        y = block["y"] * mine  # a row left out has no part in any sum
        margin, change = (at @ rows) * y, (step @ rows) * y
        short = mine - (margin + SHARES[:, None] * change)
        losses = _losses(short, corner)
        pull = np.clip(short[-1] / corner, 0, 1)
        bent = rows[:, (pull > 0) & (pull < 1)]
        yield number, np.concatenate([losses, -rows @ (pull * y), (bent @ bent.T / corner).ravel()])


def _told(machine: Machine, sums: np.ndarray) -> Machine:
    """What becomes of a machine with the sums of a pass."""
    machine = copy(machine)  # a task that is repeated starts from the same
    machine.told(sums)
    return machine


def _descended(machine: Machine, rows: np.ndarray) -> Iterator[Machine]:
    """A machine at the end of each corner, on the descent that `descend` would make it take; `rows` are all it
    learns from (a line each), times their class."""
    machine = copy(machine)
    margin, slope, curve = np.zeros(len(rows)), None, None
    for _ in range(MOST):
        before, corner = machine.corner, CORNERS[machine.corner]
        if machine.step.any():
            change = rows @ machine.step
            best = machine.moved(_losses(1 - (margin + SHARES[:, None] * change), corner))
            margin = margin + SHARES[best] * change
        else:
            best = -1
        if best:
            pull = np.clip((1 - margin) / corner, 0, 1)
            bent = np.flatnonzero((pull > 0) & (pull < 1))
            slope, curve = -(pull @ rows), 0.0
            for start in range(0, max(len(bent), 1), CHUNK):
                part = rows[bent[start:start + CHUNK]]
                curve = curve + part.T @ part / corner
        machine.aim(slope, curve)
        if machine.corner > before:
            yield machine
        if machine.done:
            return
    yield machine


def alone(packed: DataFrame, shared, machines: Sequence[Machine]) -> dict[tuple, tuple[np.ndarray, int]]:
    """Machines fitted by tasks that each hold all rows of a week: per week, degree, fold and penalty where it ends,
    and how many rows of the fold it has right. `shared` has the directions per week and degree."""
    tasks: dict[tuple[int, int, int], list[Machine]] = defaultdict(list)
    for machine in machines:
        tasks[machine.week, machine.degree, machine.fold].append(machine)
    # Those that take longest begin first.
    order = sorted(tasks, key=lambda task: -tasks[task][0].rows * tasks[task][0].size ** 2)
    places = defaultdict(list)
    for place, (week, _, _) in enumerate(order):
        places[week].append(place)
    work = packed.sparkSession.sparkContext.broadcast([tasks[task] for task in order])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for week, block in zip(batch.column("model_week").to_pylist(), batch.column("block")):
                for place in places[week]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([place], pa.int32()), pa.array([block.as_py()], pa.binary())], ["place", "block"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = defaultdict(list)
        for batch in batches:
            for place, block in zip(*(batch.column(c).to_pylist() for c in ("place", "block"))):
                held[place].append(pickle.loads(block))
        for place, blocks in held.items():
            mine = work.value[place]
            week, degree, fold = mine[0].week, mine[0].degree, mine[0].fold
            basis = shared.value[week, degree]
            plain, y, part = (np.concatenate([block[name] for block in blocks]) for name in ("rows", "y", "fold"))
            last = np.argsort(part == fold, kind="stable")  # those that judge come last
            plain, y, learnt = plain[last], y[last], int((part != fold).sum())
            rows = np.empty((len(y), len(basis) + 1))
            for start in range(0, len(y), CHUNK):
                rows[start:start + CHUNK, :-1] = (basis @ expanded(plain[start:start + CHUNK], degree)).T
            rows[:, -1] = 1
            rows *= y[:, None]
            for machine in mine:
                for end in _descended(machine, rows[:learnt]):
                    # A margin of 0 counts as the lower class.
                    margin = rows[learnt:] @ end.at
                    right = int(np.where(y[learnt:] > 0, margin > 0, margin >= 0).sum())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([place], pa.int32()), pa.array([pickle.dumps((end.penalty, end.at, right))], pa.binary())],
                        ["place", "end"])

    dealt = mapped(packed.filter(F.col("model_week").isin(list(places))), deal, "place int, block binary")
    found = {}
    for row in mapped(dealt.repartitionById(len(order), "place"), fit, "place int, end binary").collect():
        penalty, at, right = pickle.loads(row["end"])
        found[(*order[row["place"]], penalty)] = at, right  # that of the last corner stays
    work.destroy()
    return found


def _right(week: int, block: dict, asked: Mapping[int, list[tuple]]) -> np.ndarray:
    """Right predictions of a week's models for the fold each left out."""
    found = []
    for degree, fold, at in asked[week]:
        mine = block["fold"] == fold
        margin = at @ block[degree][:, mine]
        found.append(((margin > 0) == (block["y"][mine] > 0)).sum())
    return np.array(found, float)


def descend(rows: DataFrame, machines: list[Machine]) -> None:
    """Fit machines on blocks of rows in their coordinates."""
    for _ in range(MOST):
        asked, cells = defaultdict(dict), defaultdict(int)
        for number, machine in enumerate(machines):
            if not machine.done and (not cells[machine.week] or cells[machine.week] + machine.cells <= CELLS):
                asked[machine.week][number] = machine
                cells[machine.week] += machine.cells
        if not asked:
            break
        shared = rows.sparkSession.sparkContext.broadcast(dict(asked))
        here = rows.filter(F.col("model_week").isin(list(asked)))
        for (_, number), machine in finished(
                here, lambda week, block: _measured(block, shared.value[week]),
                lambda week, number, sums: _told(shared.value[week][number], sums)).items():
            machines[number] = machine
        shared.destroy()


def fitted_grid(
    training: DataFrame, columns: Sequence[str], fold: Column, sizes: Mapping[int, Sequence[int]],
    choices: Sequence[Mapping],
) -> dict[int, tuple[Mapping, np.ndarray, float]]:
    """Per week: the choice (penalty, degree) of the best accuracy over the folds, and the
    coefficients (in the order of `exponents`) and constant of its model of all rows.

    `sizes` gives a week's rows in each fold; `fold` is each row's. A choice's accuracy is the
    mean over the folds that have rows to fit and to judge; of equal ones the first is taken.
    """
    degrees = sorted({c.get("degree", 1) for c in choices})
    packed = blocks(training, columns, fold).persist()
    bases, machines = {}, []
    rows_in = {week: sum(parts) for week, parts in sizes.items()}
    monomials = {degree: len(exponents(len(columns), degree)) for degree in degrees}
    most = max(c["penalty"] for c in choices)

    def found_directions(week: int, _: int, sums: np.ndarray) -> dict[int, np.ndarray]:
        n = rows_in[week]
        return {d: directions(sums[:size, :size] / n, 1 / (most * n)) for d, size in monomials.items()}

    try:
        for (week, _), made in finished(
                packed.filter(F.col("model_week").isin(list(sizes))),
                lambda week, block: iter([(0, _moments(block, degrees[-1]))]), found_directions).items():
            bases |= {(week, degree): basis for degree, basis in made.items()}
        for week, parts in sizes.items():
            n = rows_in[week]
            for degree in degrees:
                basis = bases[week, degree]
                # Of weights w = basis' v, the squared sum, as the lines of the basis are orthogonal.
                strength = (basis * basis).sum(1)
                for choice in choices:
                    if choice.get("degree", 1) == degree:
                        for k in (-1, *(k for k, part in enumerate(parts) if 0 < part < n)):
                            left = n - (parts[k] if k >= 0 else 0)
                            machines.append(Machine(week, degree, choice["penalty"], k, left,
                                                    strength / (choice["penalty"] * left)))
        shared = training.sparkSession.sparkContext.broadcast(bases)
        widest = {week: max(m.size for m in machines if m.week == week) for week in sizes}
        small = {week for week, n in rows_in.items() if n * widest[week] <= ALONE}
        rows = _projected(packed.filter(~F.col("model_week").isin(list(small))), shared, degrees).persist()
        right: dict[int, Sequence] = {}
        try:
            ends = alone(packed, shared, [m for m in machines if m.week in small]) if small else {}
            large = [m for m in machines if m.week not in small]
            descend(rows, large)
            machines = [m for m in machines if m.week in small] + large
            judges = [m for m in machines if m.fold >= 0]
            told = defaultdict(list)
            for m in judges:
                if m.week not in small:
                    told[m.week].append((m.degree, m.fold, m.at))
            if told:
                right |= totals(rows.filter(F.col("model_week").isin(list(told))), "model_week",
                                lambda week, block: _right(week, block, told))
            for m in machines:
                if m.week in small:
                    m.at, hits = ends[m.week, m.degree, m.fold, m.penalty]
                    if m.fold >= 0:
                        right.setdefault(m.week, []).append(hits)
        finally:
            rows.unpersist()
            shared.destroy()
    finally:
        packed.unpersist()
    found = {}
    for week, parts in sizes.items():
        shares = defaultdict(list)
        mine = [m for m in judges if m.week == week]
        for machine, hits in zip(mine, right.get(week, ())):
            shares[machine.penalty, machine.degree].append(hits / parts[machine.fold])
        accuracy = [np.mean(shares[c["penalty"], c.get("degree", 1)] or [0.0]) for c in choices]
        best = choices[int(np.argmax(accuracy))]
        model = next(m for m in machines if m.week == week and m.fold < 0
                     and (m.penalty, m.degree) == (best["penalty"], best.get("degree", 1)))
        found[week] = best, bases[week, model.degree].T @ model.at[:-1], float(model.at[-1])
    return found


def _projected(packed: DataFrame, shared, degrees: list[int]) -> DataFrame:
    """Blocks of the same rows in each degree's coordinates, and a line of ones for the constant."""
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weeks = batch.column("model_week").to_pylist()
            for week, pickled in zip(weeks, batch.column("block").to_pylist()):
                if (week, degrees[-1]) not in shared.value:
                    continue
                block = pickle.loads(pickled)
                parts = []
                for start in range(0, len(block["y"]), CHUNK):
                    lines = expanded(block["rows"][start:start + CHUNK], degrees[-1])
                    parts.append([shared.value[week, d] @ lines[:shared.value[week, d].shape[1]] for d in degrees])
                ones = np.ones((1, len(block["y"])))
                made = {d: np.concatenate((np.concatenate([p[k] for p in parts], axis=1), ones))
                        for k, d in enumerate(degrees)}
                made |= {"y": block["y"], "fold": block["fold"]}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([week], pa.int32()), pa.array([pickle.dumps(made)], pa.binary())],
                    ["model_week", "block"])

    return mapped(packed, project, "model_week int, block binary")


def spark_order(spark: SparkSession, n_features: int, degree: int) -> list[int]:
    """The place in `exponents` of each entry of Spark's polynomial expansion, read off a vector of primes."""
    primes = _first_primes(n_features)
    place = {int(np.prod([primes[j] for j in m], dtype=object)): k
             for k, m in enumerate(exponents(n_features, degree))}
    probe = spark.createDataFrame([(Vectors.dense(primes),)], ["features"])
    powers = PolynomialExpansion(degree=degree, inputCol="features", outputCol="powers").transform(probe)
    return [place[int(x)] for x in powers.select(vector_to_array("powers")).first()[0]]


def _first_primes(most: int) -> list[int]:
    found: list[int] = []
    for n in count(2):
        if len(found) == most:
            return found
        if all(n % p for p in found):
            found.append(n)
    return found


def as_stages(spark: SparkSession, n_features: int, degree: int, penalty: float, rows: int,
              weights: np.ndarray, constant: float) -> list:
    """Spark's stages for a fitted machine: the expansion if there is one, and the linear model."""
    stages, column = [], "features"
    if degree > 1:
        column = "powers"
        stages.append(PolynomialExpansion(degree=degree, inputCol="features", outputCol=column))
        weights = weights[spark_order(spark, n_features, degree)]
    vector = _py2java(spark.sparkContext, Vectors.dense(weights))
    java = spark._jvm.org.apache.spark.ml.classification.LinearSVCModel(
        f"machine_{uuid.uuid4().hex[:12]}", vector, constant)
    model = LinearSVCModel(java)
    model._resetUid(java.uid())
    model._set(featuresCol=column, labelCol="label", regParam=1.0 / (penalty * max(rows, 1)), standardization=False)
    return [*stages, model]
