"""Newton's method for many small convex problems at once: one Spark job takes a step in all of them.

A problem is a smooth loss summed over rows plus a quadratic penalty. A job hands each block of rows, mapped once for all
problems that share the map, to every problem that is still open and adds up, for each, its loss at several fractions of
the last step, its gradient and the upper triangle of its Hessian at the full step. A step that went too far is thus taken
back without further jobs (``plans.sums`` adds up over the tasks). The driver solves systems the size of one problem; problems wait their turn where all systems together would exceed
``SYSTEM_CELLS`` numbers. Nothing depends on the order of rows but the last digits of sums.

Over a large table the way to the neighbourhood of the minimum is searched on growing parts of the rows (``sums.shares``).
From there the search goes on over all rows until it meets the same tolerance there: the minimum is that of all rows, and
the parts only spare it most of its jobs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame

from plumbline.plans.sums import add_up, shares

#: Fractions of a step whose loss each job measures.
FRACTIONS = 0.5 ** np.arange(14)
SYSTEM_CELLS = 1 << 25
#: Size of a system above which it is eliminated, on a large table.
ELIMINATED = 100
#: Tasks over a part of the rows, at least.
LEAST_TASKS = 8

#: (mapped rows, the block's other columns) to losses at the fractions, gradient and Hessian.
Sums = Callable[[np.ndarray, pd.DataFrame], tuple[np.ndarray, np.ndarray, np.ndarray]]


class Problem:
    """Where the search for one minimum stands. Subclasses say how rows are summed up."""

    #: Stages, one after another from where the last one ended, that make the loss sharper.
    stages = 1

    def __init__(self, mapping: int, size: int, rows: int, penalty: float, penalised: np.ndarray, tolerance: float, most_jobs: int):
        self.mapping, self.rows, self.tolerance, self.most_jobs = mapping, rows, tolerance, most_jobs
        self.penalty = penalty * penalised
        self.weights = self.step = np.zeros(size)
        self.stage, self.jobs, self.damping, self.objective, self.done = 0, 0, 0.0, math.inf, False
        self.gradient = self.hessian = None

    def sums(self) -> Sums:
        """What the tasks do at ``weights`` and ``step``; small, since it travels to them."""
        raise NotImplementedError

    def fractions(self) -> np.ndarray:
        """Those whose losses differ: before the first step they are all the same."""
        return FRACTIONS if self.step.any() else FRACTIONS[:1]

    def go_on(self) -> None:
        """Search further over more rows, from the weights and with the loss where the last search ended."""
        self.step, self.jobs, self.damping, self.objective, self.done = np.zeros_like(self.weights), 0, 0.0, math.inf, False

    def advance(self, losses: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, share: int = 1) -> None:
        """Take in what was measured on one in ``share`` rows and choose the next step."""
        self.jobs += 1
        losses, gradient, hessian = np.resize(losses, len(FRACTIONS)) * share, gradient * share, hessian * share
        tried = [self.weights + f * self.step for f in FRACTIONS]
        objectives = losses / self.rows + [(self.penalty * w * w).sum() / 2 for w in tried]
        best = int(objectives.argmin())
        first = not np.isfinite(self.objective)
        gain = self.objective - objectives[best]
        if not first and gain <= 0:
            # no fraction helps: a shorter, steeper direction from where the search stands
            self.damping = max(8 * self.damping, 1e-4 * float(np.trace(self.hessian)) / len(self.weights))
        elif not first and self.objective - objectives[0] < 0.3 * gain:
            # another fraction is much better: measure there before going on, and go less far next time
            self.step = FRACTIONS[best] * self.step
            self.damping = max(4 * self.damping, 1e-5 * float(np.trace(self.hessian)) / len(self.weights))
            return
        else:
            self.weights, self.objective = tried[0], float(objectives[0])
            self.gradient = gradient / self.rows + self.penalty * self.weights
            self.hessian = hessian / self.rows + np.diag(self.penalty)
            self.damping = 0.0 if first else self.damping / 8
        system = self.hessian + (self.damping + 1e-12) * np.eye(len(self.weights))
        self.step = -(_eliminated if shares(self.rows) else _least_squares)(system, self.gradient)
        expected = -(self.gradient @ self.step + self.step @ self.hessian @ self.step / 2)
        last = self.stage + 1 >= self.stages
        if expected <= (self.tolerance if last else 0.02) * max(self.objective, 1e-6):
            self.done = last
            self.stage += not last
            self.step, self.objective, self.damping = np.zeros_like(self.weights), math.inf, 0.0
        self.done = self.done or self.jobs >= self.most_jobs


def _least_squares(system: np.ndarray, gradient: np.ndarray) -> np.ndarray:
    return np.linalg.lstsq(system, gradient, rcond=None)[0]


def _eliminated(system: np.ndarray, gradient: np.ndarray) -> np.ndarray:
    """The same where the system is small or singular; others are eliminated, in a tenth of the time."""
    if len(gradient) > ELIMINATED:
        try:
            found = np.linalg.solve(system, gradient)
            if np.isfinite(found).all() and np.abs(system @ found - gradient).max() <= 1e-8 * np.abs(gradient).max():
                return found
        except np.linalg.LinAlgError:
            pass
    return _least_squares(system, gradient)


def _measured(rows: DataFrame, tasks: int, features: Sequence[str], maps: Sequence[Callable], problems: dict[int, Problem]) -> dict[int, tuple]:
    names, plan = list(features), {}
    for number, p in problems.items():
        plan.setdefault(p.mapping, []).append((number, p.sums()))

    def measure(batches: Iterator[pd.DataFrame]) -> dict[int, np.ndarray]:
        totals: dict[int, list] = {}
        for batch in batches:
            x = batch[names].to_numpy(dtype=float)
            for mapping, wanted in plan.items():
                mapped = maps[mapping](x)
                for number, sums in wanted:
                    new = sums(mapped, batch)
                    totals[number] = [o + n for o, n in zip(totals[number], new)] if number in totals else list(new)
        return {number: np.concatenate([np.resize(losses, len(FRACTIONS)), gradient, hessian[np.triu_indices(len(gradient))]])
                for number, (losses, gradient, hessian) in totals.items()}

    sizes = {number: len(p.weights) for number, p in problems.items()}
    values = sum(len(FRACTIONS) + n + n * (n + 1) // 2 for n in sizes.values())
    out = {}
    for number, flat in add_up(rows, tasks, measure, values).items():
        n, size = len(FRACTIONS), sizes[number]
        hessian = np.zeros((size, size))
        hessian[np.triu_indices(size)] = flat[n + size:]
        out[number] = flat[:n], flat[n:n + size], hessian + np.triu(hessian, 1).T
    return out


def minimise(rows: DataFrame, features: Sequence[str], maps: Sequence[Callable], problems: Sequence[Problem]) -> None:
    """Search all problems to their end over persisted rows: the features, and what the problems read besides."""
    for share in shares(max((p.rows for p in problems), default=0)):
        tasks = rows.rdd.getNumPartitions()
        part = rows.sample(fraction=1 / share, seed=share).coalesce(max(LEAST_TASKS, tasks // share)).persist(StorageLevel.MEMORY_AND_DISK)
        _search(part, features, maps, problems, share)
        part.unpersist()
        for p in problems:
            p.go_on()
    _search(rows, features, maps, problems)


def _search(rows: DataFrame, features: Sequence[str], maps: Sequence[Callable], problems: Sequence[Problem], share: int = 1) -> None:
    waiting, active, tasks = list(enumerate(problems)), {}, rows.rdd.getNumPartitions()
    while waiting or active:
        room = SYSTEM_CELLS - sum(len(p.weights) ** 2 for p in active.values())
        while waiting and (not active or len(waiting[0][1].weights) ** 2 <= room):
            number, p = waiting.pop(0)
            active[number] = p
            room -= len(p.weights) ** 2
        found = _measured(rows, tasks, features, maps, active)
        for number, p in list(active.items()):
            if number in found:
                p.advance(*found[number], share)
            else:
                p.done = True
            if p.done:
                del active[number]
                p.gradient = p.hessian = None
