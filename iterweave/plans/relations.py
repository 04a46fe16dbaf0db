"""Loops over relations: one that improves, and programs that rebind several by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from iterweave.operators.orders import Order
from iterweave.plans.fixpoint import NotConverged
from iterweave.workspace import KeyedLog, Stored, Workspace


class Improving:
    """A relation with the best row per key, kept as a log of improvements.

    A round appends what got better, so it writes in proportion to that; the log is
    distributed on the key and merged on read, in place.  When the improvements outgrow what
    they improve twofold, they are folded into one row per key, so reading costs at most three
    times the relation and a round, and folding at most half of the appends before it.

    The log is distributed on the order's keys, or on those of them that ``by`` names.
    """

    def __init__(
        self,
        ws: Workspace,
        name: str,
        start: DataFrame,
        order: Order,
        by: Sequence[str] | None = None,
        **measures: Column,
    ):
        self.ws, self.name, self.order = ws, name, order
        self.by = list(by or order.keys)
        self.schema = start.select(*order.merge(start).columns).schema
        self.log = self._new_log()
        self.round = 0
        self.metrics = self.log.append(order.merge(start), 0, **measures)
        rows = self.metrics["rows"]
        self.written = [rows]  # by round; the first is the start
        self._folded, self._since, self._from = rows, 0, 0
        self._changed = self.log, 0  # where the last round's improvements are

    def discard(self) -> None:
        """Free the log once no pending plan reads it."""
        self.ws.discard(*{log.table: log for log in (self.log, self._changed[0])}.values())

    def read(self) -> DataFrame:
        """The best row of every key."""
        rows = self.log.read(self._from, self.round).drop(KeyedLog.ROUND)
        return rows if self._from == self.round else self.order.merge(rows)

    def delta(self) -> DataFrame:
        """What the last round improved."""
        log, number = self._changed
        return log.read(number).drop(KeyedLog.ROUND)

    def improve(self, candidates: DataFrame, **measures: Column) -> int:
        """Keep the candidates that improve on what is known, as the next round; how many.
        The measures are observed on the write."""
        gains = self.order.gains(self.order.merge(candidates), self.read())
        self.metrics = self.log.append(gains, self.round + 1, **measures)
        rows = self.metrics["rows"]
        self.round += 1
        self.written.append(rows)
        self._since += rows
        if self._changed[0] is not self.log:
            self.ws.discard(self._changed[0])
        self._changed = self.log, self.round
        if self._since > 2 * self._folded:
            self._fold()
        return rows

    def _fold(self) -> None:
        """Rewrite the log as one row per key; ``delta`` stays in the old one for a round."""
        known = self.read()
        self.log = self._new_log()
        self.round += 1
        self._folded = self.log.append(known, self.round)["rows"]
        self._since, self._from = 0, self.round

    def _new_log(self) -> KeyedLog:
        return self.ws.keyed_rounds(self.name, self.schema, self.by)


def improve_until_fixed(
    ws: Workspace,
    start: DataFrame,
    step: Callable[[DataFrame], DataFrame],
    order: Order,
    *,
    name: str = "best",
    max_rounds: int | None = None,
) -> Improving:
    """The best row per key reachable from ``start`` by ``step``, which sees the rows that the
    last round improved.  A value may improve in any number of rounds; the loop ends when a
    round improves nothing."""
    best = Improving(ws, name, start, order)
    rows, number = best.written[0], 0
    while rows:
        if number == max_rounds:
            raise NotConverged(f"still improving after {max_rounds} rounds")
        number += 1
        rows = best.improve(step(best.delta()))
    return best


@dataclass
class Growing:
    """Initial rows of a relation that a program adds to; rows are never taken away."""

    start: DataFrame
    keys: Sequence[str]


@dataclass
class Best:
    """Initial rows of a relation that a program improves, in an order."""

    start: DataFrame
    order: Order


@dataclass
class Program:
    """Relations by name, rebound statement by statement in a loop.

    A statement (name, plan) gives its relation a new meaning: a plain relation is replaced, a
    growing one takes the plan's rows in addition, and an improving one takes those that are
    better.  Each is one job, written once; later statements read what was written.
    """

    ws: Workspace
    rows: dict[str, int] = field(default_factory=dict)  # by the last statement of that name
    _plain: dict[str, Stored] = field(default_factory=dict)
    _growing: dict[str, tuple[KeyedLog, int]] = field(default_factory=dict)
    _best: dict[str, Improving] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._plain:
            return self._plain[name].df
        if name in self._growing:
            log, last = self._growing[name]
            return log.read(0, last).drop(KeyedLog.ROUND)
        return self._best[name].read()

    def gained(self, name: str) -> DataFrame:
        """What the last statement of an improving relation made better."""
        return self._best[name].delta()

    def bind(self, name: str, meaning: DataFrame | Growing | Best) -> None:
        if isinstance(meaning, Growing):
            log = self.ws.keyed_rounds(name, meaning.start.schema, list(meaning.keys))
            self.rows[name] = log.append(meaning.start, 0)["rows"]
            self._growing[name] = log, 0
        elif isinstance(meaning, Best):
            self._best[name] = Improving(self.ws, name, meaning.start, meaning.order)
            self.rows[name] = self._best[name].written[0]
        else:
            self._plain[name] = self.ws.materialize(meaning, name)
            self.rows[name] = self._plain[name].rows

    def assign(self, name: str, plan: DataFrame) -> None:
        if name in self._growing:
            log, last = self._growing[name]
            self.rows[name] = log.append(plan, last + 1)["rows"]
            self._growing[name] = log, last + 1
        elif name in self._best:
            self.rows[name] = self._best[name].improve(plan)
        else:
            before = self._plain[name]
            self.bind(name, plan)
            self.ws.discard(before)


Statement = tuple[str, Callable[[Program, int], DataFrame]]


def do_while(
    ws: Workspace,
    relations: Mapping[str, DataFrame | Growing | Best],
    body: Sequence[Statement],
    condition: Callable[[Program], DataFrame],
    *,
    max_rounds: int | None = None,
) -> Program:
    """Run ``body`` at least once, and again while ``condition``, a relation whose first row
    starts with a truth value, says so.  Rounds are numbered from 1."""
    program = Program(ws)
    for name, meaning in relations.items():
        program.bind(name, meaning)
    number = 0
    while True:
        if number == max_rounds:
            raise NotConverged(f"still going after {max_rounds} rounds")
        number += 1
        for name, plan in body:
            program.assign(name, plan(program, number))
        row = condition(program).first()
        if row is None or not row[0]:
            return program


def holds_rows(relation: DataFrame) -> DataFrame:
    """The usual condition: whether a relation has any rows."""
    return relation.limit(1).agg((F.count(F.lit(1)) > 0).alias("any"))
