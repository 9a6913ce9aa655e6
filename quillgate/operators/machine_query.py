"""Questions to the machines of parsed texts, as filters over section rows (read_rtl: machine, state, transition, output, action, coupling, rejected)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ("record_id", "module", "register")


class Machines:
    def __init__(self, rows: DataFrame):
        self.rows = rows

    def _of(self, section: str, register: str) -> DataFrame:
        return self.rows.where(F.col("section") == section).select("record_id", "module", F.col(register).alias("register"), *[c for c in ("name", "kind", "status", "role", "value", "target", "context", "reset", "clock", "edge", "width", "detail", "n") if c != register])

    def fsms(self, status: str | None = None) -> DataFrame:
        m = self._of("machine", "name")
        return m if status is None else m.where(F.col("status") == status)

    def fsm(self, **where: str) -> DataFrame:
        """The one machine that matches; more or none is an error."""
        m = self.fsms()
        for k, v in where.items():
            m = m.where(F.col(k) == v)
        got = m.limit(2).count()
        if got != 1:
            raise LookupError(f"{'no' if not got else 'more than one'} machine for {where}")
        return m

    def states(self) -> DataFrame:
        return self._of("state", "target")

    def state(self, name: str | int, **where: str) -> DataFrame:
        """The one state of that name or value."""
        s = self.states()
        for k, v in where.items():
            s = s.where(F.col(k) == v)
        s = s.where(F.col("n") == name) if isinstance(name, int) else s.where(F.col("name") == name)
        if s.limit(2).count() != 1:
            raise LookupError(f"not one state {name!r} for {where}")
        return s

    def transitions(self) -> DataFrame:
        """By priority, those without one last."""
        return self._of("transition", "name").withColumnRenamed("value", "from_state").withColumnRenamed("target", "to_state").orderBy(*KEY, F.col("n").asc_nulls_last(), "from_state", "to_state")

    def outgoing(self, state: str) -> DataFrame:
        return self.transitions().where(F.col("from_state") == state)

    def incoming(self, state: str) -> DataFrame:
        return self.transitions().where(F.col("to_state") == state)

    def guard(self) -> DataFrame:
        """Conditions of transitions; whether they can hold together isn't analysed."""
        return self.transitions().select(*KEY, "from_state", "to_state", "context", F.lit("not_analyzed").alias("predicate_feasibility"))

    def encoding(self) -> DataFrame:
        return self.fsms().select(*KEY, F.col("value").alias("style"), "width")

    def outputs(self) -> DataFrame:
        return self._of("output", "target")

    def actions(self, state: str | None = None) -> DataFrame:
        a = self._of("action", "target")
        return a if state is None else a.where(F.col("role") == state)

    def quality(self) -> DataFrame:
        return self.fsms().select(*KEY, "status", F.col("role").alias("quality"))

    def reachability(self) -> DataFrame:
        return self.states().select(*KEY, "name", F.col("status").alias("reachability"))

    def couplings(self) -> DataFrame:
        return self._of("coupling", "name")

    def rejected(self) -> DataFrame:
        return self._of("rejected", "name")
