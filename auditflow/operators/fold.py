"""State machines over ordered events of a key.

Each event moves some states to others and leaves the rest alone, so the events of
one range compose into one small map.  A key with very many events is cut into
ranges: every range yields its map, the maps give each range its start state, and
all ranges replay in parallel.  Rows stream through sorted partitions; no group is
gathered in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditflow.operators import ranges


class Machine:
    """A machine has a start state, the event columns it reads, and its moves.

    ``moves(event)`` gives exact moves as a dict, and optionally one class move
    ``(class, target, exempt)``: all states of the class go to the target but for
    the exempt ones.  The class of a state is the text before its first ``|``.
    """

    start = ""
    columns: list[str] = []

    def moves(self, event: tuple) -> tuple[dict, tuple | None]:
        raise NotImplementedError

    def step(self, state: str, event: tuple) -> str | None:
        """Next state, or None if the event does not apply."""
        exact, broad = self.moves(event)
        if state in exact:
            return exact[state]
        if broad and state.partition("|")[0] == broad[0] and state not in broad[2]:
            return broad[1]
        return None


class Composed:
    """Map of a run of events, built from the last event to the first."""

    def __init__(self):
        self.exact: dict[str, str] = {}
        self.broad: dict[str, str] = {}
        self.by_class: dict[str, set[str]] = {}

    def end(self, state: str) -> str:
        if state in self.exact:
            return self.exact[state]
        return self.broad.get(state.partition("|")[0], state)

    def _put(self, state: str, target: str) -> None:
        self.exact[state] = target
        self.by_class.setdefault(state.partition("|")[0], set()).add(state)

    def prepend(self, exact: dict, broad: tuple | None) -> None:
        ends = {a: self.end(b) for a, b in exact.items()}
        if broad:
            name, target, exempt = broad
            target_end = self.end(target)
            kept = {s: self.end(s) for s in exempt}
            for state in self.by_class.pop(name, ()):
                self.exact.pop(state, None)
            self.broad[name] = target_end
            for state, end in kept.items():
                self._put(state, end)
        for state, end in ends.items():
            self._put(state, end)

    def entries(self) -> list[tuple[str, str]]:
        return list(self.exact.items()) + [(f"{c}|*", t) for c, t in self.broad.items()]


def _events(pdf: pd.DataFrame, columns: list[str]) -> list[tuple]:
    cleaned = [[None if v is None or v != v else v for v in pdf[c].tolist()] for c in columns]
    return list(zip(*cleaned)) if cleaned else [()] * len(pdf)


def _summarise(machine: Machine):
    columns = ["_key", "_range", "kind", "from_state", "to_state"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, composed, made, out = None, None, set(), []

        def flush():
            out.extend((*current, "entry", a, b) for a, b in composed.entries())
            out.extend([(*current, "made", s, s) for s in made] or [(*current, "made", "", "")])

        for pdf in batches:
            keys = list(zip(pdf["_key"].tolist(), pdf["_range"].tolist()))
            for key, event in zip(keys, _events(pdf, machine.columns)):
                if key != current:
                    if current is not None:
                        flush()
                    current, composed, made = key, Composed(), set()
                exact, broad = machine.moves(event)
                composed.prepend(exact, broad)
                made.update(exact.values())
                if broad:
                    made.add(broad[1])
            yield pd.DataFrame(out, columns=columns)
            out.clear()
        if current is not None:
            flush()
            yield pd.DataFrame(out, columns=columns)

    return run


def _carry(start: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = rng = None
        state, entries, out = start, {}, []

        def close():
            nonlocal state
            if state in entries:
                state = entries[state]
            else:
                state = entries.get(f"{state.partition('|')[0]}|*", state)

        for pdf in batches:
            for k, r, a, b in zip(*[pdf[c].tolist() for c in ("_key", "_range", "from_state", "to_state")]):
                if (k, r) != (key, rng):
                    if key is not None:
                        close()
                    if k != key:
                        state = start
                    key, rng, entries = k, r, {}
                    out.append((k, r, state))
                if a:
                    entries[a] = b
            yield pd.DataFrame(out, columns=["_key", "_range", "_start"])
            out = []

    return run


def _replay(machine: Machine):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = None, None
        for pdf in batches:
            before, after, accepted = [], [], []
            keys = zip(pdf["_key"].tolist(), pdf["_range"].tolist(), pdf["_start"].tolist())
            for (key, rng, start), event in zip(keys, _events(pdf, machine.columns)):
                if (key, rng) != current:
                    current, state = (key, rng), start
                before.append(state)
                target = machine.step(state, event)
                accepted.append(target is not None)
                state = state if target is None else target
                after.append(state)
            yield pdf.drop(columns=["_key", "_range", "_start"]).assign(
                state_before=before, state_after=after, accepted=accepted)

    return run


def fold_events(events: DataFrame, key: str, order: list[str], machine: Machine) -> DataFrame:
    """Events with ``state_before``, ``state_after`` and ``accepted``.

    ``order`` must be a total order of the events of a key, its first column
    numeric or a timestamp.
    """
    cut, split = ranges.split_hot(events, [key], order)
    cut = cut.withColumn("_key", F.col(key).cast("string"))
    if split:
        hot = cut.where("_range > 0").select("_key", "_range", *{*machine.columns, *order})
        backwards = [F.col(c).desc() for c in order]
        maps = hot.repartition("_key", "_range").sortWithinPartitions("_key", "_range", *backwards).mapInPandas(
            _summarise(machine), "_key string, _range int, kind string, from_state string, to_state string")
        # An entry matters only if an earlier range can produce its state.
        made = maps.where("kind = 'made'")
        reach = made.groupBy("_key", F.col("to_state").alias("from_state")).agg(F.min("_range").alias("_first"))
        entries = maps.where("kind = 'entry'")
        known = entries.join(reach, ["_key", "from_state"]).where("_first < _range").drop("_first")
        always = entries.where((F.col("from_state") == machine.start) | F.col("from_state").endswith("|*"))
        every = made.select("_key", "_range").distinct().withColumns({"from_state": F.lit(""), "to_state": F.lit("")})
        steps = every.unionByName(known.unionByName(always).select("_key", "_range", "from_state", "to_state").distinct())
        starts = steps.repartition("_key").sortWithinPartitions("_key", "_range").mapInPandas(
            _carry(machine.start), "_key string, _range int, _start string")
        cut = cut.join(starts, ["_key", "_range"], "left").withColumn("_start", F.coalesce("_start", F.lit(machine.start)))
    else:
        cut = cut.withColumn("_start", F.lit(machine.start))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in events.schema.fields)
    ordered = cut.select(*events.columns, "_key", "_range", "_start").repartition("_key", "_range").sortWithinPartitions(
        "_key", "_range", *order)
    return ordered.mapInPandas(_replay(machine), f"{schema}, state_before string, state_after string, accepted boolean")
