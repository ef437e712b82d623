"""A user's own aggregators: any mergeable fold over the rows of a key.

A :class:`Fold` says how rows become partial states (``step``), how states of a key are merged
(``merge``) and what a state says in the end (``finish``). Each works on a whole pandas frame
with many keys at once; :func:`of_records` makes one of plain functions of one record.

Every Arrow batch of the input gives one state per key in it. States are merged in two levels,
first by key and a salt, then by key, so a key that holds most of the rows is merged by many
tasks; a task reads its states in the order of the keys, one Arrow batch at a time, and holds no
more than that and the state of the key at hand. So ``merge`` has to be associative and must not
depend on the order, as with any distributed aggregate.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rillflow.operators.tables import keyed

#: Tasks that merge the states of one key in the first level.
SALTS = 64


@dataclass(frozen=True)
class Fold:
    """``step(rows, keys)`` and ``merge(states, keys)`` give one state per key: a frame of the key columns
    and the ``state`` columns (DDL). ``finish(states)`` turns state columns into the ``result``
    columns (DDL), row by row; the key columns stay."""

    state: str
    step: Callable[[pd.DataFrame, list[str]], pd.DataFrame]
    merge: Callable[[pd.DataFrame, list[str]], pd.DataFrame]
    result: str
    finish: Callable[[pd.DataFrame], pd.DataFrame]


def of_records(init: Callable[[], tuple], step: Callable[[tuple, tuple], tuple], merge: Callable[[tuple, tuple], tuple],
               finish: Callable[[tuple], tuple], columns: list[str], state: str, result: str) -> Fold:
    """A fold from functions of one record: ``step(state, record)`` with the record's ``columns``,
    ``merge(state, state)``, ``finish(state)``; states and results are tuples of their columns. For
    functions that work on no frame; a call per record."""
    states, results = _names(state), _names(result)

    def records(frame: pd.DataFrame, names: list[str]) -> Iterator[tuple]:
        return zip(*(frame[c].astype(object).where(frame[c].notna(), None) for c in names))

    def each(frame: pd.DataFrame, keys: list[str], names: list[str], first: Callable[[tuple], tuple],
             more: Callable[[tuple, tuple], tuple]) -> pd.DataFrame:
        """One pass over the records, each added to its key's state: no frame is made per key."""
        of = frame.groupby(keys, sort=False).ngroup().to_numpy()
        folded: dict[int, tuple] = {}
        for key, record in zip(of.tolist(), records(frame, names)):
            folded[key] = more(folded[key], record) if key in folded else first(record)
        folded.pop(-1, None)  # no key
        numbers, at = np.unique(of, return_index=True)
        heads = frame[keys].iloc[at[numbers >= 0]].reset_index(drop=True)
        return pd.concat([heads, pd.DataFrame([folded[k] for k in numbers[numbers >= 0].tolist()], columns=states)], axis=1)

    def stepped(rows: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
        return each(rows, keys, columns, lambda record: step(init(), record), step)

    def merged(rows: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
        return each(rows, keys, states, lambda state: state, merge)

    def finished(frame: pd.DataFrame) -> pd.DataFrame:
        done = [finish(s) for s in records(frame, states)]
        return pd.concat([frame.drop(columns=states).reset_index(drop=True), pd.DataFrame(done, columns=results)], axis=1)

    return Fold(state, stepped, merged, result, finished)


def _names(ddl: str) -> list[str]:
    """The column names of ``name type, ...``, without a session."""
    flat = ddl
    while flat != (flat := re.sub(r"<[^<>]*>|\([^()]*\)", "", flat)):
        pass
    return [c.split()[0].strip("`") for c in flat.split(",")]


def state_schema(df: DataFrame, keys: list[str], fold: Fold) -> T.StructType:
    return T.StructType([*(df.schema[k] for k in keys), *T.StructType.fromDDL(fold.state)])


def partial_states(df: DataFrame, keys: list[str], fold: Fold) -> DataFrame:
    """A state for each key of each Arrow batch of ``df``, and a ``__salt`` by its task. Rows without a
    key are skipped, as a keyed grouping skips them."""
    schema = state_schema(df, keys, fold)
    names = schema.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        salt = TaskContext.get().partitionId() % SALTS
        for rows in batches:
            if len(rows):
                yield fold.step(rows, keys)[names].assign(__salt=salt)

    return keyed(df, *keys).mapInPandas(run, T.StructType([*schema.fields, T.StructField("__salt", T.IntegerType())]))


def merge_states(states: DataFrame, keys: list[str], fold: Fold) -> DataFrame:
    """One state per key. Tasks read their states in the order of the keys and hold one Arrow batch
    and the state of the key at hand."""
    schema = states.schema
    names = schema.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the state so far of the last key, whose rows may go on in the next batch
        for rows in batches:
            if not len(rows):
                continue
            rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
            open_key = (rows[keys] == rows[keys].iloc[-1]).all(axis=1)
            if not open_key.all():
                yield fold.merge(rows[~open_key], keys)[names]
            held = fold.merge(rows[open_key], keys)[names]
        if held is not None:
            yield held

    return states.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def fold_states(df: DataFrame, keys: list[str], fold: Fold) -> DataFrame:
    """One state for each key of ``df``, merged in two levels."""
    salted = merge_states(partial_states(df, keys, fold), [*keys, "__salt"], fold)
    return merge_states(salted.drop("__salt"), keys, fold)


def finish_states(states: DataFrame, keys: list[str], fold: Fold) -> DataFrame:
    """The results of states."""
    schema = T.StructType([*(states.schema[k] for k in keys), *T.StructType.fromDDL(fold.result)])
    names = schema.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                yield fold.finish(rows)[names]

    return states.mapInPandas(run, schema)


def fold_by(df: DataFrame, key: str | list[str], fold: Fold) -> DataFrame:
    """``df`` folded per key: the key columns and the fold's result columns."""
    keys = [key] if isinstance(key, str) else list(key)
    return finish_states(fold_states(df, keys, fold), keys, fold)
