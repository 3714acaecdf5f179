"""User aggregates: zero, update, merge and finish over rows in any order.

:class:`Aggregator` is what a user writes; :func:`aggregate` runs it per key.
Each task updates one state per key over its Arrow batches and emits the states
as binary rows. The states of a key are then merged in a tree: first those of
the tasks that share a salt, at last the ``fan_in`` results, one state of a key
at a time. So a key that holds most of the rows costs no task more than its share
of the states, and no row is moved. :func:`reduce_by` is the short form for an
associative function of two values.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of states that a task holds at once, and keys at most.
HELD_BYTES, HELD_KEYS = 64 << 20, 100_000
FAN_IN = 32


class Aggregator:
    """A user aggregate. ``schema`` names its result columns, ``state_bytes`` bounds
    a packed state (a larger one raises)."""

    schema = "value double"
    state_bytes = 1 << 16

    def zero(self) -> Any:
        """The state of no rows."""
        raise NotImplementedError

    def update(self, state: Any, rows: pa.RecordBatch) -> Any:
        """The state with the rows of one key added; the batch has the columns asked for."""
        raise NotImplementedError

    def merge(self, a: Any, b: Any) -> Any:
        """The state of the rows of both; must not depend on the order."""
        raise NotImplementedError

    def finish(self, state: Any) -> tuple:
        """The result's columns."""
        raise NotImplementedError

    def dump(self, state: Any) -> bytes:
        return pickle.dumps(state, 5)

    def load(self, data: bytes) -> Any:
        return pickle.loads(data)

    def packed(self, state: Any) -> bytes:
        data = self.dump(state)
        if len(data) > self.state_bytes:
            raise ValueError(f"a state of {len(data)} bytes is larger than state_bytes={self.state_bytes}")
        return data


class Reduce(Aggregator):
    """``fn`` over the values of one column: a batch's values are folded pairwise,
    nulls are skipped, and no value gives null."""

    def __init__(self, fn: Callable[[Any, Any], Any], result: str):
        self.fn, self.schema = fn, f"value {result}"

    def zero(self):
        return None

    def update(self, state, rows):
        for v in rows.column(0).to_pylist():
            state = v if state is None else state if v is None else self.fn(state, v)
        return state

    def merge(self, a, b):
        return b if a is None else a if b is None else self.fn(a, b)

    def finish(self, state):
        return (state,)


def _groups(batch: pa.RecordBatch, keys: int):
    """(key tuple, rows without the keys) of each key in a batch."""
    names = batch.schema.names[keys:]
    rest = pa.RecordBatch.from_arrays(batch.columns[keys:], names=names)
    if not keys:
        yield (), rest
        return
    code, parts = np.zeros(batch.num_rows, np.int64), []
    for column in batch.columns[:keys]:
        d = column.dictionary_encode(null_encoding="encode")
        parts.append(d)
        code = code * len(d.dictionary) + d.indices.to_numpy()
    order = np.argsort(code, kind="stable")
    starts = np.flatnonzero(np.diff(code[order], prepend=-1))
    rest = rest.take(pa.array(order))
    for s, e in zip(starts, np.append(starts[1:], len(order)), strict=True):
        at = int(order[s])
        yield tuple(d.dictionary[d.indices[at].as_py()].as_py() for d in parts), rest.slice(s, e - s)


def aggregate(df: DataFrame, agg: Aggregator, columns: list[str], by: list[str] | None = None,
              fan_in: int = FAN_IN) -> DataFrame:
    """``by`` columns and the result columns of ``agg`` over ``columns``, a row per
    key (one row without keys; no rows give none). A null key is a key."""
    from pyspark.sql.pandas.types import to_arrow_type
    by = by or []
    result = T._parse_datatype_string(agg.schema)
    keys = [T.StructField(f"k{i}", df.schema[c].dataType) for i, c in enumerate(by)]
    kinds = [to_arrow_type(f.dataType) for f in keys]
    names = [f.name for f in keys]
    held_keys = int(np.clip(HELD_BYTES // agg.state_bytes, 1, HELD_KEYS))

    def rows_of(pairs):
        return pa.RecordBatch.from_arrays(
            [*(pa.array([k[i] for k, _ in pairs], t) for i, t in enumerate(kinds)),
             pa.array([agg.packed(s) for _, s in pairs], pa.binary())], names=[*names, "state"])

    def partial(batches):
        held: dict[tuple, Any] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            for key, rows in _groups(batch, len(keys)):
                held[key] = agg.update(held[key] if key in held else agg.zero(), rows)
                if len(held) > held_keys:
                    yield rows_of(list(held.items()))
                    held.clear()
        if held:
            yield rows_of(list(held.items()))

    def merged(batches):
        """(key, state) of rows sorted by key, one key at a time."""
        key, state = None, None
        for batch in batches:
            keyed = [batch.column(i).to_pylist() for i in range(len(keys))]
            for i in range(batch.num_rows):
                k, s = tuple(c[i] for c in keyed), agg.load(batch.column(len(keys))[i].as_py())
                if k == key:
                    state = agg.merge(state, s)
                    continue
                if key is not None:
                    yield key, state
                key, state = k, s
        if key is not None:
            yield key, state

    def halfway(batches):
        for pair in merged(batches):
            yield rows_of([pair])

    def finished(batches):
        for k, s in merged(batches):
            values = (*k, *agg.finish(s))
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, kinds + [to_arrow_type(f.dataType) for f in result], strict=True)],
                names=names + [f.name for f in result])

    states = T.StructType([*keys, T.StructField("state", T.BinaryType())])
    source = df.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(by, names, strict=True)), *(F.col(f"`{c}`") for c in columns))
    found = source.mapInArrow(partial, states).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(fan_in)))
    order = [F.col(n) for n in names]
    found = found.repartition(*order, "salt").sortWithinPartitions(*order, "salt").select(*names, "state")
    found = found.mapInArrow(halfway, states)
    found = found.repartition(*order).sortWithinPartitions(*order) if names else found.coalesce(1)
    out = found.mapInArrow(finished, T.StructType([*keys, *result.fields]))
    return out.select(*(F.col(n).alias(c) for c, n in zip(by, names, strict=True)), *(f"`{f.name}`" for f in result))


def reduce_by(df: DataFrame, column: str, fn: Callable[[Any, Any], Any], by: list[str] | None = None,
              result: str | None = None) -> DataFrame:
    """``by`` columns and ``value``: ``column`` folded by an associative and commutative
    ``fn``. ``result`` is its type, that of the column if not given."""
    return aggregate(df, Reduce(fn, result or df.schema[column].dataType.simpleString()), [column], by)
