"""Running values along groups of any size, in two passes.

The rows are put in order by ranges of (group, order), so a group that holds a third of
all rows covers many tasks. Pass 1 runs along each task's rows and stores its running values; the
last row of each task, one row per task, tells what the next task has to add. Pass 2 adds that
to the rows of a task's first group. No group is collected and no window is opened over one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.memory import freeing
from lakeweir.llm.storage import Workspace

TIE = "__tie"


def run_along(groups: int, sums: int, xors: int, lags: int) -> Callable:
    """From rows in order (groups, sums, xors, lags, others): the same rows with running values.

    Values restart where a group begins, and at the start of the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, row = TaskContext.get().partitionId(), 0
        last_group = None
        place = 0
        carry = [0] * (sums + xors)
        lag = [0] * lags
        head = True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns[: groups + sums + xors + lags]]
            new = np.zeros(n, bool)
            for c in columns[:groups]:
                new[1:] |= c[1:] != c[:-1]
            first = tuple(int(c[0]) for c in columns[:groups])
            new[0] = first != last_group
            if new[0] and last_group is not None:
                head = False
            starts = np.flatnonzero(new)
            at = np.arange(n)
            begin = np.full(n, -1)
            begin[starts] = starts
            begin = np.maximum.accumulate(begin)
            going = begin < 0  # rows of the group the batch before ended with
            places = np.where(going, place + at, at - begin)
            out = [places]
            for k in range(sums):
                total = np.cumsum(columns[groups + k])
                base = np.where(going, -carry[k], (total - columns[groups + k])[np.maximum(begin, 0)])
                out.append(total - base)
            for k in range(sums, sums + xors):
                total = np.bitwise_xor.accumulate(columns[groups + k])
                base = np.where(going, carry[k], (total ^ columns[groups + k])[np.maximum(begin, 0)])
                out.append(total ^ base)
            arrays = [pa.array(o) for o in out]
            for k in range(lags):
                own = columns[groups + sums + xors + k]
                before = np.concatenate([[lag[k]], own[:-1]])
                arrays.append(pa.array(before, mask=new))
                lag[k] = int(own[-1])
            heads = np.full(n, head)
            if len(starts) and head:
                later = starts if last_group is not None else starts[1:]
                if len(later):
                    heads[later[0] :] = False
                    head = False
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(np.full(n, task, np.int32)),
                    pa.array(row + at),
                    pa.array(heads),
                    *arrays,
                ],
                names=[*batch.schema.names, "__task", "__row", "__head", "place",
                       *(f"__run{k}" for k in range(sums + xors)),
                       *(f"__lag{k}" for k in range(lags))],
            )
            row += n
            place = int(places[-1]) + 1
            carry = [int(o[-1]) for o in out[1:]]
            last_group = tuple(int(c[-1]) for c in columns[:groups])

    return freeing(run)


def carries(ends: list, groups: int, sums: int, xors: int, lags: int) -> list[tuple]:
    """What the rows of each task's first group have to add, from the tasks' last rows.

    ``ends`` is sorted by task: (task, rows, first group, last group, last place, last running
    values, last own values of lags, whether the last row belongs to the first group).
    """
    out: list[tuple] = []
    before, offset = None, 0
    for task, rows, first, last, place, running, own, single in ends:
        adds, lag = [0] * (1 + sums + xors), [None] * lags
        if before is not None and before[0] == first:
            adds, lag = list(before[1]), list(before[2])
        out.append((task, offset, *adds, *lag))
        offset += rows
        total = [place + 1, *running]
        if single:
            total[: 1 + sums] = [a + b for a, b in zip(total, adds[: 1 + sums])]
            total[1 + sums :] = [a ^ b for a, b in zip(total[1 + sums :], adds[1 + sums :])]
        before = (last, total, own)
    return out


def scanned(
    rows: DataFrame,
    work: Workspace,
    group: Sequence[str],
    order: Sequence[str],
    sums: Sequence[str] = (),
    xors: Sequence[str] = (),
    lags: Sequence[str] = (),
) -> DataFrame:
    """``rows`` with values that run along each group in ascending ``order``, nulls first.

    ``index`` numbers all rows from 0, ``place`` those of a group. ``sum_x`` and ``xor_x`` hold the
    sum and the exclusive or of ``x`` up to the row itself, ``lag_x`` the value of the row before
    in the group, or null. Groups and values must be longs without nulls. Rows equal in group and
    order come in any, but one, order.
    """
    used = [*group, *sums, *xors, *lags]
    spare = [c for c in rows.columns if c not in used]
    names = dict.fromkeys(used)
    rows = rows.withColumn(TIE, F.monotonically_increasing_id())
    # A column may be used twice, so each use gets its own.
    picked = [F.col(name).alias(f"__in{k}") for k, name in enumerate(used)]
    keys = [F.col(name).asc_nulls_first() for name in dict.fromkeys([*group, *order])]
    dealt = rows.repartitionByRange(*keys, F.col(TIE)).sortWithinPartitions(*keys, F.col(TIE))
    dealt = dealt.select(*picked, *names, *spare)
    g, s, x, n = len(group), len(sums), len(xors), len(lags)
    ddl = [f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields]
    ddl += ["__task int", "__row bigint", "__head boolean", "place bigint"]
    ddl += [f"__run{k} bigint" for k in range(s + x)] + [f"__lag{k} bigint" for k in range(n)]
    stored = work.store(dealt.mapInArrow(run_along(g, s, x, n), ", ".join(ddl)), "running")

    def listed(columns: list[str]) -> F.Column:
        return F.array(*map(F.col, columns)).cast("array<bigint>")

    groups = listed([f"__in{k}" for k in range(g)])
    running = listed([f"__run{k}" for k in range(s + x)])
    own = listed([f"__in{g + s + x + k}" for k in range(n)])
    end = F.struct(groups.alias("g"), "place", running.alias("r"), own.alias("o"), "__head")
    summary = (
        stored.groupBy("__task")
        .agg(
            F.count("*").alias("rows"),
            F.min_by(groups, "__row").alias("first"),
            F.max_by(end, "__row").alias("end"),
        )
        .collect()
    )
    ends = [
        (r["__task"], r["rows"], r["first"], e["g"], e["place"], e["r"], e["o"], e["__head"])
        for r in sorted(summary, key=lambda r: r["__task"])
        for e in [r["end"]]
    ]
    schema = ["c_task int", "c_offset bigint", "c_place bigint"]
    schema += [f"c_run{k} bigint" for k in range(s + x)] + [f"c_lag{k} bigint" for k in range(n)]
    adds = rows.sparkSession.createDataFrame(carries(ends, g, s, x, n), ", ".join(schema))
    joined = stored.join(F.broadcast(adds), F.col("__task") == F.col("c_task"))

    def added(name: str) -> F.Column:
        return F.when(F.col("__head"), F.col(f"c_{name}")).otherwise(F.lit(0).cast("bigint"))

    out = [(F.col("c_offset") + F.col("__row")).alias("index")]
    out.append((F.col("place") + added("place")).alias("place"))
    for k, name in enumerate(sums):
        out.append((F.col(f"__run{k}") + added(f"run{k}")).alias(f"sum_{name}"))
    for k, name in enumerate(xors, s):
        out.append(F.col(f"__run{k}").bitwiseXOR(added(f"run{k}")).alias(f"xor_{name}"))
    for k, name in enumerate(lags):
        carried = F.when(F.col("__head"), F.col(f"c_lag{k}"))
        out.append(F.coalesce(F.col(f"__lag{k}"), carried).alias(f"lag_{name}"))
    return joined.select(*names, *spare, *out)
