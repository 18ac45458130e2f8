"""Funnel levels from states that merge, so that parts of a key's events may arrive in any cut.

Two states, both sums of parts:

* ``cells``: per key and minute one bit per second and step.  Merging is a bitwise OR,
  so parts may overlap in time, come in any order and come twice.
* ``summaries``: per key and period (a day, say) a fixed number of times: of the
  chains that start inside, the latest start that reached each step; and of
  the pieces that continue a chain, the earliest end of each run of steps.  Two
  neighbouring periods combine into the summary of both, which is associative.
  A period can be summarised once its cells are complete; the cells may then go.

Levels are those of ``operators.funnel.window_funnel``: the window runs from the
first step, its bound is inclusive, equal seconds count as ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from marketlane.functions.dates import epoch_seconds

CELL_SECONDS = 60
DAY_CELLS = 86400 // CELL_SECONDS


def masks(n: int) -> list[str]:
    return [f"s{i}" for i in range(n)]


def cells(events: DataFrame, key: Sequence[str], ts: str, steps: Sequence[Column], *by: str) -> DataFrame:
    """``key, cell, s0, s1, ...``: the seconds of each minute at which each step happened.

    Keys of events that are no step keep a cell without bits, which is level 0.
    ``by`` keeps partial rows apart.
    """
    flags = {f"_f{i}": F.coalesce(s, F.lit(False)) for i, s in enumerate(steps)}
    timed = events.select(*key, *by, epoch_seconds(ts).alias("_sec"), *[c.alias(f) for f, c in flags.items()])
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("_sec", F.lit(CELL_SECONDS)).cast("int"))
    seen = [F.bit_or(F.when(F.col(f), bit).otherwise(F.lit(0).cast("bigint"))).alias(m) for f, m in zip(flags, masks(len(flags)))]
    return timed.groupBy(*key, F.floor(F.col("_sec") / CELL_SECONDS).alias("cell"), *by).agg(*seen)


def merge_cells(parts: DataFrame, key: Sequence[str], n: int) -> DataFrame:
    """One row per key and cell from any number of partial rows."""
    return parts.groupBy(*key, "cell").agg(*[F.bit_or(m).alias(m) for m in masks(n)])


def _starts(n: int) -> list[str]:
    """Latest start among chains that reached step ``j``."""
    return [f"start{j}" for j in range(n)]


def _ends(n: int) -> list[str]:
    """Earliest end of steps ``i`` to ``j`` one after the other, for chains that began before."""
    return [f"end{i}_{j}" for i in range(1, n) for j in range(i, n)]


def _state(values: dict[str, Column]) -> Column:
    return F.struct(*[v.cast("bigint").alias(k) for k, v in values.items()])


def _empty(n: int) -> Column:
    return _state({f: F.lit(None) for f in (*_starts(n), *_ends(n))})


def _add(n: int, window: int):
    """One second at which one step happened; seconds come in order, steps of a second too."""

    def add(a: Column, x: Column) -> Column:
        out = {}
        for j in range(n):
            begun = x["sec"] if j == 0 else F.when(x["sec"] <= a[f"start{j - 1}"] + window, a[f"start{j - 1}"])
            out[f"start{j}"] = F.when(x["step"] == j, F.greatest(a[f"start{j}"], begun)).otherwise(a[f"start{j}"])
        for i in range(1, n):
            for j in range(i, n):
                ended = x["sec"] if i == j else F.when(a[f"end{i}_{j - 1}"].isNotNull(), x["sec"])
                own = a[f"end{i}_{j}"]
                out[f"end{i}_{j}"] = F.when(x["step"] == j, F.coalesce(own, ended)).otherwise(own)
        return _state(out)

    return add


def _join(n: int, window: int):
    """Summary of a period and the one after it."""

    def join(a: Column, b: Column) -> Column:
        out = {}
        for j in range(n):
            across = [F.when(b[f"end{i + 1}_{j}"] <= a[f"start{i}"] + window, a[f"start{i}"]) for i in range(j)]
            out[f"start{j}"] = F.greatest(a[f"start{j}"], b[f"start{j}"], *across)
        for i in range(1, n):
            for j in range(i, n):
                across = [F.when(a[f"end{i}_{k}"].isNotNull(), b[f"end{k + 1}_{j}"]) for k in range(i, j)]
                out[f"end{i}_{j}"] = F.least(a[f"end{i}_{j}"], b[f"end{i}_{j}"], *across)
        return _state(out)

    return join


def summaries(parts: DataFrame, key: Sequence[str], n: int, window_seconds: int, period_cells: int = DAY_CELLS) -> DataFrame:
    """``key, period, start0, ..., end1_1, ...`` from cells that are complete for each period.

    A group is the cells of one key and period, at most ``period_cells`` however many events there were.
    """
    names = masks(n)
    merged = merge_cells(parts, key, n).withColumn("period", F.floor(F.col("cell") / period_cells))
    rows = merged.groupBy(*key, "period").agg(F.array_sort(F.collect_list(F.struct("cell", *names))).alias("_cells"))

    def happened(c: Column) -> Column:
        """Seconds and steps of a cell in order; most cells have a single second, which needs no search."""
        some = c[names[0]]
        for m in names[1:]:
            some = some.bitwiseOR(c[m])
        bits = F.bit_count(some)
        searched = F.filter(F.sequence(F.lit(0), F.lit(CELL_SECONDS - 1)), lambda b: F.bit_get(some, b) == 1)
        single = F.array(F.round(F.log2(some.cast("double"))).cast("int"))
        seconds = F.when(bits == 1, single).when(bits == 0, F.array().cast("array<int>")).otherwise(searched)

        def steps_at(b: Column) -> Column:
            each = F.array(*[F.struct((c["cell"] * CELL_SECONDS + b).alias("sec"), F.lit(i).alias("step"), F.bit_get(c[m], b).alias("on")) for i, m in enumerate(names)])
            return F.filter(each, lambda x: x["on"] == 1)

        return F.flatten(F.transform(seconds, steps_at))

    found = F.aggregate(F.flatten(F.transform("_cells", happened)), _empty(n), _add(n, window_seconds))
    return rows.select(*key, "period", found.alias("_s")).select(*key, "period", "_s.*")


def combine(parts: DataFrame, key: Sequence[str], n: int, window_seconds: int) -> DataFrame:
    """One summary per key over all its periods, in their order; ``period`` is that of the first."""
    fields = (*_starts(n), *_ends(n))
    ordered = F.array_sort(F.collect_list(F.struct("period", F.struct(*fields).alias("s"))))
    rows = parts.groupBy(*key).agg(ordered.alias("_p"))
    joined = F.aggregate(F.transform("_p", lambda p: p["s"]), _empty(n), _join(n, window_seconds))
    return rows.select(*key, F.get("_p", 0)["period"].alias("period"), joined.alias("_s")).select(*key, "period", "_s.*")


def level(n: int) -> Column:
    """Steps reached, of a summary."""
    case = F.lit(0)
    for j, name in enumerate(_starts(n)):
        case = F.when(F.col(name).isNotNull(), j + 1).otherwise(case)
    return case


def levels(parts: DataFrame, key: Sequence[str], n: int, window_seconds: int, out: str = "level", period_cells: int = DAY_CELLS) -> DataFrame:
    """Per key the steps reached, from partial cells."""
    whole = combine(summaries(parts, key, n, window_seconds, period_cells), key, n, window_seconds)
    return whole.select(*key, level(n).alias(out))
