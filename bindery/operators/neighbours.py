"""Distances between neighbouring annotations, without one task for a chromosome.

Annotations are dealt into ranges of their order. Inside a range a window gives the neighbour; at its edges the neighbour is looked
up in a table of one row for each range and sequence, over which a second, short window runs.

The sequential filter, in which a row looks back at surviving rows only, is a scan whose state is the end of the last survivor.
A range maps the state that comes in to the one that goes out. That map depends on the first row that survives alone, and
only rows near the range's beginning can be it: those that begin within `minimum` of the furthest end before the
range. So each range gives a short table of these rows and of the state that follows from each; tables are composed along a
sequence, and each range is then scanned with the state that comes in.
"""

from __future__ import annotations

from bisect import bisect_left

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bindery.operators.lineage import cut

#: Rows of a range.
EACH = 100_000
ORDER = ("start_pos", "end_pos", "annot_id")
#: The state before any row has survived.
NONE = -(1 << 62)


def _ranges(annots: DataFrame, ranges: int | None) -> DataFrame:
    """Annotations with `_range`, the number of the range of the order that they lie in."""
    order = ["seqid", *ORDER]
    n = ranges or max(8, -(-annots.count() // EACH))
    return cut(annots.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()))


def _keep(distance: Column, minimum: int, maximum: int = 0) -> Column:
    keep = distance.isNull() | (distance == 0) | (distance >= minimum)
    return keep & (distance.isNull() | (distance <= maximum)) if maximum else keep


def next_distance(annots: DataFrame, minimum: int, maximum: int = 0, opposite: bool = False, ranges: int | None = None) -> DataFrame:
    """Annotations with `distance` to the next on their strand (downstream), or with `opposite` on the other one, null
    for the last, at least `minimum` away and at most `maximum` (0: no bound). A distance of 0 passes. Every strand but + counts as -."""
    rows = _ranges(annots, ranges)
    plus = F.col("strand") == "+"
    # A + row looks ahead for a start, a - row back for an end, of the strand that each asks for.
    ahead_of = F.when(~plus if opposite else plus, F.col("start_pos"))
    behind_of = F.when(plus if opposite else ~plus, F.col("end_pos"))
    inside = Window.partitionBy("seqid", "_range")
    forward, backward = inside.orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1), inside.orderBy(*[F.col(c).desc() for c in ORDER]).rowsBetween(Window.unboundedPreceding, -1)
    seen = rows.withColumns({"_next": F.last(ahead_of, ignorenulls=True).over(backward), "_before": F.last(behind_of, ignorenulls=True).over(forward)})
    key = F.struct(*ORDER)
    edges = rows.groupBy("seqid", "_range").agg(F.min(F.when(ahead_of.isNotNull(), key))["start_pos"].alias("_first"), F.max(F.when(behind_of.isNotNull(), key))["end_pos"].alias("_last"))
    along = Window.partitionBy("seqid")  # one row a range
    later, earlier = along.orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1), along.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select("seqid", "_range", F.last("_first", ignorenulls=True).over(later).alias("_later"), F.last("_last", ignorenulls=True).over(earlier).alias("_earlier"))
    known = seen.join(edges, ["seqid", "_range"], "left")
    distance = F.when(plus, F.coalesce("_next", "_later") - F.col("end_pos")).otherwise(F.col("start_pos") - F.coalesce("_before", "_earlier"))
    return known.withColumn("distance", distance).where(_keep(F.col("distance"), minimum, maximum)).select(*annots.columns, "distance")


def next_survivor(starts: list[int], state: int, minimum: int, after: int = 0) -> int:
    """Place, not before `after`, of the first row that survives if the last survivor ended at `state`; the number of rows if none does."""
    far = max(bisect_left(starts, state + minimum), after)
    same = max(bisect_left(starts, state), after)
    return min(far, same) if same < len(starts) and starts[same] == state else far


def transitions(starts: list[int], ends: list[int], minimum: int, reach: int) -> tuple[list[int], list[int]]:
    """The rows of a range that can be its first survivor after an end of at most `reach`: their starts, and the state that goes out
    if it is they. One pass from the last row to the first."""
    out = [0] * len(starts)
    for i in range(len(starts) - 1, -1, -1):
        k = next_survivor(starts, ends[i], minimum, i + 1)
        out[i] = out[k] if k < len(starts) else ends[i]
    near = min(bisect_left(starts, reach + minimum) + 1, len(starts))
    return starts[:near], out[:near]


def next_distance_exact(annots: DataFrame, minimum: int, ranges: int | None = None) -> DataFrame:
    """The sequential form: a row on + looks ahead at the next one; a row on another strand looks back at surviving rows only, and
    the first of a sequence stays. Rows whose distance is under `minimum`, and not 0, go, and so do rows without sequence or strand."""
    rows = _ranges(annots, ranges)
    plus = F.col("strand") == "+"
    ahead = next_distance(annots.where(plus), minimum, ranges=ranges).drop("distance")
    back = rows.where(~plus)
    keys = ["seqid", "strand", "_range"]
    edges = back.groupBy(*keys).agg(F.max("end_pos").alias("_end"))
    along = Window.partitionBy("seqid", "strand").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    reach = edges.select(*keys, F.coalesce(F.max("_end").over(along), F.lit(NONE)).alias("_reach"))

    def table(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(ORDER))
        starts, out = transitions(pdf["start_pos"].tolist(), pdf["end_pos"].tolist(), minimum, int(pdf["_reach"].iloc[0]))
        return pd.DataFrame({"seqid": [pdf["seqid"].iloc[0]], "strand": [pdf["strand"].iloc[0]], "_range": [pdf["_range"].iloc[0]], "starts": [starts], "out": [out]})

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        state, states = NONE, []
        pdf = pdf.sort_values("_range")
        for starts, out in zip(pdf["starts"], pdf["out"], strict=True):
            states.append(state)
            k = next_survivor(list(starts), state, minimum)
            state = int(out[k]) if k < len(starts) else state
        return pdf[keys].assign(_state=states)

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(ORDER))
        state, kept = int(pdf["_state"].iloc[0]), []
        for start, end in zip(pdf["start_pos"].tolist(), pdf["end_pos"].tolist(), strict=True):
            good = start == state or start - state >= minimum
            kept.append(good)
            state = end if good else state
        return pdf[kept].drop(columns="_state")

    key_types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keys).schema)
    tables = back.select(*keys, *ORDER).join(reach, keys).groupBy(*keys).applyInPandas(table, f"{key_types}, starts array<bigint>, out array<bigint>")
    states = tables.groupBy("seqid", "strand").applyInPandas(compose, f"{key_types}, _state bigint")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    kept = back.join(states, keys).groupBy(*keys).applyInPandas(scan, schema)
    return ahead.unionByName(kept.drop("_range"))
