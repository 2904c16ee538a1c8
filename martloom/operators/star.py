"""Left (or inner) equi-joins of a fact with star and snowflake dimensions.

A dimension that hangs off another one (``outriggers``) is joined to that dimension first.
For equi-joins ``(fact + d) + o`` equals ``fact + (d + o)``, and the second form moves the
small dimension rows instead of shuffling the fact once more.

Plain dimensions are left to Spark, which broadcasts those whose files are under
``spark.sql.autoBroadcastJoinThreshold`` and sorts and merges the others. Of a dimension with
outriggers it cannot estimate the size, so that is measured, and broadcast if it fits.

In a sort-merge join a hot or NULL fact key is split by adaptive execution. It may always split
the preserved (fact) side here, because each step joins on another key and so starts with a
shuffle of its own. Dimensions that share the key of a fan-out belong into ``FanoutJoin``.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.names import require_columns, require_disjoint
from martloom.functions.sizes import BROADCAST_BYTES, may_fit, measured_bytes


@dataclass(frozen=True)
class Dimension:
    frame: DataFrame
    key: str
    outriggers: tuple[Dimension, ...] = field(default=())

    def flattened(self, how: str = "left") -> DataFrame:
        """The dimension with its outriggers; marked for broadcast if all of it is small.

        With outriggers this runs jobs: one count per table and, if all are small, one over the
        joined rows.
        """
        if not self.outriggers:
            return self.frame
        joined = star_join(self.frame, self.outriggers, how)
        small = self._may_fit() and measured_bytes(joined) <= BROADCAST_BYTES
        return F.broadcast(joined) if small else joined

    def _may_fit(self) -> bool:
        return may_fit(self.frame) and all(o._may_fit() for o in self.outriggers)


def star_join(fact: DataFrame, dimensions: Iterable[Dimension], how: str = "left") -> DataFrame:
    """Join each dimension on its one key column, which appears once in the result."""
    joined = fact
    for dimension in dimensions:
        right = dimension.flattened(how)
        label = f"join on {dimension.key}"
        require_columns(joined, [dimension.key], label)
        require_columns(right, [dimension.key], label)
        require_disjoint(joined, right, dimension.key, label)
        joined = joined.join(right, dimension.key, how)
    return joined
