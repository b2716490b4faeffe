"""The gold fact, built from inputs that are each pinned to one cut or one pointer instant."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tieout.operators import cut as C
from tieout.operators import deliveries as D

FACT = ("txn_id", "customer_id", "business_line", "amount_paise", "status", "business_date")


@dataclass(frozen=True)
class PinnedInput:
    """Rows in fact columns, and the position of the source they were read at."""

    source: str
    at: str
    rows: DataFrame

    def shaped(self, as_fact: Callable[[DataFrame], DataFrame]) -> PinnedInput:
        """The same input at the same position, its rows brought into other columns."""
        return replace(self, rows=as_fact(self.rows))


def at_cut(source: str, changes: DataFrame, ends: DataFrame, cut: Row) -> PinnedInput:
    """The changes of a database up to a cut; the cut's position is the label."""
    inside = ends.where(F.col("position") <= F.lit(cut["position"]))
    return PinnedInput(source, str(cut["position"]), C.only_transactions(changes, inside))


def at_instant(source: str, rows: DataFrame, pointer: DataFrame, moment: datetime) -> PinnedInput:
    """Partner rows as their pointer had them at an instant; the instant, in UTC, is the label."""
    known = D.as_known_at(rows, pointer, moment)
    at = moment.astimezone(UTC).replace(tzinfo=None).isoformat(sep=" ")
    return PinnedInput(source, at, known)


def version_label(inputs: Sequence[PinnedInput]) -> dict[str, str]:
    """The position of every source. A build never mixes two positions of one source."""
    label: dict[str, str] = {}
    for i in inputs:
        if label.setdefault(i.source, i.at) != i.at:
            raise ValueError(f"{i.source} was read at {label[i.source]} and at {i.at}")
    return label


def build_fact(inputs: Sequence[PinnedInput]) -> DataFrame:
    version_label(inputs)
    return reduce(DataFrame.unionByName, (i.rows.select(*FACT) for i in inputs))
