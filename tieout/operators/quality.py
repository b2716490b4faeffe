"""Contracts evaluated on the data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.model import DataContract


def evaluate(rows: DataFrame, contract: DataContract) -> DataFrame:
    """One row per check with the number of rows that fail it: required, allowed values, keys.

    However many checks there are, the rows are read once. Each row names the column checks it
    fails and shows its value under every key check; both are counted on the map side before the
    one shuffle, which spreads a key check over its values. A row without a whole key fails it.
    """
    declared = [c for c in contract.columns if c.name in rows.columns]
    failing = {}
    for c in declared:
        if c.required:
            failing[f"required:{c.name}"] = F.col(c.name).isNull()
        if c.allowed:
            failing[f"invalidValues:{c.name}"] = ~F.col(c.name).isin(*c.allowed)
    keys = {"primaryKey": [c.name for c in contract.columns if c.primary_key]}
    keys.update({f"duplicateValues:{c.name}": [c.name] for c in contract.columns if c.unique})
    keys = {name: columns for name, columns in keys.items() if columns}
    structural = [f"missing:{c.name}" for c in contract.columns if c.name not in rows.columns]
    structural += [
        f"type:{c.name}"
        for c in declared
        if rows.schema[c.name].dataType.simpleString() != c.type
    ]

    parts = {c: f"_{i}" for i, c in enumerate(dict.fromkeys(sum(keys.values(), [])))}

    def shown(check: str, own: Sequence[str] = ()) -> Column:
        null = {c: F.lit(None).cast(rows.schema[c].dataType) for c in parts}
        values = (F.col(c) if c in own else null[c] for c in parts)
        return F.struct(
            F.lit(check).alias("check"),
            *(v.alias(name) for v, name in zip(values, parts.values(), strict=True)),
        )

    entries = [shown(name, own) for name, own in keys.items()]
    entries += [F.when(bad, shown(name)) for name, bad in failing.items()]
    if structural:
        entries.append(shown(_EVERY_ROW))
    if not entries:
        return rows.sparkSession.createDataFrame([], "check string, failures bigint")
    told = rows.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
    groups = told.groupBy("check", *parts.values()).agg(F.count(F.lit(1)).alias("n"))
    whole = F.lit(False)
    for name, own in keys.items():
        here = [F.col(parts[c]).isNotNull() for c in own]
        whole = F.when(F.col("check") == name, reduce(Column.__and__, here)).otherwise(whole)
    counted = groups.groupBy("check").agg(
        (F.sum("n") - F.count_if(whole)).alias("failures")
    )
    # Checks that no row fails are there too, with zero.
    asked = [(name, name) for name in (*failing, *keys)]
    asked += [(name, _EVERY_ROW) for name in structural]
    names = rows.sparkSession.createDataFrame(asked, "name string, check string")
    return names.join(counted, "check", "left").select(
        F.col("name").alias("check"), F.coalesce("failures", F.lit(0).cast("bigint")).alias("failures")
    )


_EVERY_ROW = "rows"


def value_drift(rows: DataFrame, contract: DataContract) -> DataFrame:
    """Values that occur in the data but not in the contract, with how often."""
    out = None
    for c in contract.columns:
        if not c.allowed:
            continue
        seen = rows.groupBy(F.col(c.name).cast("string").alias("value")).agg(
            F.count(F.lit(1)).alias("rows")
        )
        new = seen.where(~F.coalesce(F.col("value").isin(*c.allowed), F.lit(False)))
        one = new.select(F.lit(c.name).alias("column_name"), "value", "rows")
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError(f"{contract.name} allows no values for any column")
    return out


def metric_filter_problems(contract: DataContract) -> list[str]:
    """Metric filters on a column or a value that the contract does not know."""
    allowed = {c.name: c.allowed for c in contract.columns}
    problems = []
    for metric, (column, value) in contract.metric_filters.items():
        if column not in allowed:
            problems.append(f"{metric} filters on {column}, which the contract does not have")
        elif value not in allowed[column]:
            problems.append(f"{metric} filters on {column} = {value}, which is not allowed")
    return problems
