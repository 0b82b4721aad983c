"""Quantities in different units, converted to the common units of a catalogue.

A cell's unit may stand in its text, its ``units`` field, its column header, or, for money, in a
caption or footnote. The statements complete each other: the first place that names the unit gives
it, the first that names a scale gives the scale. Which headers are money columns is learned from
all cells that name a unit themselves. Every unit is an exponent vector with factor and offset
(:mod:`quire.functions.units`); each cell is parsed once.

Defined results: a null, blank or placeholder text, a rating, date, formula or unit-less number gives
no row; a null or short ``col_headers`` counts as no header; repeated cells give equal rows once;
a unit whose dimension the catalogue lacks gives no row; a catalogue row that can't be read raises
ValueError; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.units import UnitSystem
from quire.operators.skew import hot_keys, salted_join
from quire.session import cut

#: Rows that a unit catalogue may have; it goes to every task.
MOST_UNITS = 10_000
PARSED = "cell_id bigint, name string, quantity string, unit_name string, common_value double, common_unit string, stored_value double, assumed boolean"


def catalogue_rows(unit_catalogue: DataFrame) -> list[tuple]:
    """(quantity, unit_name, factor, offset, common_unit) of a catalogue, which is a small table.

    The catalogue may have a column ``offset_to_common``; rows without a name are none.
    """
    offset = F.col("offset_to_common").cast("double") if "offset_to_common" in unit_catalogue.columns else F.lit(None).cast("double")
    named = unit_catalogue.where(F.col("unit_name").isNotNull()).select("quantity", "unit_name", F.col("factor_to_common").cast("double"), offset, "common_unit")
    rows = [tuple(r) for r in named.limit(MOST_UNITS + 1).collect()]
    if len(rows) > MOST_UNITS:
        raise ValueError("the unit catalogue must be a small table")
    return rows


def _parse(catalogue: list[tuple]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system = UnitSystem(catalogue)
        for b in batches:
            out = []
            for cell, raw, units, header, notes, stored in zip(b["cell_id"], b["raw_value"], b["units"], b["header"], b["notes"], b["stored"]):
                q = system.quantity(raw, units, header, notes)
                if q is not None:
                    out.append((cell, q.column, q.quantity, q.unit, q.value, q.common_unit, stored, q.assumed))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in PARSED.split(", ")])

    return run


def common_units(cells: DataFrame, tables: DataFrame, unit_catalogue: DataFrame) -> DataFrame:
    """One row a quantity cell: its value in the common unit and the stored value."""
    catalogue = catalogue_rows(unit_catalogue)
    UnitSystem(catalogue)  # what can't be read is told before any task runs
    heads = tables.select("segment_id", "col_headers", F.concat(F.array("caption"), F.coalesce("footnotes", F.array().cast("array<string>"))).alias("notes")).where(F.col("segment_id").isNotNull())
    heads = heads.groupBy("segment_id").agg(F.max(F.struct("col_headers", "notes")).alias("h")).select("segment_id", "h.*")
    numbers = cells.where((F.col("col_index") > 0) & F.col("raw_value").rlike("[0-9]"))
    counts = numbers.groupBy("segment_id").agg(F.count("*").alias("n"))
    hot, _ = hot_keys(counts, "segment_id", "n", numbers.count())
    rows = (
        salted_join(numbers.select("cell_id", "segment_id", "col_index", "raw_value", "units", F.col("normalized_value").cast("double").alias("stored")), heads, ["segment_id"], hot, "segment_id", F.col("cell_id"), "left")
        .select("segment_id", "cell_id", "raw_value", "units", F.get("col_headers", F.col("col_index")).alias("header"), "notes", "stored")
        .dropDuplicates(["segment_id", "cell_id", "raw_value", "units", "header", "stored"])
    )
    parsed = cut(rows.select("cell_id", "raw_value", "units", "header", "notes", "stored").mapInPandas(_parse(catalogue), PARSED), "quantities")
    # a number without a unit is money where most cells of columns of that name are
    kinds = parsed.where(~F.col("assumed") & (F.col("name") != "")).groupBy("name", "quantity").agg(F.count("*").alias("n"))
    learned = kinds.groupBy("name").agg(F.max_by("quantity", F.struct("n", "quantity")).alias("learned")).where(F.col("learned") == "money").select("name")
    open_ = parsed.where("assumed")
    hot, _ = hot_keys(open_.groupBy("name").agg(F.count("*").alias("n")), "name", "n", open_.count())
    money = salted_join(open_, learned, ["name"], hot, "name", F.col("cell_id"))
    return parsed.where(~F.col("assumed")).unionByName(money).select("cell_id", "quantity", "unit_name", "common_value", "common_unit", "stored_value")


def disagreeing(converted: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """Cells whose stored value is null or off by more than ``tolerance`` of the converted one."""
    stored, true = F.col("stored_value"), F.col("common_value")
    return converted.where(stored.isNull() | F.isnan(stored) | (F.abs(stored - true) > tolerance * F.abs(true)))
