"""Orphan references and quantities, on small tables with every kind of dirt."""

from datetime import datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.functions.units import Unit, UnitSystem, parse_number
from quire.operators import orphans, quantities, skew
from quire.operators.skew import salted_join

T = datetime


@given(st.lists(st.integers(0, 200_000)), st.lists(st.integers(0, 200_000)))
@settings(max_examples=50, deadline=None)
def test_bitmap_and_not_is_set_difference(a, b):
    left, right = orphans.Bitmap(np.array(a, np.int64)), orphans.Bitmap(np.array(b, np.int64))
    assert left.and_not(right).tolist() == sorted(set(a) - set(b))


def test_bitmap_dense_containers():
    a, b = orphans.Bitmap(np.arange(0, 150_000)), orphans.Bitmap(np.arange(0, 150_000, 2))
    assert a.and_not(b).tolist() == list(range(1, 150_000, 2))
    b |= orphans.Bitmap(np.arange(1, 100_000, 2))
    assert a.and_not(b).tolist() == list(range(100_001, 150_000, 2))


def _refs(spark, rows):
    df = spark.createDataFrame(rows, "edge_id string, target_id string, created_at timestamp, ref_key int, salt int")
    return orphans.references(df, "edges.target_id", "edge_id", "target_id")


def _parents(spark, rows):
    df = spark.createDataFrame(rows, "segment_id string, loaded_at timestamp, deleted_at timestamp")
    return orphans.parents(df, "segment_id", "loaded_at", "deleted_at")


def test_orphans_cover_missing_deleted_late_blank_and_null_dates(spark):
    jan, feb = T(2024, 1, 10), T(2024, 2, 10)
    refs = _refs(spark, [
        ("here", " A ", jan, 1, 1), ("missing", "zz", jan, 1, 1), ("deleted", "d", jan, 1, 1), ("late", "l", jan, 1, 1), ("in_time", "l", feb, 1, 1), ("blank", "  ", jan, 1, 1),
        ("null", None, jan, 1, 1), ("no_date", "zz", None, 1, 1), ("no_date_ok", "l", None, 1, 1), ("missing", "ZZ", jan, 2, 2), (None, "zz", jan, 1, 1), ("never", "n", feb, 1, 1),
    ])
    parents = _parents(spark, [("a", jan, None), ("d", jan, None), ("D ", jan, feb), ("l", T(2024, 2, 29), None), ("l", T(2024, 5, 1), None), ("n", None, None), (None, jan, None)])
    got = {(r.record_id, r.ref_period) for r in orphans.orphan_references(refs, parents).collect()}
    assert got == {("missing", "2024-01"), ("deleted", "2024-01"), ("late", "2024-01"), ("no_date", None), (None, "2024-01"), ("never", "2024-02")}
    report = orphans.orphan_report(orphans.orphan_references(refs, parents)).collect()
    assert sum(r.n_orphans for r in report) == 6


def test_orphans_of_empty_tables(spark):
    assert orphans.orphan_references(_refs(spark, []), _parents(spark, [])).count() == 0
    assert orphans.orphan_references(_refs(spark, [("e", "x", T(2024, 1, 1), 0, 0)]), _parents(spark, [])).count() == 1


def test_orphans_of_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(skew, "FAIR_SHARE", 500)
    rows = spark.range(30_000).select(F.concat(F.lit("e"), "id").alias("edge_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("target_id"), F.lit(T(2024, 3, 1)).alias("created_at"))
    refs = orphans.references(rows, "edges.target_id", "edge_id", "target_id")
    parents = _parents(spark, [("k1", T(2024, 1, 1), None)])
    assert orphans.orphan_references(refs, parents).count() == 29_999


def test_salted_join_equals_join(spark):
    many = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("x"))
    few = spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 10).alias("y"))
    hot = spark.createDataFrame([(3, 5)], "k long, _salts int")
    got = salted_join(many, few, ["k"], hot, "k", F.col("x"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, many.join(few, "k").collect()))


@pytest.mark.parametrize("text, value", [
    ("1,234", 1234), ("0,6480", 0.648), ("46,86", 46.86), ("1.234", 1.234), ("93.708,49", 93708.49), ("1,234,567.8", 1234567.8), ("1.234.567", 1234567), ("1 234 567", 1234567),
    ("1Z6,624", 126624), ("O.5", 0.5), ("l2", 12), (".25", 0.25), ("8.379.155,6", 8379155.6),
])
def test_numbers(text, value):
    assert parse_number(text) == pytest.approx(value)


CATALOGUE = [
    ("money", "US dollar", 1.0, None, "US dollar"), ("money", "US cent", 0.01, None, "US dollar"), ("money", "million US dollars", 1e6, None, "US dollar"), ("rate", "decimal fraction", 1.0, None, "decimal fraction"),
    ("rate", "percent", 0.01, None, "decimal fraction"), ("rate", "basis point", 1e-4, None, "decimal fraction"), ("rate", "per mille", 1e-3, None, "decimal fraction"), ("duration", "year", 1.0, None, "year"), ("mass", "kilogram", 1.0, None, "kilogram"),
    ("volume", "barrel", 1.0, None, "barrel"), ("energy", "megawatt hour", 1.0, None, "megawatt hour"), ("energy", "kilowatt hour", 1e-3, None, "megawatt hour"),
]
UNITS = UnitSystem(CATALOGUE)


def _common(text, system=UNITS):
    unit = system.parse_unit(text).unit
    return unit.common(1.0, system.quantities[unit.dims][1])


@pytest.mark.parametrize("text, value, scale, unit", [
    ("-$29.81m", -29.81, 1e6, "US dollar"), ("US$ 46,86 MM", 46.86, 1e6, "US dollar"), ("(1.748)  ", -1.748, None, None), ("29.41‰", 29.41, None, "per mille"), ("137.5 b.p.", 137.5, None, "basis point"),
    ("1,443 bbl*", 1443, None, "barrel"), ("40 thousand bbl", 40, 1e3, "barrel"), ("5 US cents†", 5, None, "US cent"), ("2 kilowatt-hours", 2, None, "kilowatt hour"), ("3 oz t", 3, None, "troy ounce"),
    ("−USD 0.0763 bn.", -0.0763, 1e9, "US dollar"), ("1g.13 tonnes", 19.13, None, "metric tonne"), ("0.7 as a fraction", 0.7, None, "decimal fraction"), ("1-2", None, None, None), ("7 kUSD", 7, 1e3, "US dollar"), ("$7 USD", 7, None, "US dollar"),
])
def test_quantities_parse(text, value, scale, unit):
    got = UNITS.parse_quantity(text)
    if value is None:
        assert got is None
    else:
        assert got[0] == pytest.approx(value)
        assert (got[1].scale, got[1].unit and got[1].unit.name) == (scale, unit) if unit or scale else got[1] is None


@pytest.mark.parametrize("text", [None, "", "n/a", "BBB", "B", "=SUM(B1:B9)", "3/4/2024", "–", "Belmiria Minerals", "12 apples"])
def test_no_quantities(text):
    assert UNITS.parse_quantity(text) is None


def test_units_are_exponent_vectors():
    kwh = UNITS.parse_unit("kW h").unit
    assert kwh.dims == UNITS.parse_unit("MWh").unit.dims == (0, 1, 2, -2, 0, 0) and UNITS.quantities[kwh.dims][0] == "energy" and kwh.common(5, UNITS.quantities[kwh.dims][1]) == pytest.approx(0.005)
    assert _common("metres^3") == pytest.approx(1 / 0.158987294928) and UNITS.parse_unit("MWh per year / year^-1").unit.dims == kwh.dims
    assert _common("hours") == pytest.approx(1 / 24 / 365) and UNITS.parse_unit("dollars per barrel") is None and UNITS.parse_unit("kg/kg") is None
    assert UNITS.parse_quantity("12 kW h") == (12.0, UNITS.parse_unit("kW h")) and UNITS.parse_quantity("3 apples per day") is None
    assert {u: pytest.approx(_common(u)) for u in ("lbs", "ozt", "gal", "GWh", "kJ", "‰", "¢", "quarters", "mths", "weeks", "tonnes")} == {"lbs": 0.45359237, "ozt": 0.0311034768, "gal": 1 / 42, "GWh": 1e3, "kJ": 1 / 3.6e6, "‰": 1e-3, "¢": 0.01, "quarters": 0.25, "mths": 1 / 12, "weeks": 7 / 365, "tonnes": 1e3}


def test_units_with_offsets():
    celsius = UnitSystem([("temperature", "degree Celsius", 1.0, None, "degree Celsius"), ("temperature", "degree Fahrenheit", 5 / 9, None, "degree Celsius"), ("temperature", "kelvin", 1.0, -273.15, "degree Celsius")])
    values = [celsius.quantity(*x, None, None) for x in (("212 °F", None), ("-40", "deg F"), ("300", "kelvin"), ("5", "°C"))]
    assert [q.value for q in values] == [pytest.approx(x) for x in (100.0, -40.0, 26.85, 5.0)] and {q.common_unit for q in values} == {"degree Celsius"}
    # an offset of the catalogue holds, and none is left in a product
    delisle = UnitSystem([("temperature", "kelvin", 1.0, 0.0, "kelvin"), ("temperature", "delisle", -2 / 3, 373.15, "kelvin")])
    assert delisle.quantity("60 delisle", None, None, None).value == pytest.approx(333.15)
    assert UNITS._product(["°f", "/", "day"])[1].offset == 0.0 and Unit((0,), 2.0, 3.0).scaled(10).common(1, Unit((0,))) == 23.0


def test_names_that_only_the_catalogue_knows():
    own = UnitSystem([("volume", "barrel", 1.0, None, "barrel"), ("volume", "hogshead", 1.5, None, "barrel"), ("dose", "Sievert", 1.0, None, "Sievert"), ("dose", "banana", 1e-7, None, "Sievert")])
    assert own.quantity("4 hogsheads", None, None, None).value == 6.0 and own.quantity("2", "thousand bananas", None, None).value == pytest.approx(2e-4)
    assert own.parse_unit("banana hogshead") is None and own.parse_unit("gal") is not None
    for bad in (("volume", "12", 1.0, None, "barrel"), ("volume", None, 1.0, None, "barrel"), ("volume", "gallon", None, None, "barrel"), ("volume", "kilogram", 1.0, None, "barrel"), ("volume", "thousand barrels", 7.0, None, "barrel")):
        with pytest.raises(ValueError):
            UnitSystem([bad])
    # the catalogue's factor holds for every spelling of a known unit
    odd = UnitSystem([("volume", "barrel", 1.0, None, "barrel"), ("volume", "US gallon", 1 / 40, None, "barrel")])
    assert odd.quantity("80 gal", None, None, None).value == pytest.approx(2.0)


def test_headers_and_units():
    assert UNITS.split_header("Face value ($ millions)") == ("face value", UNITS.parse_unit("$ millions"))
    assert UNITS.split_header("Yield in % p.a.")[1].unit.name == "percent"
    assert UNITS.split_header("Sharpe ratio") == ("sharpe ratio", None) and UNITS.split_header(None) == ("", None)
    assert UNITS.parse_unit("-") is None and UNITS.parse_unit(None) is None and UNITS.parse_unit("$000").scale == 1e3


def _tables(spark, cells, heads):
    c = spark.createDataFrame(cells, "cell_id long, segment_id string, col_index int, raw_value string, units string, normalized_value double, name string")
    t = spark.createDataFrame(heads, "segment_id string, caption string, col_headers array<string>, footnotes array<string>, units array<string>")
    u = spark.createDataFrame([("money", "US dollar", 1.0, "US dollar"), ("money", "US cent", 0.01, "US dollar"), ("rate", "percent", 0.01, "decimal fraction"), ("mass", "gram", 0.001, "kilogram")], "quantity string, unit_name string, factor_to_common double, common_unit string")
    return c, t, u


def test_statements_complete_each_other(spark):
    cells = [
        (1, "t", 1, "$2.5", None, 2.5e6, "x"), (2, "t", 2, "3", None, 3e9, "x"), (3, "t", 3, "3", None, 3.0, "x"), (4, "t", 4, "7", "pct", None, "x"), (5, "t", 0, "$9", None, None, "x"), (6, "t", 5, "70 g", "g", 0.07, "x"),
        (7, None, 1, "$4k", None, 4000.0, "x"), (8, "u", 1, "$5", None, None, "x"), (8, "u", 1, "$5", None, None, "x"), (9, "t", 9, None, None, None, None), (10, "none", 3, "1 pct", "-", 0.5, "x"), (11, "v", 1, "1", None, 1e9, "x"),
    ]
    heads = [
        ("t", "All money amounts are in billions of dollars", ["", "Value (millions)", "Cash", "Count", "Rate", "Mass"], None, ["%"]), ("u", None, ["", "Cash"], [], []), ("u", None, ["", "Cash"], [], []),
        ("v", None, ["", "Cash"], ["Note: Amounts in billions of dollars."], []), (None, None, None, None, None),
    ]
    out = quantities.common_units(*_tables(spark, cells, heads))
    got = {r.cell_id: (r.quantity, pytest.approx(r.common_value)) for r in out.collect()}
    assert got[1] == ("money", 2.5e6) and got[2] == ("money", 3e9) and 3 not in got and got[4] == ("rate", 0.07) and 5 not in got and got[6] == ("mass", 0.07)
    assert got[7] == ("money", 4000.0) and got[8] == ("money", 5.0) and 9 not in got and got[10] == ("rate", 0.01) and got[11] == ("money", 1e9)
    assert {r.cell_id for r in quantities.disagreeing(out).collect()} == {4, 8, 10}


def test_quantities_with_hot_tables_and_names(spark, monkeypatch):
    monkeypatch.setattr(skew, "FAIR_SHARE", 20)
    cells = [(i, "t", 1, "$2" if i % 3 else "2", None if i % 2 else "thousands", None, "x") for i in range(200)] + [(900, "u", 1, "3 pct", None, None, "x"), (901, None, 1, "3 pct", None, None, "x")]
    c, t, u = _tables(spark, cells, [("t", None, ["", "Cash"], None, None)])
    got = {r.cell_id: r.common_value for r in quantities.common_units(c, t, u).collect()}
    assert got == {i: 2e3 if i % 2 == 0 else 2.0 for i in range(200) if i % 3 or i % 2 == 0} | {900: pytest.approx(0.03), 901: pytest.approx(0.03)}
    c, t, u = _tables(spark, cells, [])
    offset = u.withColumn("offset_to_common", F.when(F.col("unit_name") == "percent", 1.0))
    assert quantities.common_units(c, t, offset).where("cell_id = 900").first().common_value == pytest.approx(1.03)


def test_quantities_of_empty_tables(spark):
    c, t, u = _tables(spark, [], [])
    assert quantities.common_units(c, t, u).count() == 0
    c, t, u = _tables(spark, [(1, "x", 1, "$5", None, None, "x")], [])
    assert quantities.disagreeing(quantities.common_units(c, t, u)).count() == 1
