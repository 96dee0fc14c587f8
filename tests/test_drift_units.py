import datetime as dt

import pytest

from stratakit.operators import drift as D
from stratakit.operators import units as U

HEAD = "file_path string, feed string, created_at timestamp_ntz, received_at timestamp_ntz, col_index_in_line int, search_term string, matched_string string, cell_type string, quantity string"


def heads(spark, rows):
    day = lambda n: dt.datetime(2020, 1, 1) + dt.timedelta(days=n)
    return spark.createDataFrame([(p, f, None if n is None else day(n), day(0), i, t, m, c, "clash") for p, f, n, i, t, m, c in rows], HEAD)


@pytest.fixture(scope="module")
def terms(spark):
    return spark.createDataFrame([("depth", "depth"), ("top", "depth"), ("qc", "qc"), ("temp", "temperature"), ("remark", "remark")], "search_term string, quantity string")


def test_changes(spark, terms):
    rows = [
        ("a", "F", 0, 0, "depth", "Depth (m)", "double"), ("a", "F", 0, 1, "qc", "qc", None), ("a", "F", 0, 2, "odd", "Odd", "string"),
        ("a", "F", 0, 1, "qc", "qc", None),
        ("b", "F", 1, 1, "top", " DEPTH(m) ", "string"), ("b", "F", 1, 0, "temp", "Temp", "double"),
        ("c", "F", 40, 0, "depth", "Depth [m]", None), ("c", "F", 40, 1, "temp", "Temp", "double"),
        ("z", None, 0, 0, "qc", "q", "double"), ("y", "F", None, 0, "qc", "q", "double"), ("w", "G", 0, None, "qc", "q", "double"),
    ]
    cells = D.header_cells(heads(spark, rows), terms)
    schemas = D.promote_schemas(D.observed_schemas(cells), list(D.PROMOTABLE))
    got = {tuple(r) for r in D.schema_changes(schemas, [*D.CORE, *D.PROMOTABLE]).collect()}
    assert got == {
        ("b", "depth", "retyped"), ("b", "qc", "removed"), ("b", "temperature", "added"), ("c", "depth", "renamed"),
    }
    left = {r["file_path"]: r["_rescued"] for r in schemas.collect()}
    assert "Odd" in left["a"] and left["b"] == "[]"


def test_rescue_and_replay(spark, terms):
    cells = D.header_cells(heads(spark, [("a", "F", 0, 0, "depth", "D", "double"), ("a", "F", 0, 1, "temp", "T", "double"), ("a", "F", 0, 2, "odd", "O", None), ("a", "F", 0, 3, "top", "D2", None)]), terms)
    lines = spark.createDataFrame(
        [(1, "a", 2, ",", ["1.5", "20", "x", "9"], 7), (2, "a", 3, ",", ["bad", "", "", ""], 7), (3, "b", 2, ";", ["1,5"], 7), (4, "a", 4, ",", None, 7), (5, "a", 5, ",", ["1", "warm", "", "", "extra"], 7)],
        "line_id long, file_path string, line_no int, delimiter string, fields array<string>, slots int",
    )
    first = {r["line_id"]: r for r in D.ingest_lines(lines, D.layouts(cells, list(D.CORE))).collect()}
    assert first[1]["depth"] == 1.5 and '"20"' in first[1]["_rescued"] and '"9"' in first[1]["_rescued"]
    assert first[2]["depth"] is None and "bad" in first[2]["_rescued"]
    assert '"1,5"' in first[3]["_rescued"] and first[4]["_rescued"] is None
    second = {r["line_id"]: r for r in D.promote_lines(D.ingest_lines(lines, D.layouts(cells, list(D.CORE)))).collect()}
    assert second[1]["temperature"] == 20.0 and '"20"' not in second[1]["_rescued"] and '"x"' in second[1]["_rescued"]
    assert second[5]["temperature"] is None and "warm" in second[5]["_rescued"] and "extra" in second[5]["_rescued"]


def test_drift_of_nothing(spark, terms):
    none = heads(spark, [])
    cells = D.header_cells(none, terms.limit(0))
    assert D.schema_changes(D.promote_schemas(D.observed_schemas(cells), list(D.PROMOTABLE)), [*D.CORE, *D.PROMOTABLE]).count() == 0


def test_alias_dictionary(spark):
    said = ["metres", "metre", "milimetres", "centimeters", "kilopascal", "kn/m2", "ft", "fm", "at", "", "bars", "kgf/cm2", "conepressure", None]
    got = {r["spelling"]: r["unit"] for r in U.alias_dictionary(spark, spark.createDataFrame([(s,) for s in said], "spelling string")).collect()}
    assert got == {"metres": "m", "metre": "m", "milimetres": "mm", "centimeters": "cm", "kilopascal": "kpa", "kn/m2": "kpa", "ft": "ft", "bars": "bar", "kgf/cm2": "kgf_cm2"}


def test_values_decide(spark, terms):
    def sheet(i, depth, qc):
        return [(i * 100 + k, i, float(d), float(q), None, None, "clash") for k, (d, q) in enumerate(zip(depth, qc))]

    ten = range(1, 11)
    rows = sheet(1, [k * 100 for k in ten], [k * 500 for k in ten]) + sheet(2, [k * 0.5 for k in ten], [k for k in ten]) + sheet(3, [-k * 5.0 for k in ten], [k * 20 for k in ten])
    rows += [(999, 2, 5.5, -9999.0, None, None, "x"), (998, None, 1.0, 1.0, None, None, None), (997, 4, None, None, None, None, None)]
    m = spark.createDataFrame(rows, "measurement_id long, cpt_id long, depth double, qc double, fs double, u2 double, depth_unit string")
    reports = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "c"), (None, None)], "cpt_id long, source_file string")
    h = heads(spark, [("a", "F", 0, 0, "depth", "Depth", None), ("a", "F", 0, 1, "qc", "qc [MPa]", None), ("b", "F", 1, 0, "depth", "Depth (cm)", None), ("b", "F", 1, 1, "qc", "qc_kPa", None), ("c", "F", 2, 0, "depth", "Depth, feet", None), ("c", "F", 2, 1, "qc", "qc in bars", None)])
    got = {r["cpt_id"]: (r["depth_unit"], r["qc_unit"], r["fs_unit"]) for r in U.sounding_units(spark, reports, m, h, terms).collect()}
    assert got == {1: ("cm", "kpa", None), 2: ("m", "mpa", None), 3: ("ft", "bar", None), 4: (None, None, None)}
    out = {r["measurement_id"]: r for r in U.convert_soundings(m, U.sounding_units(spark, reports, m, h, terms)).collect()}
    assert out[100]["depth"] == 1.0 and out[100]["qc"] == 0.5 and out[999]["qc"] is None and out[300]["depth"] == pytest.approx(1.524)
    assert U.sounding_units(spark, reports.limit(0), m.limit(0), h.limit(0), terms.limit(0)).count() == 0


def test_misspelled_units_hold_where_the_values_permit(spark, terms):
    m = spark.createDataFrame([(k + 100 * i, i, k * d, k * q, None, None) for k in range(1, 11) for i, d, q in ((1, 200.0, 2000.0), (2, 2.0, 20.0), (3, 1.0, 2.0))], "measurement_id long, cpt_id long, depth double, qc double, fs double, u2 double")
    reports = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "cpt_id long, source_file string")
    names = {"a": ("Depth (centimetrs)", "qc [kilopascls]"), "b": ("Depth (ft.)", "qc [megapscals]"), "c": ("Depth (millimeters)", "qc")}
    h = heads(spark, [(f, "F", 0, k, t, n[k], None) for f, n in names.items() for k, t in enumerate(("depth", "qc"))])
    got = {r["cpt_id"]: (r["depth_unit"], r["depth_basis"], r["qc_unit"], r["qc_basis"]) for r in U.sounding_units(spark, reports, m, h, terms).collect()}
    assert got == {1: ("cm", "header", "kpa", "header"), 2: ("ft", "header", "kpa", "values against the header"), 3: ("m", "values against the header", "mpa", "default")}
    assert {r["basis"]: r["n"] for r in U.unit_basis(U.sounding_units(spark, reports, m, h, terms)).where("quantity = 'qc'").collect()} == {"header": 1, "values against the header": 1, "default": 1}


def test_levels(spark):
    rows = [(1, 347.0, "GWL=347centimetres"), (2, 3.0, "50 mm pipe"), (3, -8.3, "8.3feet bgl"), (4, 10.6, "see sheet 5, [ft] (collar 1 m up)"), (5, 5.0, None), (6, None, "5 cm"), (7, 46.0, "(level in Centimetres)"), (7, 46.0, "(level in Centimetres)"), (8, 50.0, "x" * 100_000), (9, 5.0, "assumed, 5 cm cap"), (10, 1.0, "[ft] (collar 1 m up)"), (11, 100.0, "in mm, casing 100 mm")]
    v = spark.createDataFrame(rows, "value_id long, ground_water_level double, ground_water_level_note string")
    assert {r["value_id"]: r["unit"] for r in U.level_units(spark, v).collect()} == {1: "cm", 2: "m", 3: "ft", 4: "ft", 5: "m", 7: "cm", 8: "m", 9: "m", 10: "ft", 11: "mm"}
    assert U.level_units(spark, v.limit(0)).count() == 0
