"""Operators of the sheet, mining, borehole and load pipelines on small inputs."""

import datetime as dt
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from stratakit import constants as K
from stratakit import schemas
from stratakit.functions import numbers as NUM
from stratakit.functions import text as X
from stratakit.operators import boreholes as B
from stratakit.operators import conditioning as C
from stratakit.operators import dedupe as D
from stratakit.operators import load as L
from stratakit.operators import mining as M
from stratakit.operators import sheets as S
from stratakit.session import chunked_lag, salted_join
from stratakit.sources import ags, excel, text
from stratakit.streaming import ingest

ROWS = "cpt_id long, measurement_id long, depth double, qc double, fs double, u2 double"


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"t {kind}").select(expr(F.col("t")).alias("x")).head()[0]


# ---------------------------------------------------------------- conditioning


def sounding(i, depths, qc=1.0, fs=0.1, u=0.0, start=0):
    return [(i, start + k, float(d) if d is not None else None, qc, fs, u) for k, d in enumerate(depths)]


def conditioned(spark, rows, names=(), strict=False):
    df = spark.createDataFrame(rows, ROWS)
    n = spark.createDataFrame(list(names), "cpt_id long, depth_name string, qc_name string, fs_name string, u2_name string")
    return C.condition(df, "cpt_id", "measurement_id", n, strict).orderBy("measurement_id").collect()


def test_header_says_cm_but_values_are_metres(spark):
    got = conditioned(spark, sounding(1, [k * 0.01 for k in range(50)]), [(1, "Depth (cm)", None, None, None)])
    assert got[10]["depth"] == pytest.approx(0.1) and "cm" in got[0]["explicit_unit_conversions"] and got[0]["inferred_unit_conversions"]


def test_units_by_value(spark):
    got = conditioned(spark, sounding(1, range(100, 900, 10), qc=5000.0, fs=50.0, u=-100.0))
    assert got[0]["depth"] == pytest.approx(1.0) and got[0]["qc"] == pytest.approx(5.0) and got[0]["fs"] == pytest.approx(0.05) and got[0]["u2"] == pytest.approx(-0.1)
    got = conditioned(spark, sounding(1, range(1000, 9000, 20)))
    assert got[0]["depth"] == pytest.approx(1.0)


def test_friction_threshold_modes(spark):
    rows = [(1, k, k * 0.1, 1.0, 50.0 if k % 5 == 0 else 0.05, 0.0) for k in range(50)]
    assert conditioned(spark, rows)[0]["fs"] == 50.0
    assert conditioned(spark, rows, strict=True)[0]["fs"] == pytest.approx(0.05)


def test_placeholders_pass_through(spark):
    rows = sounding(1, [*range(100, 900, 10), -9999], qc=5000.0) + [(1, 900, 910.0, -9999.0, -8888.0, -9.999)]
    last = conditioned(spark, rows)[-1]
    assert (last["qc"], last["fs"], last["u2"]) == (-9999.0, -8888.0, -9.999)
    df = spark.createDataFrame(rows, ROWS)
    assert C.positive_depth(df).where("depth = -9999").count() == 1
    assert C.positive_depth(df, strict=True).where("depth = 9999").count() == 1


def test_steps(spark):
    rows = sounding(1, [3, 2, 1]) + sounding(2, [1, 1, 1, 2]) + sounding(3, [5]) + sounding(4, [None, None]) + sounding(5, [0, 1, None, 3, 7])
    got = {r["cpt_id"]: r["step"] for r in C.depth_steps(spark.createDataFrame(rows, ROWS), "cpt_id", "measurement_id").collect()}
    assert got == {1: -1.0, 2: 1.0, 3: 1.0, 4: 1.0, 5: 2.0}


def test_truncate_and_row_filters(spark):
    df = spark.createDataFrame([(1, 1, 1.0, 1.0, 1.0, 1.0), (1, 2, None, 1.0, 1.0, 1.0), (1, 3, 2.0, 1.0, 1.0, 1.0), (2, 1, 0.0, 0.0, None, None)], ROWS)
    assert C.truncate_after(df, "cpt_id", "measurement_id", F.col("depth").isNull()).count() == 2
    assert C.numeric_rows(df).count() == 3 and C.nonzero_rows(df).count() == 3


def test_sheet_containment(spark):
    base = [float(k) for k in range(1, 21)]
    sets = {1: base, 2: base, 3: base[:8], 4: base[5:12], 5: [*base, 21.0, 22.0], 6: [base[0], base[2]], 7: [0.0, 0.0]}
    rows = [(9, i, k, v, v * 2, None, 1.0) for i, vs in sets.items() for k, v in enumerate(vs)] + [(8, 50, 0, 1.0, 2.0, None, 1.0), (None, 51, 0, 1.0, 2.0, None, 1.0)]
    df = spark.createDataFrame([r[:6] + (None,) for r in rows], "rec long, cpt_id long, measurement_id long, depth double, qc double, fs double, u2 double")
    got = lambda mode: {r["cpt_id"]: r["kept_in"] for r in D.contained_sheets(df, "rec", "cpt_id", "measurement_id", mode).collect()}
    assert got("exact") == {2: 1}
    assert got("prefix") == {1: 5, 2: 5, 3: 5}
    assert got("contiguous") == {1: 5, 2: 5, 3: 5, 4: 5}
    with pytest.raises(ValueError):
        D.contained_sheets(df, "rec", "cpt_id", "measurement_id", "other")
    assert D.contained_sheets(df.limit(0), "rec", "cpt_id", "measurement_id").count() == 0


# ---------------------------------------------------------------- helpers


def test_chunked_lag_equals_lag(spark):
    df = spark.createDataFrame([(k % 3, k * 7 % 101, float(k)) for k in range(101)], "g int, o int, v double")
    got = {(r["g"], r["o"]): r["p"] for r in chunked_lag(df, ["g"], "o", F.floor(F.col("o") / 10), F.col("v"), "p").collect()}
    from pyspark.sql.window import Window

    want = {(r["g"], r["o"]): r["p"] for r in df.withColumn("p", F.lag("v").over(Window.partitionBy("g").orderBy("o"))).collect()}
    assert got == want


def test_salted_join_kinds(spark):
    big = spark.createDataFrame([(k, "hot" if k < 90 else str(k)) for k in range(100)] + [(200, None)], "i int, k string")
    small = spark.createDataFrame([("hot", 1), ("95", 2)], "k string, v int")
    count = lambda how: salted_join(big, small, ["k"], how, ["i"]).count()
    assert [count(h) for h in ("inner", "left", "left_semi", "left_anti")] == [91, 101, 91, 10]
    with pytest.raises(ValueError):
        count("outer")


def test_numbers(spark):
    assert one(spark, NUM.nearest_power_of_ten, 0.0, "double") == 0.0 and one(spark, NUM.nearest_power_of_ten, 0.02, "double") == pytest.approx(0.01)
    assert one(spark, NUM.to_number, " 1e3 ") == 1000.0 and one(spark, NUM.to_number, "1d") is None and one(spark, NUM.to_number, "1_000") is None
    assert one(spark, NUM.depth_text, " 12.5 m\n") == 12.5 and one(spark, NUM.depth_text, "61") is None
    assert one(spark, NUM.round_to_quarter, 0.375, "double") == 0.5 and one(spark, NUM.round_to_quarter, 0.125, "double") == 0.0
    counted = spark.createDataFrame([(1, 1.0, 2), (1, 3.0, 2), (2, 5.0, 3), (3, None, 2)], "k int, v double, n int")
    assert {r["k"]: r["m"] for r in NUM.median_of_counts(counted, ["k"], "v", "n", "m").collect()} == {1: 2.0, 2: 5.0}


def test_text_functions(spark):
    assert one(spark, X.numeric_value, "depth -3.5e0 m") == 3.5
    assert one(spark, lambda c: X.numeric_value(c, True), "350 CM") == 3.5 and one(spark, X.numeric_value, "none") is None
    assert one(spark, lambda c: X.closest_digits(c, F.lit(8)), "1 to 22 by 333") == "22"
    assert one(spark, X.level_method, "Hole collapased, estimated") == "collapsed" and one(spark, X.level_method, "not measured") is None
    assert sorted(one(spark, X.soil_types, "Soft SILT, sandy SAND. silt CLAY (GRAVEL)")) == ["CLAY", "SAND", "SILT"]
    assert one(spark, X.spt_value, "Nc > 50 for") == 50 and one(spark, X.spt_value, "none") is None
    assert one(spark, X.borehole_id, "/x/BH_123_log.pdf") == 123 and one(spark, X.borehole_id, "/x/a_1_b/BH.pdf") is None
    assert one(spark, lambda c: X.whole_term(c, "a factor"), "Net a factor: 0.8") and not one(spark, lambda c: X.whole_term(c, "gwl"), "gwls")
    assert one(spark, X.percentage_near_label, "10% off; energy ratio 72.5% at 30%") == 72.5 and one(spark, X.percentage_near_label, "10%") is None


# ---------------------------------------------------------------- sheets


def grid(spark, sheets):
    rows = [(name, i, line) for name, lines in sheets.items() for i, line in enumerate(lines.split("\n"))]
    return spark.createDataFrame(rows, "path string, row int, line string")


def test_text_file_end_to_end(spark, tmp_path):
    body = "\n".join(f"{k * 0.1:.1f},{k + 0.5},0.0{k},{-k}.0,ok" for k in range(1, 9))
    (tmp_path / "CPT_17").mkdir()
    (tmp_path / "CPT_17" / "CPT_17_a.csv").write_bytes(("Site,x\r\nDepth (m),qc (MPa),fs (MPa),u2 (MPa),note\r\n" + body.replace("\n", "\r\n")).encode("latin1"))
    (tmp_path / "CPT_17" / "CPT_17_b.txt").write_text("Depth  qc  u2\n" + "\n".join(f"{k}.5 {k}.1 {k}.2" for k in range(9)))
    (tmp_path / "CPT_18").mkdir()
    (tmp_path / "CPT_18" / "scan.pdf").write_bytes(b"x")
    (tmp_path / "CPT_18" / "CPT_18_c.csv").write_bytes(b"")
    good, failed = text.load(spark, str(tmp_path))
    rows = good.orderBy("row").collect()
    assert len(rows) == 8 and (rows[0]["depth"], rows[0]["qc"], rows[0]["fs"], rows[0]["u"]) == (0.1, 1.5, 0.01, -1.0)
    assert {(r["path"].split("/")[-1], r["category"], r["details"]) for r in failed.collect()} == {("CPT_17_b.txt", "missing_columns", "fs"), ("CPT_18_c.csv", "no_data", "empty file")}
    files = text.list_files(spark, str(tmp_path))
    assert {(r["file_name"], r["kind"], r["nzgd_id"]) for r in files.collect()} == {("CPT_17_a.csv", "spreadsheet", 17), ("CPT_17_b.txt", "spreadsheet", 17), ("scan.pdf", "nondata", 18), ("CPT_18_c.csv", "spreadsheet", 18)}
    assert text.listing_failures(files.where("suffix = '.pdf'")).head()["category"] == "no_data_files"
    assert text.listing_failures(files, {"CPT_17": ("corrupt_file", "empty columns")}).count() == 2


def test_cells(spark):
    assert one(spark, lambda c: S.split_cells(c, F.lit(" ")), "  a  b") == ["placeholder", "a", "b"]
    assert one(spark, lambda c: S.split_cells(c, F.lit(",")), "a, , b ") == ["a", None, "b"]
    assert one(spark, lambda c: S.without_quoted_delimiters(c, F.lit(",")), 'a,"b,c",d') == "a,bc,d"
    lines = grid(spark, {"a": "x;y\n1;2,5", "b": "word", "c": "a b c\nd e f"})
    assert {r["path"]: r["delimiter"] for r in S.delimiter_counts(lines, "path", "line").collect()} == {"a": ";", "b": None, "c": " "}


def test_candidates_and_claims(spark):
    df = spark.createDataFrame([("s", 0, ["Water depth", "Depth", "Dynamic res", "M", "m", None, "Final depth"])], "sheet string, row int, cells array<string>")
    kept = S.candidates(df).head()
    assert [c["col"] for c in kept["depth"]] == [1, 3] and [c["col"] for c in kept["u"]] == [2] or [c["col"] for c in kept["u"]] == [2, 0]
    assert S.candidates(df, sticky=True).head()["depth"] == []
    claims = S.claimed(S.candidates(df)).head()
    names = [c["name"] for p in K.PARAMETERS for c in claims[p]]
    assert "dynamic res" in [c["name"] for c in claims["qc"]] and [c["name"] for c in claims["u"]].count("dynamic res") == 0 and names


def test_two_line_header_and_column_choice(spark):
    lines = [["Hole", None], ["Depth", "qc", "qc", "fs", "u2", "Top"], ["m", "MPa", "MPa", "MPa", "MPa", "no"]]
    lines += [[f"{k}.1", f"{k}.2" if k < 5 else None, f"{k}.3", f"{k}.4", f"{k}.5", str(k)] for k in range(10)]
    df = spark.createDataFrame([("s", i, c) for i, c in enumerate(lines)], "sheet string, row int, cells array<string>")
    spans = S.header_spans(S.line_facts(df, "sheet"), S.header_rows(S.line_facts(df, "sheet"), "sheet"), "sheet").head()
    assert (spans["header_row"], spans["first"], spans["last"]) == (1, 1, 2)
    good, failed = S.extract(df, "sheet")
    rows = good.orderBy("row").collect()
    assert failed.count() == 0 and len(rows) == 10 and rows[7]["qc"] == 7.3 and rows[7]["depth"] == 7.1
    names = S.unique_names(S.merged_names(df, S.header_spans(S.line_facts(df, "sheet"), S.header_rows(S.line_facts(df, "sheet"), "sheet"), "sheet"), "sheet"), "sheet")
    assert {r["unique_name"] for r in names.collect()} == {"depth_m", "qc_mpa", "qc_mpa_2", "fs_mpa", "u2_mpa", "top_no"}
    assert S.extract(df.limit(0), "sheet")[0].count() == 0


# ---------------------------------------------------------------- mining


def test_metadata_grid(spark):
    sheet = [["Job", "x"], ["Ground water", None, None, "2.35 m measured"], ["Area ratio", "0.8"], ["a", "b"], ["alpha factor", None], [None, None], ["0.75", None], ["Remarks: target depth reached", None], ["gwl", "not found"], ["water level", "99"]]
    df = spark.createDataFrame([("s", i, c) for i, c in enumerate(sheet)], "sheet string, row int, cells array<string>")
    hits = M.neighbours(M.term_matches(df, "sheet"), df, "sheet")
    cand = M.search_candidates(hits, M.orientation(df, "sheet"), "sheet")
    got = {r["quantity"]: (r["value"], r["method"]) for r in M.resolve_numbers(cand, "sheet").collect()}
    assert got["ground_water_level"] == (2.35, "measured") and got["tip_net_area_ratio"][0] in (0.8, 0.75)
    row = {(r["row"], r["term"]): r for r in hits.collect()}
    assert row[(1, "ground water")]["right"] == "2.35 m measured" and row[(4, "alpha factor")]["below"] == "0.75" and row[(4, "alpha factor")]["above"] == "a"
    assert (4, "a factor") not in row
    assert one(spark, M.classify_ending, "Effective refusal.") == "refusal" and one(spark, M.classify_ending, "Target depth reached") == "target_depth" and one(spark, M.classify_ending, "lunch") is None
    ends = spark.createDataFrame([(1, "refusal"), (1, "target_depth"), (2, "target_depth"), (3, None)], "k int, r string")
    assert {r["k"]: r["r"] for r in M.prior_ending(ends, "k", "r").collect()} == {1: "refusal", 2: "target_depth", 3: None}


# ---------------------------------------------------------------- boreholes and AGS


def boxes():
    out = [("r", 0, 700.0, 710.0, 50.0, 90.0, "Depth (m)"), ("r", 0, 650.0, 660.0, 300.0, 420.0, "Hammer efficiency 71%")]
    out += [("r", 0, 600.0 - 100 * k, 610.0 - 100 * k, 60.0, 70.0, f"{k}.0") for k in range(5)]
    out += [("r", 0, 550.0, 560.0, 200.0, 260.0, "N = 12"), ("r", 0, 330.0, 340.0, 200.0, 260.0, "Nc > 50"), ("r", 0, 500.0, 510.0, 300.0, 420.0, "soft SILT, some SAND."), ("r", 0, 100.0, 110.0, 0.0, 1.0, None)]
    return out + [("q", 0, 1.0, 2.0, 0.0, 1.0, "nothing"), ("p", 0, 1.0, 2.0, 0.0, 1.0, "depth"), (None, 0, 1.0, 2.0, 0.0, 1.0, "depth")]


def test_depth_fit(spark):
    got = B.analyse(spark.createDataFrame(boxes(), schemas.PIPELINE["boxes"].simpleString()[7:-1].replace(":", " ").replace(",", ", "))).collect()
    spt = sorted((r["depth"], r["n"]) for r in got if r["kind"] == "spt")
    assert spt == [(0.5, 12), (2.75, 50)]
    soil = [r for r in got if r["kind"] == "soil"]
    assert soil[0]["soil_types"] == ["SAND", "SILT"] and soil[0]["depth"] == pytest.approx(1.0)
    assert [r["efficiency"] for r in got if r["kind"] == "efficiency"] == [71.0]
    assert {(r["report"], r["category"]) for r in got if r["kind"] == "failure"} == {("q", "no_depth_label"), ("p", "no_depth_scale")}


def test_numbers_left_aligned_under_a_wide_label(spark):
    page = [("Depth (m)", 100, 160, 700)] + [(str(k), 101, 107, 650 - 20 * k) for k in range(1, 6)] + [("N = 7", 300, 330, 650 - 20 * 2.5), ("3", 400, 410, 500)]
    rows = [("w", 0, float(y), float(y) + 8, float(a), float(b), t) for t, a, b, y in page]
    got = B.analyse(spark.createDataFrame(rows, "report string, page int, y0 double, y1 double, x0 double, x1 double, text string")).collect()
    assert [(r["depth"], r["n"]) for r in got if r["kind"] == "spt"] == [(2.5, 7)]
    assert not [r for r in got if r["kind"] == "failure"]


AGS = '"GROUP","SCPT"\r\n"HEADING","LOCA_ID","SCPT_DPTH","SCPT_RES","SCPT_FRES","SCPT_PWP2"\r\n"UNIT","","m","MPa","kPa","kPa"\r\n"TYPE","ID","2DP","2DP","2DP","2DP"\r\n"DATA","a","0.1","1.5","20",""\r\n"DATA","a","0.2","1.7","x","3"\r\n\r\n'
BH = '"GROUP","ISPT"\n"HEADING","ISPT_TOP","ISPT_MAIN"\n"UNIT","m",""\n"TYPE","2DP","X"\n"DATA","1.5","12"\n"GROUP","GEOL"\n"HEADING","GEOL_TOP","GEOL_DESC"\n"DATA","0.0","Brown ""hard"" CLAY, with SAND"\n"DATA","2.0","fill"\n"GROUP","HORN"\n"HEADING","T"\n"DATA","Hammer energy ratio 65%"'


def test_ags(spark):
    files = spark.createDataFrame([("a", AGS), ("b", AGS.replace("SCPT_PWP2", "SCPT_XXX")), ("c", '"GROUP","ABBR"\n"HEADING","X"\n'), ("d", "hello"), ("e", AGS.replace("SCPT_RES", "SCPT_DPTH")), ("f", BH), ("g", None)], "path string, text string")
    rows, names, failed = ags.cone_tests(files)
    assert [tuple(r)[2:] for r in rows.orderBy("row").collect()] == [(0.1, 1.5, 20.0, None), (0.2, 1.7, None, 3.0)]
    assert names.head()["fs_name"] == "fs kPa"
    assert {(r["path"], r["category"]) for r in failed.collect()} == {("b", "ags_missing_columns"), ("c", "ags_missing_table"), ("d", "no_ags_data_tables"), ("e", "ags_duplicate_headers"), ("f", "ags_missing_table"), ("g", "no_ags_data_tables")}
    counts, soils, efficiency = ags.borehole_groups(files)
    assert [tuple(r) for r in counts.collect()] == [("f", 1.5, "12")]
    assert [(r["top_depth"], sorted(r["soil_types"])) for r in soils.collect()] == [(0.0, ["CLAY", "SAND"])]
    assert {r["path"]: r["efficiency"] for r in efficiency.collect()}["f"] == 65.0


def test_water_strikes(spark):
    old = '**PROJ\n"x"\n**WSTG\n"*HOLE_ID","*WSTG_DPTH"\n"<UNITS>","m"\n"B1","2.5"\n"B1","bad"\n"B1","4.5"\n'
    new = '"GROUP","PROJ"\n"GROUP","WSTG"\n"HEADING","WSTG_DPTH"\n"UNIT","m"\n"DATA","3.0"\n'
    got = {r["path"]: (r["strikes"], r["median"]) for r in ags.water_strikes(spark.createDataFrame([("a", old), ("b", new), ("c", "x")], "path string, text string")).collect()}
    assert got["a"] == ([2.5, 4.5], 3.5) and got["b"][0] == [3.0] and got["c"] == (None, None)


# ---------------------------------------------------------------- workbooks


def workbook(rows, name="Sheet-1"):
    cells = "".join(f'<row r="{i}">' + "".join(f'<c r="{chr(65 + j)}{i}" t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else f'<c r="{chr(65 + j)}{i}"><v>{v}</v></c>' for j, v in enumerate(r) if v is not None) + "</row>" for i, r in enumerate(rows, 1))
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="{name}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{cells}</sheetData></worksheet>')
    return out.getvalue()


def test_workbooks(spark):
    good = workbook([["Depth", None, "qc"], [0.5, None, 2]])
    files = spark.createDataFrame([("a", ".xlsx", good), ("b", ".xls", b"broken"), ("c", ".xlsx", workbook([])), ("d", ".xlsx", workbook([["x"]])), ("e", ".csv", b"")], "path string, suffix string, content binary")
    cells, failed = excel.workbook_grids(files)
    assert [(r["sheet"], r["row"], r["cells"]) for r in cells.orderBy("row").collect()] == [("Sheet_1", 0, ["Depth", None, "qc"]), ("Sheet_1", 1, ["0.5", None, "2"])]
    assert {(r["path"], r["category"]) for r in failed.collect()} == {("b", "invalid_excel_file"), ("c", "no_data"), ("d", "only_one_line")}


# ---------------------------------------------------------------- load


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, o int")
    new = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, None, 1), (3, None, 1)], "k int, v string, o int")
    assert {(r["k"], r["v"]) for r in L.upsert(old, new, ["k"], ["o"]).collect()} == {(1, "a"), (2, "d"), (3, None)}
    assert {(r["k"], r["v"]) for r in L.insert_new(old, new, ["k"]).collect()} == {(1, "a"), (2, "b"), (3, None)}
    assert {(r["k"], r["v"]) for r in L.update_matched(old, new, "k", ["v"], ["o"]).collect()} == {(1, "a"), (2, "d")}


def test_keys_and_references(spark):
    df = spark.createDataFrame([(k % 7, k) for k in range(200)], "a int, b int")
    ids = L.surrogate_ids(df, ["a", "b"], "id").orderBy("a", "b").collect()
    assert [r["id"] for r in ids] == list(range(1, 201))
    dim = L.dimension_keys(spark.createDataFrame([("y",), ("x",), (None,), ("x",)], "p string"), "p")
    assert {tuple(r) for r in dim.collect()} == {(1, "x"), (2, "y")}
    rows = spark.createDataFrame([("x",), ("z",), (None,)], "p string")
    assert {tuple(r) for r in L.encode(rows, "p", dim, "i").collect()} == {("x", 1), ("z", None), (None, None)}
    assert [r[0] for r in L.unknown_values(rows, "p", dim).collect()] == ["z"]
    refs = L.back_references(spark.createDataFrame([(1, "7_AND_f_AND_0___8_AND_g_AND_0"), (2, "")], "duplicate_of long, removed_duplicates string"), spark.createDataFrame([(70, "7_AND_f_AND_0"), (80, "8_AND_g_AND_0")], "cpt_id long, sheet_key string"))
    assert {tuple(r) for r in refs.collect()} == {(70, 1), (80, 1)}
    assert one(spark, L.sheet_key_parts, "7_AND_f.csv_AND_0")["nzgd_id"] == 7 and one(spark, L.sheet_key_parts, "7_AND_f") is None
    fk = L.missing_references(spark.createDataFrame([(1,), (5,), (None,)], "r int"), "r", spark.createDataFrame([(1,)], "k int"), "k")
    assert [r[0] for r in fk.collect()] == [5]


def test_store_loaders(spark, tmp_path):
    """Every loader of the store; no foreign key is left without a target."""
    (tmp_path / "m.csv").write_text(
        "InvestigationId,nzgd_id,Latitude,Longitude,region,district,city,suburb,CreatedOn,LastModifiedOn,model_vs30_foster_2019,model_vs30_std_foster_2019,model_gwl_westerhoff_2018,x\n"
        'A,7,-43.5,172.6,R1,D1,C1,S1,2020-01-02T10:00:00,2021-03-04,300,20,-1.5,y\n"B, old",8,bad,,R2,D9,,,02/03/2020,,,,,\nB,8,-44.0,171.0,R2,,,,2020-05-06,,,,,\nC,9,-43,172,R1,,,,,,,,,\nD,,1,2,,,,,,,,,,\n'
    )
    from stratakit.sources.metadata import read_metadata

    meta = read_metadata(spark, str(tmp_path / "m.csv"))
    places = {p: L.dimension_keys(meta, p) for p in ("region", "district", "city", "suburb")}
    cpt, spt = (spark.createDataFrame([(k,) for k in ks], "nzgd_id int") for ks in ((7, 7), (8,)))
    records = {r["nzgd_id"]: r for r in L.investigation_records(meta, places, cpt, spt).collect()}
    assert set(records) == {7, 8} and (records[7]["type_id"], records[8]["type_id"]) == (1, 2)
    assert str(records[7]["investigation_date"]) == "2020-01-02" and records[8]["original_investigation_name"] == "B" and records[8]["latitude"] == -44.0
    assert records[7]["region_id"] == 1 and records[8]["region_id"] == 2 and records[8]["district_id"] is None and records[7]["model_vs30_stddev_foster_2019"] == 20.0

    mapping = spark.createDataFrame([(1, 7, "7_AND_a.csv_AND_0"), (2, 7, "7_AND_b.csv_AND_0"), (3, 8, "8_AND_c.csv_AND_0"), (4, 8, "broken")], "cpt_id long, nzgd_id int, sheet_key string")
    data = spark.createDataFrame([(7, "a.csv", "0", k, k / 2, 1.0, None, 0.5) for k in range(3)] + [(8, "z.csv", "0", 0, 9.0, 1.0, 1.0, 1.0)], "nzgd_id int, file_name string, sheet_name string, seq int, depth double, qc double, fs double, u double")
    rows = L.cpt_measurements(mapping, data)
    assert [tuple(r) for r in rows.orderBy("measurement_id").collect()] == [(1, 1, 0.0, 1.0, None, 0.5), (2, 1, 0.5, 1.0, None, 0.5), (3, 1, 1.0, 1.0, None, 0.5)]
    twice = L.back_references(spark.createDataFrame([(1, "7_AND_b.csv_AND_0")], "duplicate_of long, removed_duplicates string"), mapping)
    full = mapping.withColumns({"termination_reason": F.lit("refusal"), "ground_water_level": F.lit(2.0), "gwl_method": F.lit("dipper"), "tip_net_area_ratio": F.lit(0.8), "source_file": F.col("sheet_key")})
    flags = spark.createDataFrame([(1, "depth cm", ""), (1, "depth cm", "")], "cpt_id long, explicit_unit_conversions string, inferred_unit_conversions string")
    dims = L.fixed_dimensions(spark)
    models = meta.select("nzgd_id", F.col("model_gwl_westerhoff_2018").alias("model_gwl"))
    got = {r["cpt_id"]: r for r in L.cpt_reports(full, rows, models, dims["terminationreason"], dims["cptgroundwaterlevelmethod"], flags, twice).collect()}
    assert (got[1]["has_cpt_data"], got[1]["max_depth"], got[1]["did_explicit_unit_conversion"], got[1]["did_inferred_unit_conversion"], got[1]["gwl_residual"]) == (1, 1.0, 1, 0, 3.5)
    assert (got[2]["has_cpt_data"], got[2]["max_depth"], got[2]["min_depth"], got[2]["cpt_data_duplicate_of_cpt_id"]) == (0, 1.0, 0.0, 1)
    assert (got[3]["max_depth"], got[3]["cpt_data_duplicate_of_cpt_id"], got[3]["termination_reason_id"], got[3]["gwl_method_id"]) == (None, None, 1, 4)
    assert {n: d.count() for n, d in dims.items()} == {"type": 2, "terminationreason": 2, "cptgroundwaterlevelmethod": 6, "spttovs30hammertype": 3, "cpttovscorrelation": 7, "spttovscorrelation": 2, "vstovs30correlation": 2, "soiltypes": 6}

    found = B.analyse(spark.createDataFrame(boxes(), "report string, page int, y0 double, y1 double, x0 double, x1 double, text string"))
    ids = found.select("report").distinct().withColumn("borehole_id", F.abs(F.hash("report")) % 1000)
    store = B.store_reports(spark, found, ids)
    assert {n: d.count() for n, d in store.items()} == {"sptreport": 1, "sptmeasurements": 2, "soilmeasurements": 1, "soilmeasurementsoiltype": 2}
    for child, column, parent, key in (("sptmeasurements", "borehole_id", "sptreport", "borehole_id"), ("soilmeasurements", "report_id", "sptreport", "borehole_id"), ("soilmeasurementsoiltype", "soil_measurement_id", "soilmeasurements", "measurement_id")):
        assert L.missing_references(store[child], column, store[parent], key).count() == 0


def test_store(spark, tmp_path):
    where = str(tmp_path / "store")
    schemas.create_store(spark, where)
    schemas.create_store(spark, where)
    assert len(schemas.STORE) == 21 and all(spark.read.parquet(f"{where}/{n}").count() == 0 for n in ("region", "cptreport"))
    df = schemas.conform(spark.createDataFrame([(1, 2, "junk")], "cpt_id int, nzgd_id int, other string").withColumn("has_cpt_data", F.lit(1)), "cptreport")
    L.write_store(df, where, "cptreport")
    assert spark.read.parquet(f"{where}/cptreport").head()["cpt_id"] == 1
    m = spark.createDataFrame([(1, 0.5), (2, 0.7)], "nzgd_id int, depth double")
    L.write_extractions(m, m, where, 4)
    assert spark.read.parquet(f"{where}/extracted_data_per_record").count() == 2
    L.write_csv(m, f"{where}/csv")
    assert spark.read.option("header", True).csv(f"{where}/csv").count() == 2
    doc = L.borehole_json(spark.createDataFrame([(1, 2.0, 5), (1, 1.0, 4)], "b int, depth double, n int"), "b").head()["document"]
    assert doc == '{"measurements":[{"depth":1.0,"n":4},{"depth":2.0,"n":5}]}'


# ---------------------------------------------------------------- streaming


def test_streams(spark, tmp_path):
    lines = spark.createDataFrame([(1, "f", 2, ",", "1,2"), (2, "f", 3, ",", '1,"'), (3, "f", 4, ",", "1")], "line_id long, file_path string, line_no int, delimiter string, extraction string")
    lines.repartition(2).write.parquet(str(tmp_path / "in"))
    heads = spark.createDataFrame([("f", 0, "double"), ("f", 1, "double")], "file_path string, col_index_in_line int, cell_type string")
    stream = ingest.line_stream(spark, str(tmp_path / "in"), lines.schema)
    ingest.parse_stream(stream, heads, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    assert [r["line_id"] for r in spark.read.parquet(str(tmp_path / "out/loaded")).collect()] == [1]
    assert {r["line_id"]: r["reason"] for r in spark.read.parquet(str(tmp_path / "out/rejected")).collect()} == {2: "quoting", 3: "column_count"}
    t = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame([(1, "a", t), (1, "a", t), (2, "b", t + dt.timedelta(days=2))], "i long, k string, ts timestamp")
    ev.write.parquet(str(tmp_path / "ev"))
    src = spark.readStream.schema(ev.schema).parquet(str(tmp_path / "ev"))
    for df, n in ((ingest.once_per_key(src, ["i"], "ts"), 2), (ingest.counts_by_window(src, "ts", "k"), 1)):
        q = df.writeStream.format("memory").queryName(f"q{n}").outputMode("append").option("checkpointLocation", str(tmp_path / f"m{n}")).start()
        q.processAllAvailable()
        q.stop()
    assert spark.table("q2").count() == 2


# ---------------------------------------------------------------- pipelines


def test_pipelines(spark, tmp_path):
    from stratakit.plans import pipelines

    rec = tmp_path / "CPT_17"
    rec.mkdir()
    body = [f"{k * 10}.0,{k + 0.5},0.0{k},{k}.0" for k in range(1, 9)]
    head = ["Ground water: 1.5 m measured,x", "Remarks,target depth reached", "Area ratio,0.8", "Depth (cm),qc (MPa),fs (MPa),u2 (kPa)"]
    (rec / "CPT_17_a.csv").write_text("\n".join([*head, *body, "End of test,,,", "99.0,1.0,1.0,1.0"]))
    (rec / "CPT_17_b.csv").write_text("\n".join([*head, *body[:6]]))
    (rec / "CPT_17_c.xlsx").write_bytes(workbook([["Depth", "qc", "fs", "u2"], *[[k + 0.5, k + 0.25, 0.25, 0.5] for k in range(6)]]))
    (rec / "CPT_17_d.ags").write_text(AGS)
    (rec / "CPT_17_e.csv").write_text("word\nother")
    (rec / "noname.csv").write_text("\n".join([*head, *body]))
    (rec / "CPT_59414_a.csv").write_text("\n".join([*head, *body]))
    out, failed = pipelines.soundings(spark, str(tmp_path))
    rows = out.collect()
    assert {(r["file_name"], r["sheet_name"], r["investigation_number"]) for r in rows} == {("CPT_17_a.csv", "0", 0), ("CPT_17_c.xlsx", "Sheet_1", 1), ("CPT_17_d.ags", "0", 2)}
    a = sorted((r for r in rows if r["file_name"] == "CPT_17_a.csv"), key=lambda r: r["seq"])
    assert len(a) == 8 and a[0]["depth"] == pytest.approx(0.1) and a[0]["u"] == pytest.approx(0.001) and "CPT_17_b.csv" in a[0]["removed_duplicates"]
    assert {(r["file_name"], r["category"]) for r in failed.collect()} == {("CPT_17_e.csv", "no_data"), ("noname.csv", "bad_file_name_format"), ("CPT_59414_a.csv", "corrupt_file")}
    got = {r["file_name"]: r for r in pipelines.scalars(spark, str(tmp_path)).collect()}["CPT_17_a.csv"]
    assert (got["nzgd_id"], got["termination_reason"], got["ground_water_level"], got["gwl_method"], got["tip_net_area_ratio"]) == (17, "target_depth", 1.5, "measured", 0.8)
    (rec / "BH_9_x.ags").write_text(BH)
    assert pipelines.ags_boreholes(spark, str(tmp_path))[0].count() == 1
    assert pipelines.box_boreholes(spark.createDataFrame(boxes(), "report string, page int, y0 double, y1 double, x0 double, x1 double, text string")).count() > 3
