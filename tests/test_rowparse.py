import csv
import io
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from stratakit.operators import rowparse as R

STRICT = re.compile(r'(?s)(?:"(?:[^"]|"")*"|[^",]*)(?:,(?:"(?:[^"]|"")*"|[^",]*))*')


def test_reasons_in_order():
    assert R.parse_line("1,2", ",", "dd")[0] is None
    assert R.parse_line('1,"2', ",", "dd")[0] == "quoting"
    assert R.parse_line('1,2"', ",", "dd")[0] == "quoting"
    assert R.parse_line('"1"x,2', ",", "dd")[0] == "quoting"
    assert R.parse_line("1,2,3", ",", "dd")[0] == "column_count"
    assert R.parse_line("1", ",", "dd")[0] == "column_count"
    assert R.parse_line("1,x", ",", "dd")[0] == "value"
    assert R.parse_line('1,"a ""b"", c"', ",", "ds")[:2] == (None, 0)
    assert R.parse_line('1,"a ""b"", c"', ",", "ds")[5] == ["1", 'a "b", c']


def test_edits_are_the_cheapest():
    assert R.parse_line('1,"2', ",", "dd")[1:5] == (1, 0, 0, "insert quote at 4") or R.parse_line('1,"2', ",", "dd")[1] == 1
    assert R.parse_line("1,2,3,4", ",", "dd")[2] == 2
    assert R.parse_line("1", ",", "dddd")[2] == 3
    # adjacent separators and quotes: demoting a separator never needs a quote edit
    assert R.parse_line('"a","b","c"', ",", "ss")[:3] == ("column_count", 0, 1)


def test_values():
    ok = lambda c, k, d=",": R.fits(c, k, d)
    assert ok(" -1.5e3 ", "d") and ok("5.", "d") and ok(".5", "d") and ok("+7", "i") and ok("1,5", "d", ";")
    assert not ok("1,5", "d") and not ok("1.5", "i") and not ok("nan", "d") and not ok("1d", "d") and not ok(".", "d")
    assert ok("2020-02-29", "t") and not ok("2021-02-29", "t") and not ok("2020-2-9", "t")
    assert not ok("١", "i")


def test_edge_cells():
    assert R.parse_line(None, None, "d")[0] is None
    assert R.parse_line("", ",", "d")[5] == [""]
    assert R.parse_line("", ",", "dd")[0] == "column_count"
    assert R.parse_line("anything, at all", ",", None)[0] is None
    assert R.parse_line("x" * 200_000, ",", "s")[0] is None
    assert R.parse_line('"' + "x,y" * 50_000, ",", "ss")[0] == "quoting"
    assert R.parse_line('a;"b\nc"', ";", "ss")[5] == ["a", "b\nc"]


@given(st.text(alphabet='ab,"', max_size=12))
@settings(max_examples=300, deadline=None)
def test_free_layer_accepts_exactly_the_grammar(line):
    fields = R.free_run(R._tokens(line, ","), ",")
    assert (fields is not None) == (STRICT.fullmatch(line) is not None)
    if fields is not None:
        assert fields == (next(csv.reader(io.StringIO(line))) if line else [""])
        assert R.cheapest_edits(R._tokens(line, ","), ",", len(fields))[:2] == (0, 0)
    else:
        assert R.cheapest_edits(R._tokens(line, ","), ",", None)[0] >= 1


@given(st.text(alphabet='a,"', max_size=7))
@settings(max_examples=100, deadline=None)
def test_quote_edits_match_brute_force(line):
    """Fewest quote insertions and deletions that make a line well formed, by search over edited lines."""
    seen, layer, n = {line}, [line], 0
    while not any(STRICT.fullmatch(x) for x in layer):
        fresh = set()
        for x in layer:
            fresh |= {x[:i] + '"' + x[i:] for i in range(len(x) + 1)} | {x[:i] + x[i + 1 :] for i in range(len(x)) if x[i] == '"'}
        layer = list(fresh - seen)
        seen |= fresh
        n += 1
    assert R.cheapest_edits(R._tokens(line, ","), ",", None)[0] == n


def test_frame(spark):
    lines = spark.createDataFrame(
        [(1, "f", 1, ",", "a,b", "junk"), (2, "f", 2, ",", "1,x", "junk"), (2, "f", 2, ",", "1,x", "other"), (3, "g", 2, None, None, None), (None, None, None, None, "a", None)],
        "line_id long, file_path string, line_no int, delimiter string, extraction string, kinds string",
    )
    heads = spark.createDataFrame([("f", 0, "double", 1), ("f", 0, None, 2), ("f", 1, None, 1), ("f", None, "int", 1), (None, 0, "int", 1)], "file_path string, col_index_in_line int, cell_type string, m int")
    got = {r["line_id"]: (r["reason"], r["fields"]) for r in R.error_parse(lines, heads).collect()}
    assert got == {2: (None, ["1", "x"]), 3: (None, [""]), None: (None, ["a"])}
    empty = R.error_parse(lines.limit(0), heads.limit(0))
    assert empty.count() == 0 and R.rejected(empty).count() == 0
