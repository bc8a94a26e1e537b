import pytest
from pyspark.sql import functions as F

from quillgraph.functions import fields as D
from quillgraph.functions import lines as L
from quillgraph.functions.packages import prefixes
from quillgraph.sources.exports import parse_lines


def machine(text):
    """The rule character by character."""
    done, piece, quoted, escaped = [], "", False, False
    for c in text:
        if escaped:
            piece, escaped = piece + c, False
        elif c == "\\":
            escaped = True
        elif c == '"':
            quoted, piece = not quoted, piece + c
        elif c == "," and not quoted:
            done.append(piece)
            piece = ""
        else:
            piece += c
    if piece:
        done.append(piece)
    strip = [p.strip() for p in done]
    return [p[1:-1] if p.startswith('"') and p.endswith('"') else p for p in strip]


TEXTS = ["", "2", '"NAME",0', "2,0", '2,0,"NM","LAST, FIRST"', "a,,b", "a,b,", ",", "a\\,b,c", '"a\\"b",c', '"', 'x,"', '"a,b', " 2 , 0 ", '""', 'a"b,c"d,e', "\t1\t,2", '"a""b",c', "a,\\", ",,", "a,,", '"a","b, c",', '"x",' * 100, '"' * 99 + ",a"]


def test_subscripts(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string").select("i", L.subscripts(F.col("t")).alias("s"))
    assert {r.i: r.s for r in df.collect()} == {i: machine(t) for i, t in enumerate(TEXTS)}


def test_parse_lines(spark):
    raw = ['^DD(2,.01,0)="NAME^RF^^0;1"', "GT.M 01-JAN", "ZWR", "", "   ", '^DD(0,0,"DT")=3180326', "^X(1)", '  ^DIC(2,0,"GL")="^DPT("\t', '^DD(2,1)="say ""hi"""', '^Größe(1)="x"', None]
    rows = parse_lines(spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "line_no long, raw string")).orderBy("line_no").collect()
    assert [(r.line_no, r.global_name, r.subscripts, r.value) for r in rows] == [(0, "DD", ["2", ".01", "0"], "NAME^RF^^0;1"), (7, "DIC", ["2", "0", "GL"], "^DPT("), (8, "DD", ["2", "1"], 'say "hi"'), (9, "Größe", ["1"], "x")]


CASES = [
    # value, type, required, pointer, computed, multiple, target
    ("N^RF", "F", True, False, False, False, None),
    ("N^P200'", "P", False, True, False, False, "200"),
    ("N^RP200'", "P", True, True, False, False, "200"),
    ("N^*P50.7'", "P", False, True, False, False, "50"),
    ("N^RC", "C", True, False, False, False, None),
    ("N^RM", "M", True, False, False, False, None),
    ("N^C", "C", False, False, True, False, None),
    ("N^M", "M", False, False, False, True, None),
    ("N^R", "F", True, False, False, False, None),
    ("N^RX", "R", True, False, False, False, None),
    ("N^200.01A", "F", False, False, False, False, None),
    ("N^c", "C", False, False, False, False, None),
    ("N^*S", "F", False, False, False, False, None),
    ("N^NJ3,0^r", "N", True, False, False, False, None),
    ("N", "F", False, False, False, False, None),
    ("N^*P", "P", False, True, False, False, None),
    ("", "F", False, False, False, False, None),
]


@pytest.mark.parametrize("case", CASES, ids=lambda c: c[0] or "empty")
def test_typing(spark, case):
    row = spark.createDataFrame([(case[0],)], "v string").select(*D.of_value(F.col("v")).values()).first()
    assert tuple(row) == case[1:]


def test_small_functions(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(L.unescape(F.lit('TEST""VALUE'))) == 'TEST"VALUE'
    assert one(prefixes(F.lit("ABC DEF, GHI JKL"))) == ["ABC", "DEF", "GHI", "JKL"]
    assert one(prefixes(F.lit("N/A"))) == []
    assert one(prefixes(F.lit(None).cast("string"))) == []
    assert one(D.nesting_level(F.lit("2.01"))) == 2
    assert one(D.parent_number(F.lit("2.011"))) == "2"
    assert one(D.is_subfile_header(F.lit("A SUB-FILE"), F.lit("x"))) is True
    assert one(D.is_subfile_header(F.lit("A"), F.lit("2.0"))) is False
    assert one(D.is_subfile_header(F.lit("A"), F.lit("x"))) is False
    assert one(D.with_caret(F.lit("DPT("))) == "^DPT("
    assert one(D.type_name(F.lit("W"))) == "Word Processing"
