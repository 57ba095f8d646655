import datetime as dt

import pytest
from pyspark.sql import functions as F

from sieveframe.functions import text
from sieveframe.operators import cleaning
from sieveframe.sources import csv_files
from sieveframe.sources.csv_files import load_clean, load_csv, load_inbox


@pytest.fixture
def write(tmp_path):
    def make(text, name="a.csv"):
        path = tmp_path / name
        path.write_bytes(text.encode("utf-8"))
        return str(path)

    return make


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_only_question_mark_and_blank_are_missing(spark, write):
    df = load_csv(spark, write('crop,grade,lot\nNA,?,"?"\n"",null,-\nrye,,None\n'))
    assert rows(df) == [("NA", None, None), (None, "null", "-"), ("rye", None, "None")]


def test_types_come_from_all_values(spark, write):
    header = "i,gap,f,b,bgap,t,sep,hex,nan,inf,pad,neg,void\n"
    first = "1,?,1.5,True,True,a,1,1,1.0,1.5, 7,-1,\n"
    second = "02,3,2,false,,1,\"1,000\",0x10,nan,inf,+8,-2,?\n"
    df = load_csv(spark, write(header + first + second))
    assert dict(df.dtypes) == {
        "i": "bigint", "gap": "bigint", "f": "double", "b": "boolean",
        "bgap": "string", "t": "string", "sep": "string", "hex": "string",
        "nan": "string", "inf": "double", "pad": "bigint", "neg": "bigint",
        "void": "string",
    }
    assert rows(df)[1] == (
        2, 3, 2.0, False, None, "1", "1,000", "0x10", "nan", float("inf"), 8, -2, None,
    )


def test_numbers_beyond_64_bits(spark, write):
    big, huge = str(2**63 + 1), str(2**64)
    df = load_csv(spark, write(f"u,over,minus,mixed\n{big},{huge},{big},{huge}\n1,2,-3,1.5\n"))
    assert dict(df.dtypes) == {
        "u": "decimal(20,0)", "over": "string", "minus": "string", "mixed": "string",
    }


def test_suffixes_of_other_languages_are_text(spark, write):
    df = load_csv(spark, write("a,b,c\n12d,1f,5L\n1,2,3\n"))
    assert set(dict(df.dtypes).values()) == {"string"}


def test_date_columns_by_name(spark, write):
    text = "dispatch_date,Update,shelf\n?,2021-07-04T08:30:00,2021-07-04\n2021-07-03,?,B7\n"
    df = load_csv(spark, write(text))
    assert df.dtypes == [("dispatch_date", "timestamp_ntz"), ("Update", "timestamp_ntz"), ("shelf", "string")]
    first, second = rows(df)
    assert first == (None, dt.datetime(2021, 7, 4, 8, 30), "2021-07-04")
    assert second == (dt.datetime(2021, 7, 3), None, "B7")


@pytest.mark.parametrize("cell, message", [
    ("01/25/2015", "not ISO 8601"), ("2015-01-25T10:00:00Z", "zone"),
])
def test_bad_dates_raise_at_load(spark, write, cell, message):
    with pytest.raises(ValueError, match=message):
        load_csv(spark, write(f"date\n2015-01-25\n{cell}\n"))


def test_quotes_and_short_lines(spark, write):
    df = load_csv(spark, write('a,b,c\n"x, ""y""",2,3\n"z",5\n'))
    assert rows(df) == [('x, "y"', 2, 3), ("z", 5, None)]


def test_long_lines_raise(spark, write):
    with pytest.raises(ValueError, match="more cells"):
        load_csv(spark, write("a,b\n1,2\n1,2,3\n"))


def test_line_breaks_in_cells(spark, write):
    path = write('a,b\n"x\ny",2\n"z",5\n')
    with pytest.raises(ValueError, match="multi_line"):
        load_csv(spark, path)
    assert rows(load_csv(spark, path, multi_line=True)) == [("x\ny", 2), ("z", 5)]


def test_declared_types_need_no_look(spark, write):
    df = load_csv(spark, write("d,n,t\n2015-01-02,1,?\n"), {"d": "timestamp_ntz", "n": "int"})
    assert [k for _, k in df.dtypes] == ["timestamp_ntz", "int", "string"]
    assert rows(df)[0][1:] == (1, None)


def test_a_declared_date_that_is_none_raises_when_read(spark, write):
    df = load_csv(spark, write("d\nsoon\n"), {"d": "timestamp_ntz"})
    with pytest.raises(Exception, match="d is no date without a zone: soon"):
        df.collect()


def test_header_only(spark, write):
    df = load_csv(spark, write("a,b\n"))
    assert df.columns == ["a", "b"] and df.isEmpty()


def test_an_empty_file_raises(spark, write):
    with pytest.raises(ValueError, match="no header"):
        load_csv(spark, write(""))


def test_inbox_reads_every_csv(spark, write, tmp_path):
    write("x\n1\n", "b.csv")
    write("y\n2.5\n3\n", "a.csv")
    write("ignore me", "notes.txt")
    loaded = load_inbox(spark, str(tmp_path))
    assert list(loaded) == ["a", "b"]
    assert rows(loaded["a"]) == [(2.5,), (3.0,)]


def test_load_clean_equals_the_two_steps(spark, write):
    text = (
        "Claim ID,In Credit,collision-type,_c39,Bind Date,Note\n"
        '1, YES ,?,,2015-01-01,"  "\n1,YES,,,2015-01-01,\n2,?,Rear,,2015-01-02,x\n'
    )
    path, fills = write(text), {"collision_type": "none", "absent": 1}
    once = load_clean(spark, path, fills)
    steps = cleaning.clean(load_csv(spark, path), fills)
    assert once.schema == steps.schema
    assert sorted(map(str, rows(once))) == sorted(map(str, rows(steps)))
    assert dict(once.dtypes)["in_credit"] == "boolean"
    assert "c39" not in once.columns
    assert once.count() == 2


def test_the_look_is_one_small_aggregate(spark, write):
    names, raw = csv_files.read_text_cells(spark, write("a,b\n1,2\n"))
    looks = csv_files._type_looks(names)
    plan = raw.select(*(x.alias(str(i)) for i, x in enumerate(looks)))
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_looks_do_not_add_up_in_one_method(spark, write):
    """Cells are rows to the look: a wide file has the plan of a narrow one."""
    def code(width):
        names = [f"c{i}" for i in range(width)]
        path = write(",".join(names) + "\n" + ",".join("1" * width) + "\n", f"w{width}.csv")
        _, raw = csv_files.read_text_cells(spark, path)
        seen = []
        taken = type(raw).collect
        try:
            type(raw).collect = lambda df: seen.append(df) or taken(df)
            assert csv_files._seen(raw, names, path, F.col("cell"))[0] == [csv_files._INT] * width
        finally:
            type(raw).collect = taken
        return seen[0]._jdf.queryExecution().executedPlan().toString().count("RLIKE")

    assert code(3) == code(40) > 0


@pytest.mark.parametrize("cell", ["yes", "No", "Y", "n", "YES", "ynot", "ŉ", "ﬃ", "ſ", "İ", "inf", "Infinity", "i", "I1", "True", "A", "\x7f1", "é", "-1", "+1.5", ".5", "1 "])
def test_looks_equal_those_without_a_first_byte(spark, write, cell):
    frame = spark.createDataFrame([(cell,)], "cell0 string")
    plain = csv_files._TYPE_LOOK.split("THEN", 1)[0] + "THEN 1 WHEN cell RLIKE" + csv_files._TYPE_LOOK.split("WHEN cell RLIKE", 1)[1]
    got = frame.select(csv_files._type_looks(["a"])[0], F.expr(plain.replace("cell", "cell0")), text.is_yes_no(F.col("cell0"))).first()
    assert got[0] == got[1]
    assert got[2] == (cell.upper() in text.YES_WORDS + text.NO_WORDS)


def test_missing_and_repeated_names(spark, write):
    df = load_csv(spark, write("\ufeffid,,a,A,a,a.1\n1,2,3,4,5,6\n"))
    assert df.columns == ["id", "Unnamed: 1", "a", "A", "a.1", "a.1.1"]
    assert rows(df) == [(1, 2, 3, 4, 5, 6)]


def test_names_with_dots_and_backticks(spark, write):
    df = load_csv(spark, write("a.b,c`d,date.x\n1,x,2015-01-01\n"))
    assert df.columns == ["a.b", "c`d", "date.x"]
    assert cleaning.clean(df).columns == ["a_b", "c_d", "date_x"]


@pytest.mark.parametrize("text", ["a,b\n1,2,3\n", 'a,b\n1,"x\ny"\n', "a,b,c\n1,2,,4\n", "a,b,c\n1,2,?,4\n"])
@pytest.mark.parametrize("types", [None, {"a": "bigint"}])
def test_lines_that_would_lose_cells_are_refused(spark, write, text, types):
    with pytest.raises(Exception, match="more cells than the header|not as wide|inside quotes"):
        load_csv(spark, write(text), types).select("a").collect()


def test_short_lines_and_quoted_commas_are_fine(spark, write):
    path = write('a,b,c\n1\n2,"x,,,y ""q"" ,"\n3,,\n')
    want = [(1, None, None), (2, 'x,,,y "q" ,', None), (3, None, None)]
    assert rows(load_csv(spark, path)) == want
    assert rows(load_csv(spark, path, {"a": "bigint"})) == want


def test_a_declared_date_with_a_zone_is_refused(spark, write):
    df = load_csv(spark, write("d\n2015-01-25T10:00:00+02:00\n"), {"d": "timestamp_ntz"})
    with pytest.raises(Exception, match="without a zone"):
        df.collect()


def test_parts_with_another_header_are_refused(spark, write, tmp_path):
    write("a,b\n1,2\n", "one.csv")
    write("b,a\n3,4\n", "two.csv")
    with pytest.raises(Exception, match="(?i)header"):
        load_csv(spark, str(tmp_path)).collect()


def test_inbox_names_may_look_like_patterns(spark, write, tmp_path):
    write("a\n1\n", "x[1].csv")
    write("a\n2\n", "y{2}.csv")
    found = load_inbox(spark, str(tmp_path))
    assert {n: rows(df) for n, df in found.items()} == {"x[1]": [(1,)], "y{2}": [(2,)]}
