"""Known answers of the three dialects and the header rule (FIXTURES §3)."""

import pytest
from pyspark.sql import functions as F

from conftest import write
from tidewater.sources.delimited import (header_contains_filter, parse_quoted, parse_remainder,
                                         read_quoted, read_remainder, read_strict)

ABC = ("a", "b", "c")


def rows(df, cols=ABC):
    return [tuple(r[c] for c in cols) + (r["_bad"],) for r in df.collect()]


def lines_df(spark, *lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_strict_header_binds_by_position_and_no_quoting(spark, tmp):
    p = write(f"{tmp}/f.csv", 'X|Y|Z\n1|"q|z\n')
    assert rows(read_strict(spark, p, ABC, "|")) == [("1", '"q', "z", False)]


def test_strict_empty_field_is_null_and_blank_line_ignored(spark, tmp):
    p = write(f"{tmp}/f.csv", "h|h|h\n2||w\n\n3|x|y\n")
    assert sorted(rows(read_strict(spark, p, ABC, "|"))) == [("2", None, "w", False), ("3", "x", "y", False)]


def test_strict_short_and_long_lines_are_bad_even_for_narrow_queries(spark, tmp):
    p = write(f"{tmp}/f.csv", "h|h|h\n1|2\n1|2|3|4\n5|6|7\n")
    df = read_strict(spark, p, ABC, "|")
    assert df.filter("_bad").count() == 2
    # a one-column projection and a bare count still see the arity errors
    assert df.select("a", "_bad").filter("_bad").count() == 2
    assert df.agg(F.sum(F.col("_bad").cast("int"))).first()[0] == 2


def test_strict_first_line_of_every_file_is_skipped(spark, tmp):
    write(f"{tmp}/d/f1.csv", "head|er|x\n1|2|3\n")
    write(f"{tmp}/d/f2.csv", "other|head|er\n4|5|6\n")
    got = sorted(r["a"] for r in read_strict(spark, f"{tmp}/d", ABC, "|").collect())
    assert got == ["1", "4"]


def test_quoted_quotes_doubling_and_separator_inside(spark):
    df = parse_quoted(lines_df(spark, '1,"a,b","x ""q"" y"'), ABC, ",")
    assert rows(df) == [("1", "a,b", 'x "q" y', False)]


def test_quoted_empties_are_empty_strings(spark):
    assert rows(parse_quoted(lines_df(spark, '1,,""'), ABC, ",")) == [("1", "", "", False)]


def test_quoted_blank_line_unclosed_quote_and_wrong_arity_are_bad(spark):
    df = parse_quoted(lines_df(spark, "", '1,"ab,3', "1,2", "1,2,3,4"), ABC, ",")
    assert [r["_bad"] for r in df.collect()] == [True, True, True, True]


def test_remainder_last_column_takes_the_rest(spark):
    df = parse_remainder(lines_df(spark, "a|b|c|d||", "a|b|", "a|b", ""), ABC, "|")
    got = rows(df)
    assert got[0] == ("a", "b", "c|d||", False)
    assert got[1] == ("a", "b", "", False)
    assert got[2][3] is True and got[3][3] is True


def test_remainder_separator_is_literal(spark):
    df = parse_remainder(lines_df(spark, "1.2.3.4"), ("x", "y"), ".")
    assert rows(df, ("x", "y")) == [("1", "2.3.4", False)]


def test_header_contains_drops_any_matching_line_any_case_with_wildcards(spark):
    lines = lines_df(spark, "A|B|C", "data with a inside", "x|y|z", "ALL_R here", "small ring", "nothing")
    got = [r["value"] for r in header_contains_filter(lines, "all_r").collect()]
    assert got == ["A|B|C", "data with a inside", "x|y|z", "nothing"]


def test_read_quoted_and_remainder_files_drop_header_by_content(spark, tmp):
    write(f"{tmp}/q/f.csv", 'a,b,c\n1,"x,y",z\n')
    write(f"{tmp}/r/f.txt", "a|b|c\n1|x|y|z\n")
    assert rows(read_quoted(spark, f"{tmp}/q", ABC, ",")) == [("1", "x,y", "z", False)]
    assert rows(read_remainder(spark, f"{tmp}/r", ABC, "|")) == [("1", "x", "y|z", False)]


def test_first_line_header_mode_for_quoted_and_remainder(spark, tmp):
    write(f"{tmp}/q/f1.csv", 'id,b,c\n1,"a,b",x\nrow a,2,y\n')
    write(f"{tmp}/q/f2.csv", 'other,header,line\n2,"q""q",z\n')
    got = sorted(rows(read_quoted(spark, f"{tmp}/q", ABC, ",", header="first_line")))
    # the data line containing the first column's name ("a") is kept in this mode
    assert got == [("1", "a,b", "x", False), ("2", 'q"q', "z", False), ("row a", "2", "y", False)]
    write(f"{tmp}/r/f1.txt", "x|y|z\n1|2|3|\u0001|4\n")
    assert rows(read_remainder(spark, f"{tmp}/r", ABC, "|", header="first_line")) == [
        ("1", "2", "3|\u0001|4", False)]


def test_line_based_strict_parse_matches_the_csv_source(spark, tmp):
    from tidewater.sources.delimited import parse_strict, read_lines_after_header
    write(f"{tmp}/s/f1.csv", 'X|Y|Z\n1|"q|z\n2||w\n\n1|2\n1|2|3|4\n  \n')
    write(f"{tmp}/s/f2.csv", "h|h|h\n5|6|7\n")
    def view(df):
        return sorted((r["_bad"], r["a"], r["b"], r["c"]) if not r["_bad"] else (True, r["_line"])
                      for r in df.collect())
    via_csv = view(read_strict(spark, f"{tmp}/s", ABC, "|"))
    via_lines = view(parse_strict(read_lines_after_header(spark, f"{tmp}/s"), ABC, "|"))
    assert via_csv == via_lines
    assert len(via_csv) == 5


def test_quoted_lines_as_the_csv_module_reads_them(spark):
    """10,000 random lines of the characters that matter."""
    import csv
    import random

    from tidewater.sources.delimited import parse_quoted

    rng = random.Random(11)
    for sep, alphabet in ((",", 'ab", ,""'), ("|", 'a"|| "é'), ("\t", 'x"\t\t" ^')):
        lines = list({"".join(rng.choice(alphabet) for _ in range(rng.randrange(14))) for _ in range(8000)})
        rows = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k int, value string")
        for n in (1, 3):
            got = {r["k"]: r for r in parse_quoted(rows, [f"c{i}" for i in range(n)], sep).collect()}
            for k, line in enumerate(lines):
                fields = next(csv.reader([line], delimiter=sep), [])
                assert got[k]["_bad"] == (len(fields) != n), (line, fields, got[k])
                if len(fields) == n:
                    assert [got[k][f"c{i}"] for i in range(n)] == fields, line


def test_long_quoted_fields(spark):
    from tidewater.sources.delimited import parse_quoted
    text = 'x""' * 400_000
    rows = spark.createDataFrame([(f'1,"{text}"tail,"open {text}',)], "value string")
    row = parse_quoted(rows, ["a", "b", "c"], ",").first()
    assert (row["b"], row["c"]) == (text.replace('""', '"') + "tail", "open " + text.replace('""', '"'))


@pytest.mark.parametrize("sep", ["", "||", '"', "\n"])
def test_separators_that_csv_does_not_take(spark, sep):
    from tidewater.sources.delimited import quoted_fields
    with pytest.raises(ValueError):
        quoted_fields(F.col("value"), sep)
