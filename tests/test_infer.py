"""Types of undeclared CSV columns against DuckDB's reader, and rows of a wrong field count."""

import datetime as dt
from decimal import Decimal

import duckdb
import pytest

from quarry.sources.csv import Col, read_csv
from quarry.sources.infer import infer_kinds

COLUMNS = {
    "whole": ["1", "-7", "", "42"], "zero": ["0", "-0", "1", ""], "number": ["1", "2.5", "", "-3e2"], "dots": [".5", "5.", "", "0.25"],
    "flag": ["true", "False", "", "TRUE"], "short_flag": ["t", "f", "", "t"], "yes_no": ["yes", "No", "", "no"],
    "postcode": ["0042", "7", "", "1"], "dial": ["+5", "6", "", "7"], "padded": ["00.5", "1.5", "", "2"],
    "day": ["2020-01-02", "", "1999-12-31", "2020-02-29"], "loose_day": ["2020-1-2", "", "1999-12-31", "2020-02-29"],
    "moment": ["2020-01-02 03:04:05", "2020-01-02 00:00:00", "", "2021-12-31 23:59:59"], "minute": ["2020-01-02 03:04", "", "2020-01-02 00:00", "2020-01-02 23:59"],
    "day_or_moment": ["2020-01-02", "2020-01-02 10:00:00", "", "2020-01-02"], "dmy_moment": ["25/12/2020 10:00", "01/02/2020 11:00", "", "x"],
    "words": ["a", "b", "", "c"], "mixed": ["1", "x", "", "2"], "late": ["1", "2", "3", "4d"], "none": ["", "", "", ""],
    "bad_day": ["2020-02-30", "2020-01-01", "", "2020-01-01"], "big": ["9223372036854775807", "-9223372036854775808", "", "0"],
    "infinite": ["1.5", "inf", "", "-2"],
    "bigger": ["9223372036854775808", "1", "", "-5"],
    # one column a file: the other reader takes one order of day and month for all of a file
    "dmy": ["25/12/2020", "01/02/2020", "", "31/01/1999"], "mdy": ["12/25/2020", "01/02/2020", "", "01/31/1999"], "either": ["01/02/2020", "3/4/2020", "", "05/06/1999"],
}
# our names for DuckDB's
SAME = {"BIGINT": "bigint", "DOUBLE": "double", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "VARCHAR": "string",
        "HUGEINT": "decimal(38,0)"}


def _write(path, columns):
    lines = ["id," + ",".join(columns)] + [",".join([str(i), *(c[i] for c in columns.values())]) for i in range(4)]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_types_and_values_equal_duckdb(spark, tmp_path):
    alone = ["dmy", "mdy", "either"]
    files = [{n: c for n, c in COLUMNS.items() if n not in alone}] + [{n: COLUMNS[n]} for n in alone]
    for i, columns in enumerate(files):
        path = _write(tmp_path / f"t{i}.csv", columns)
        want = duckdb.sql(f"SELECT * FROM read_csv('{path}', sample_size=-1)")
        got = read_csv(spark, path, infer=True)
        assert dict(got.dtypes) == {n: SAME[str(t)] for n, t in zip(want.columns, want.types)}
        assert [tuple(r) for r in got.collect()] == want.fetchall()


def test_one_late_row_decides_over_all_partitions(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text("a,b,c\n" + "".join(f"{i},{i},{i}\n" for i in range(50_000)) + "1.5,x,99999999999999999999\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "131072")
    try:
        df = read_csv(spark, str(path), infer=True)
        assert df.rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert dict(df.dtypes) == {"a": "double", "b": "string", "c": "decimal(38,0)"}
    assert df.filter("b = 'x'").first()["c"] == Decimal("99999999999999999999")   # no digit lost


def test_declared_columns_keep_their_type_and_null_words_do_not_count(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text("Id,Height cm,When\n1,180,2020-01-02T00:00\n2,NA,2020-01-02 10:00\n")
    df = read_csv(spark, str(path), [Col("Id", "id", "string")], null_words=("", "NA"), infer=True)
    assert dict(df.dtypes) == {"id": "string", "height_cm": "bigint", "when": "timestamp_ntz"}
    assert [tuple(r) for r in df.collect()] == [("1", 180, dt.datetime(2020, 1, 2)), ("2", None, dt.datetime(2020, 1, 2, 10))]


def test_nan_is_a_missing_number_and_digits_beyond_a_decimal_make_a_double(spark, tmp_path):
    path = tmp_path / "n.csv"
    path.write_text("a,b\nnan,1.5\n2.5,NaN\n")
    df = read_csv(spark, str(path), infer=True)
    assert [tuple(r) for r in df.collect()] == [(None, 1.5), (2.5, None)]
    df = spark.createDataFrame([("1" * 39, "10:00:00", "1e999"), ("1", "11:00:00", "1")], "a string, b string, c string")
    assert {n: k.dtype for n, k in infer_kinds(df, df.columns).items()} == {"a": "double", "b": "string", "c": "string"}
    assert infer_kinds(df, []) == {}
    assert {k.name for k in infer_kinds(df.limit(0), df.columns).values()} == {"text"}


@pytest.mark.parametrize("multiline", [False, True])
def test_rows_of_a_wrong_field_count_are_kept_and_counted(spark, tmp_path, multiline):
    path = tmp_path / "m.csv"
    path.write_text('id,n,note\n1,10,ok\n2,20\n3,x,long,one,more\n4,40,"a, quoted"\n5,,\n')
    df = read_csv(spark, str(path), infer=True, rescue="raw_row", multiline=multiline)
    assert df.columns == ["id", "n", "note", "raw_row"] and dict(df.dtypes)["n"] == "bigint"   # 'x' is in a broken row
    rows = {r["id"]: r for r in df.collect()}
    assert len(rows) == 5 and {i for i, r in rows.items() if r["raw_row"]} == {2, 3}
    assert rows[3]["raw_row"].strip() == "3,x,long,one,more" and rows[2]["n"] == 20 and rows[4]["note"] == "a, quoted"
    assert df.filter("raw_row IS NOT NULL").count() == 2
    assert df.select("note").count() == 5
