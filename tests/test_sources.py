"""Typed CSV reading: numeric guard, missing words, NaN, encodings, snake_case."""

import pytest

from quarry.sources.csv import PANDAS_NA_WORDS, Col, read_csv, snake_case


@pytest.fixture()
def csv_path(tmp_path):
    p = tmp_path / "t.csv"
    p.write_bytes("id,Price (EUR),Note,When\n"
                  "1,4.50,caf\xe9,2020-01-02 03:04:05\n"
                  "2,4d,NA,\n"
                  "3,nan,\"multi\nline, quoted\",2021-12-31 23:59:00\n"
                  "4, 7 ,N/A,not a time\n".encode("latin-1"))
    return str(p)


def test_typed_columns_and_guards(spark, csv_path):
    cols = [Col("id", "id", "long"), Col("Price (EUR)", "price", "double"), Col("Note", "note"),
            Col("When", "ts", "timestamp_ntz")]
    rows = read_csv(spark, csv_path, cols, encoding="ISO-8859-1", null_words=PANDAS_NA_WORDS,
                    multiline=True).orderBy("id").collect()
    assert [r.price for r in rows] == [4.5, None, None, 7.0]          # '4d' and 'nan' are not numbers
    assert [r.note for r in rows] == ["café", None, "multi\nline, quoted", None]
    assert rows[0].ts.year == 2020 and rows[1].ts is None and rows[3].ts is None


def test_default_null_words_keep_na_text(spark, csv_path):
    rows = read_csv(spark, csv_path, [Col("id", "id", "int"), Col("Note", "note")],
                    encoding="ISO-8859-1", multiline=True).orderBy("id").collect()
    assert rows[1].note == "NA" and rows[3].note == "N/A"


def test_all_columns_snake_case_and_drop(spark, csv_path):
    df = read_csv(spark, csv_path, encoding="ISO-8859-1", drop=["Note"], multiline=True)
    assert df.columns == ["id", "price_eur", "when"]
    assert snake_case("Days for shipping (real)") == "days_for_shipping_real"


def test_single_line_reads_are_splittable(spark, tmp_path):
    p = tmp_path / "big.csv"
    p.write_text("a,b\n" + "".join(f"{i},{i * 2}\n" for i in range(200000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "262144")
    try:
        df = read_csv(spark, str(p), [Col("a", "a", "long"), Col("b", "b", "long")])
        assert df.rdd.getNumPartitions() > 1 and df.count() == 200000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_undeclared_columns_large_ids_and_fractions_survive(spark, tmp_path):
    from quarry.sources.csv import Col, read_csv
    path = tmp_path / "wide.csv"
    path.write_text("Id,Some Note,Score,Secret\n9007199254740993,kept,4.125,x\n1.7,also kept,4.126,y\n1e3,,2,z\n-5.0,k,,w\n")
    df = read_csv(spark, str(path), [Col("Id", "id", "long"), Col("Score", "score", "double")], drop=["Secret"])
    assert dict(df.dtypes) == {"id": "bigint", "score": "double", "some_note": "string"}
    assert [r["id"] for r in df.collect()] == [9007199254740993, None, 1000, -5]
    assert [r["some_note"] for r in df.collect()] == ["kept", "also kept", None, "k"]


def test_three_decimal_scores_are_averaged_exactly(spark):
    from quarry.operators.fanout import fanout_summary, review_weights
    items = spark.createDataFrame([("o1", "i1", "c", 10.0)], "o string, i string, c string, p double")
    reviews = spark.createDataFrame([("o1", 4.125), ("o1", 4.126)], "o string, s double")
    row = fanout_summary(review_weights(items, reviews, "o", "o", "s"), ["c"], "o", "i", "p", digits=4).first()
    assert row["avg_rating"] == 4.1255 and row["orders"] == 1 and row["items_sold"] == 2


def test_register_views(spark):
    from quarry import catalog
    catalog.register_views({"some_rows": spark.range(3)})
    assert spark.sql("SELECT COUNT(*) FROM some_rows").first()[0] == 3
