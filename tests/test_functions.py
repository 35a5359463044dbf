import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.functions import casts, messages, predicates


def one(spark, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}")


def value(df, column):
    return df.select(column.alias("y")).first().y


@pytest.mark.parametrize(
    "text, pattern, expected",
    [
        ("31.12.2017", casts.DOTTED_DATE, "2017-12-31"),
        ("1.2.2018", casts.DOTTED_DATE, "2018-02-01"),
        ("2018-02-01", casts.ISO_DATE, "2018-02-01"),
    ],
)
def test_dates(spark, text, pattern, expected):
    assert value(one(spark, text), casts.parse_date(F.col("x"), pattern)) == day(expected)


def test_bad_date_fails_or_is_null(spark):
    df = one(spark, "31.02.2018")
    with pytest.raises(Exception):
        value(df, casts.parse_date(F.col("x"), casts.DOTTED_DATE))
    assert value(df, casts.parse_date(F.col("x"), casts.DOTTED_DATE, lenient=True)) is None


def test_text_is_cut_and_null_stays(spark):
    assert value(one(spark, "ABCDEF"), casts.cut_text(F.col("x"), 3)) == "ABC"
    assert value(one(spark, None), casts.cut_text(F.col("x"), 3)) is None
    assert value(one(spark, 12345, "int"), casts.cut_text(F.col("x"), 3)) == "123"


def test_missing_tokens(spark):
    df = spark.createDataFrame([("NULL", 1), ("nan", 2), ("", 3), ("kept", 4)], "t string, n int")
    assert rows(casts.null_tokens(df)) == sorted(
        [(None, 1), (None, 2), (None, 3), ("kept", 4)], key=str
    )


def test_typed_keeps_long_numbers_and_leading_zeros(spark):
    df = spark.createDataFrame(
        [("2018-01-01", "2018-01-31", "7", "30425840700000583001", "Актив", "35", "0840")],
        ", ".join(f"{c} string" for c in S.ACCOUNT.columns),
    )
    assert rows(casts.typed(df, S.ACCOUNT)) == [
        (day("2018-01-01"), day("2018-01-31"), 7, "30425840700000583001", "А", 35, "084")
    ]


def test_null_safe_inequality(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 1), (None, None)], "a int, b int")
    got = [r.d for r in df.select(predicates.differs(F.col("a"), F.col("b")).alias("d")).collect()]
    assert got == [False, True, True, False]


def test_open_ended_validity(spark):
    df = spark.createDataFrame(
        [("2018-01-01", None), ("2018-01-01", "2018-01-31"), ("2018-01-01", "2018-01-09")],
        "f string, t string",
    ).selectExpr("CAST(f AS DATE) AS f", "CAST(t AS DATE) AS t")
    at = F.lit(day("2018-01-10"))
    got = [r.v for r in df.select(predicates.valid_on(at, F.col("f"), F.col("t")).alias("v")).collect()]
    assert got == [True, True, False]


@pytest.mark.parametrize(
    "code, iso, good",
    [
        ("840", "USD", True),
        ("998", "ABC", True),
        ("999", "ABC", False),
        ("0", "ABC", False),
        (None, "ABC", False),
        ("840", None, False),
        ("840", "NON", False),
        ("840", "usd", False),
        ("840", "USD\n", False),
        ("840", "~", False),
        ("text", "USD", False),
    ],
)
def test_currency_rule(spark, code, iso, good):
    df = spark.createDataFrame([(code, iso)], "c string, i string")
    assert value(df, predicates.valid_currency(F.col("c"), F.col("i"))) is good


def test_messages(spark):
    df = spark.createDataFrame([(2, None), (1, "x")], "k int, t string")
    lines = messages.mismatch_lines(df, ["k", "t"])
    assert rows(lines) == [
        ("Несоответствие данных - k: 1, t: x",),
        ("Несоответствие данных - k: 2, t: ",),
    ]
    got = messages.lines_summary(lines).first()
    text = "2: Несоответствие данных - k: 1, t: x .. "
    assert got.rejected_rows == 2 and got.message.startswith(text)
    none = messages.lines_summary(lines.filter("false")).first()
    assert (none.rejected_rows, none.message) == (0, None)


@pytest.mark.parametrize(
    "text",
    ["2018-02-01", "2018-02-30", "2018-2-1", "0000-01-01", "-2018-01-01", "9999-12-31", "12018-01-01", "2018-02-01 ", "x", None],
)
def test_iso_dates_are_read_as_by_their_pattern(spark, text):
    df = one(spark, text)
    read = lambda column: value(df, column.cast("string"))
    assert read(casts.parse_date(F.col("x"), casts.ISO_DATE, lenient=True)) == read(F.try_to_date("x", casts.ISO_DATE))
    try:
        expected = read(F.to_date("x", casts.ISO_DATE))
    except Exception as problem:
        with pytest.raises(type(problem)):
            read(casts.parse_date(F.col("x"), casts.ISO_DATE))
    else:
        assert read(casts.parse_date(F.col("x"), casts.ISO_DATE)) == expected


def test_most_iso_dates_need_no_pattern(spark):
    plan = one(spark, "2018-02-01").select(casts.parse_date(F.col("x"), casts.ISO_DATE))
    assert "cast(x" in plan._jdf.queryExecution().optimizedPlan().toString()
