"""Column expressions against plain Python restatements of their rules."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.functions import text as X


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'TIMESTAMP' if isinstance(v, datetime) else 'STRING'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("out")).first().out


def each(spark, column, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, v STRING")
    return [r.out for r in df.select("i", column.alias("out")).orderBy("i").collect()]


def py_clean_name(v):
    slash, quote = v.find("/"), v.rfind("'")
    return v[slash + 1 : quote] if quote - slash - 1 >= 0 and quote >= 0 else None


def py_cut_name(v):
    start = v.find("/") + 1
    return v[start : start + 50].replace("')]", "")


names = st.lists(st.text(alphabet="ab/' .|é_", max_size=30), min_size=1, max_size=20)


@settings(max_examples=15, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(names)
def test_name_functions_match_python(spark, texts):
    assert each(spark, X.clean_name("v"), texts) == [py_clean_name(t) for t in texts]
    assert each(spark, X.cut_name("v"), texts) == [py_cut_name(t) for t in texts]
    assert each(spark, X.clean_type("v"), texts) == [t.rsplit("/", 1)[-1] for t in texts]
    assert each(spark, X.first_dot_extension("v"), texts) == [t[t.find(".") + 1 :] for t in texts]
    assert each(spark, X.words("v"), texts) == [t.split(" ") for t in texts]
    assert each(spark, X.first_upper("v"), texts) == [t[:1].upper() + t[1:] for t in texts]


@pytest.mark.parametrize(
    "length, kept",
    [(47, "n" * 47), (48, "n" * 48 + "')"), (49, "n" * 49 + "'"), (50, "n" * 50), (51, "n" * 50)],
)
def test_cut_happens_before_the_closing_is_removed(spark, length, kept):
    raw = "[concat(parameters('factoryName'), '/" + "n" * length + "')]"
    assert one(spark, X.cut_name("v"), v=raw) == kept


def test_sql_functions_agree(spark):
    from plumbline.functions.registered import register_sql_functions

    register_sql_functions(spark)
    texts = ["[concat(a, '/x/y')]", "no slash'", "/no quote", "'/", "", None, "a/b'c'd"]
    sql = each(spark, F.expr("clean_name(v)"), texts)
    assert sql == each(spark, X.clean_name("v"), texts)
    assert sql == ["x/y", "no slash", None, None, None, None, "b'c"]


def test_replace_ci_takes_plain_text(spark):
    assert one(spark, X.replace_ci("v", "a.B", "$1\\"), v="xA.bxa+b") == "x$1\\xa+b"


def test_dataset_name(spark):
    assert one(spark, X.dataset_name("v"), v="/Landing/Year=2020/My Gender.v2.csv") == "MyGender.v2"


def test_landing_folder_has_a_twelve_hour_clock(spark):
    night, afternoon = datetime(2020, 1, 2, 3), datetime(2020, 1, 2, 15)
    same = "Year=2020/Month=01/Day=02/Hour=03"
    assert one(spark, X.landing_folder("t"), t=night) == one(spark, X.landing_folder("t"), t=afternoon) == same
    assert one(spark, X.landing_folder("t", hour24=True), t=afternoon).endswith("Hour=15")


def test_run_date(spark):
    assert one(spark, X.run_date(F.col("v")), v="") is None
    assert one(spark, X.run_date(F.col("v")), v="2020-02-29") == datetime(2020, 2, 29)


def test_log_line_round_trip(spark):
    line = one(spark, X.log_line("t", F.lit("a|b")), t=datetime(2020, 12, 31, 23, 59, 58))
    assert line == "31/12/2020 23:59:58|a|b"
    assert one(spark, X.log_line_time("v"), v=line) == datetime(2020, 12, 31, 23, 59, 58)
    assert one(spark, X.log_line_message("v"), v=line) == "a|b"


def test_fk_table(spark):
    texts = ["FK_Orders_Customers", "fk_Orders_X", "FK_Orders", "Orders", None]
    assert each(spark, X.fk_table("v"), texts) == ["Orders", "Orders", "", "", None]


def test_two_digits_is_repeatable(spark):
    df = spark.range(500).select(X.two_digits("id", 7).alias("d"))
    first, second = ([r.d for r in df.collect()] for _ in range(2))
    assert first == second and all(len(d) == 2 and d.isdigit() for d in first) and len(set(first)) > 30


def test_fill_parameters(spark):
    params = F.create_map(*[F.lit(x) for x in ("DB", "short", "DBName", "long", "SQLPassword", "hush", "secretName", "shown")])
    text = "@dataset().DBName/@dataset().DB/@{linkedService().DBName}/@{linkedService().SQLPassword}/@{linkedService().secretName}/@{linkedService().None}"
    out = one(spark, X.fill_parameters("v", params), v=text)
    assert out == "long/short/long/<redacted>/shown/@{linkedService().None}"


def test_parse_error(spark):
    error = X.parse_error("v")
    assert one(spark, error["errorCode"], v='{"errorCode": "7", "failureType": "UserError"}') == "7"
    assert one(spark, error["errorCode"], v="not json") is None


def test_language_and_severity(spark):
    assert each(spark, X.language_extension("v"), ["SCALA", "PYTHON", "SQL", "R", "JAVA", None]) == [
        ".scala", ".ipynb", ".sql", ".r", None, None,
    ]
    assert each(spark, X.severity_rank("v"), ["Low", "Medium", "HIGH", "x"]) == [1, 2, 3, 0]
