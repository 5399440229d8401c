"""Order-line counts and word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import run_date as parse_run_date
from plumbline.functions.text import words


def n_order_line_count(header: DataFrame, detail: DataFrame, run_date: str) -> DataFrame:
    """Lines per order of one date; an empty date gives no rows.

    The date is compared in the column's own type, so the filter reaches the scan of the header.
    """
    date = parse_run_date(run_date, header.schema["OrderDate"].dataType.simpleString())
    return (
        header.filter(F.col("OrderDate") == date)
        .join(detail, "SalesOrderID")
        .groupBy("SalesOrderNumber")
        .agg(F.count("*").alias("DetailLineCount"))
    )


def n_order_line_count_sql(header: DataFrame, detail: DataFrame, run_date: str) -> DataFrame:
    """The same in SQL, ordered by order number."""
    type_name = header.schema["OrderDate"].dataType.simpleString()
    return header.sparkSession.sql(
        f"""
        SELECT h.SalesOrderNumber, count(d.SalesOrderDetailID) AS DetailLineCount
        FROM {{header}} h JOIN {{detail}} d ON d.SalesOrderID = h.SalesOrderID
        WHERE h.OrderDate = CAST(nullif(:run_date, '') AS {type_name})
        GROUP BY h.SalesOrderNumber
        ORDER BY h.SalesOrderNumber
        """,
        args={"run_date": run_date},
        header=header,
        detail=detail,
    )


def n_word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """Words by falling count, then by word; a word is what stands between two single blanks."""
    return (
        lines.select(F.explode(words(column)).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "word")
    )


def n_word_count_repeated(counts: DataFrame) -> DataFrame:
    return counts.sparkSession.sql("SELECT * FROM {counts} WHERE count > 1", counts=counts)
