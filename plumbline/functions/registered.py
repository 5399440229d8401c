"""SQL forms of the helpers, for use inside ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import SparkSession

SQL_FUNCTIONS = {
    "clean_name(value STRING) RETURNS STRING": (
        "CASE WHEN length(value) - length(substring_index(value, chr(39), -1)) > instr(value, '/') THEN substring(value,"
        " instr(value, '/') + 1, length(value) - length(substring_index(value, chr(39), -1)) - instr(value, '/') - 1) END"
    ),
    "clean_type(value STRING) RETURNS STRING": "substring_index(value, '/', -1)",
    "run_date(value STRING) RETURNS TIMESTAMP": "to_timestamp(nullif(value, ''), 'yyyy-MM-dd')",
}


def register_sql_functions(spark: SparkSession) -> None:
    """Create ``clean_name``, ``clean_type`` and ``run_date`` as temporary functions; they are inlined into plans."""
    for signature, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
