"""SQL-callable versions of the position extractors (X-1 ... X-3).

The reference registers three row-at-a-time Python UDFs that each re-parse the
stored repr text. Here they are SQL functions whose bodies are native
expressions (literal rewrite + ``from_json``), so a SQL user can keep writing
``extract_sog(position_report)`` and Catalyst inlines the body: no Python
worker, and constant inputs fold at planning time.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidewater.functions.clean import HEX_ESCAPE, PY_LITERALS, literal_rewrite

# SQL function name -> field of the position report.
EXTRACTORS = {"extract_sog": "Sog", "extract_cog": "Cog", "extract_heading": "TrueHeading"}


def _sql_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _repr_to_json_sql(arg: str) -> str:
    expr = arg
    for literal, json_literal in PY_LITERALS:
        pattern, replacement = literal_rewrite(literal, json_literal)
        expr = f"regexp_replace({expr}, {_sql_literal(pattern)}, {_sql_literal(replacement)})"
    pattern, replacement = HEX_ESCAPE
    return f"regexp_replace({expr}, {_sql_literal(pattern)}, {_sql_literal(replacement)})"


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the three extractors as temporary SQL functions in ``spark``."""
    schema = "'Sog DOUBLE, Cog DOUBLE, TrueHeading DOUBLE'"
    for name, field in EXTRACTORS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(report STRING) RETURNS DOUBLE "
            f"RETURN from_json({_repr_to_json_sql('report')}, {schema}, "
            f"map('allowBackslashEscapingAnyCharacter', 'true')).{field}"
        )
    return list(EXTRACTORS)
