"""SQL-registered functions.

Registered as SQL UDFs (``CREATE TEMPORARY FUNCTION ... RETURN <expr>``), which
the analyzer inlines into the calling plan: unlike Python UDFs they keep
predicate pushdown, constant folding and whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from waitcast.functions.calendar import HOLIDAYS, SEASONS

_HOL = ", ".join(str(m * 100 + d) for m, d in HOLIDAYS)


def _season_case(variant: str, arg: str) -> str:
    rules, default = SEASONS[variant]
    lit = (lambda v: f"'{v}'") if isinstance(default, str) else str
    whens = " ".join(f"WHEN {arg} IN ({', '.join(map(str, ms))}) THEN {lit(v)}" for ms, v in rules)
    return f"CASE {whens} ELSE {lit(default)} END"


FUNCTIONS = {
    "wc_parse_hour": (
        "h STRING", "DOUBLE",
        "CASE WHEN instr(trim(h), ':') > 0 THEN "
        "  try_cast(try_cast(get(split(trim(h), ':'), 0) AS DOUBLE) AS BIGINT) "
        "  + try_cast(try_cast(get(split(trim(h), ':'), 1) AS DOUBLE) AS BIGINT) / 60.0 "
        "ELSE CAST(try_cast(try_cast(trim(h) AS DOUBLE) AS BIGINT) AS DOUBLE) END"),
    "wc_season": ("m INT", "INT", _season_case("a", "m")),
    "wc_is_holiday": ("d DATE", "BOOLEAN", f"(month(d) * 100 + day(d)) IN ({_HOL})"),
    "wc_is_bridge": (
        "d DATE", "BOOLEAN",
        f"(month(d) * 100 + day(d)) IN ({_HOL}) "
        f"OR (weekday(d) = 4 AND (month(date_add(d, 1)) * 100 + day(date_add(d, 1))) IN ({_HOL})) "
        f"OR (weekday(d) IN (0, 6) AND (month(date_sub(d, 1)) * 100 + day(date_sub(d, 1))) IN ({_HOL}))"),
}


def register(spark: SparkSession) -> list[str]:
    for name, (args, ret, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {ret} RETURN {body}")
    return list(FUNCTIONS)
