"""DuckDB expressions used by the oracle SQL (not used by the Spark jobs)."""

from __future__ import annotations


def pyround_sql(x: str, n: int = 1) -> str:
    """Python ``round(x, n)`` in DuckDB: half-even on the exact binary value.

    Spark's ``bround`` has these semantics; DuckDB's ``round_even`` on doubles
    multiplies first and misses ties. ``printf('%.45f')`` prints the exact
    expansion, so the decision is made on digits.
    """
    assert n >= 1
    half = "'5" + "0" * (44 - n) + "'"
    tail = f"substr(d, instr(d, '.') + 1 + {n})"
    k = f"cast(substr(d, 1, instr(d, '.') - 1) || substr(d, instr(d, '.') + 1, {n}) as hugeint)"
    last = f"cast(substr(d, instr(d, '.') + {n}, 1) as integer)"
    body = (f"{k} + case when {tail} > {half} or ({tail} = {half} and {last} % 2 = 1) then 1 else 0 end")
    return (f"(case when ({x}) is null then null else sign({x}) * "
            f"list_transform([printf('%.45f', abs({x}))], lambda d: {body})[1] / {10 ** n}.0 end)")
