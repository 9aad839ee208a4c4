"""The few spellings in which Spark SQL and DuckDB differ in the lens formulas."""

from __future__ import annotations

from collections.abc import Sequence


def literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


class Spark:
    def pick(self, values: Sequence, index: str) -> str:
        items = ", ".join(literal(v) for v in values)
        return f"element_at(array({items}), CAST(({index}) % {len(values)} AS INT) + 1)"

    def minutes(self, n: str) -> str:
        return f"make_dt_interval(0, 0, CAST({n} AS INT))"

    def days(self, n: str) -> str:
        return f"make_dt_interval(CAST({n} AS INT))"

    def div(self, a: str, b: int) -> str:
        return f"({a} DIV {b})"

    def array(self, items: Sequence[str]) -> str:
        return f"array({', '.join(items)})"

    def stamp(self, text: str) -> str:
        return f"TIMESTAMP_NTZ '{text}'"

    def each(self, n: int) -> str:
        return f"explode(sequence(0, {n - 1}))"

    def sunday(self, day: str) -> str:
        return f"date_sub({day}, (weekday({day}) + 1) % 7)"

    def mdy(self, day: str) -> str:
        return f"date_format({day}, 'M/d/yy')"

    def add_days(self, day: str, n: int) -> str:
        return f"date_add({day}, {n})"


class Duck:
    def pick(self, values: Sequence, index: str) -> str:
        items = ", ".join(literal(v) for v in values)
        return f"list_extract([{items}], CAST(({index}) % {len(values)} AS INT) + 1)"

    def minutes(self, n: str) -> str:
        return f"to_minutes(CAST({n} AS BIGINT))"

    def days(self, n: str) -> str:
        return f"to_days(CAST({n} AS INT))"

    def div(self, a: str, b: int) -> str:
        return f"({a} // {b})"

    def array(self, items: Sequence[str]) -> str:
        return f"[{', '.join(items)}]"

    def stamp(self, text: str) -> str:
        return f"TIMESTAMP '{text}'"

    def each(self, n: int) -> str:
        return f"unnest(range({n}))"

    def sunday(self, day: str) -> str:
        return f"({day} - CAST(isodow({day}) % 7 AS INT))"

    def mdy(self, day: str) -> str:
        return f"strftime({day}, '%-m/%-d/%y')"

    def add_days(self, day: str, n: int) -> str:
        return f"({day} + {n})"
