from __future__ import annotations

import math


def canonical(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return repr(round(value, 9))
    return str(value)


def table(rows, columns) -> list[tuple]:
    """Rows as sorted tuples of text, columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(row[i]) for i in order) for row in rows)


def spark_table(df) -> list[tuple]:
    return table(df.collect(), df.columns)


def duck_table(connection, sql) -> tuple[list[str], list[tuple]]:
    result = connection.sql(sql)
    columns = result.columns
    return sorted(columns), table(result.fetchall(), columns)
