"""Where queries and their SQL are registered, and how the SQL of one is put together from named parts."""

from __future__ import annotations

import re

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
#: Named parts of the oracles: name to the body of a common table expression.
PARTS: dict[str, str] = {}


def compose(final: str) -> str:
    """`final` with all named parts that it needs, directly or not, as common table expressions in order."""
    order: list[str] = []

    def need(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b[a-z_0-9]+\b", text)):
            if word in PARTS and word not in order:
                need(PARTS[word])
                order.append(word)

    need(final)
    return ("WITH " + ",\n".join(f"{n} AS ({PARTS[n]})" for n in order) + "\n" if order else "") + final


def query(sql: str | None = None):
    """Registers a query (spark, folder) under its function's name; `sql` may use the named parts."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql if sql.lstrip().upper().startswith("WITH") else compose(sql)
        return f

    return add
