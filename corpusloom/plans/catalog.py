"""The queries by name, and their SQL."""

from __future__ import annotations

import re

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query; in its SQL, SR(x, n) is the rounding of ``functions.text.stable_round``."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = re.sub(r"\bSR\(((?:[^()]|\((?:[^()]|\((?:[^()]|\([^()]*\))*\))*\))*), (\d)\)", r"round(round(\1, 9) + 1e-9, \2)", sql)
        return f

    return add
