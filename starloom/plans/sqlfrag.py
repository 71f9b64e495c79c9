"""SQL text helpers for the oracles (DuckDB dialect of standard SQL)."""

from __future__ import annotations

from collections.abc import Sequence


def initcap_word(x: str) -> str:
    """Capitalise each word of a text (no ``initcap`` in the oracle engine)."""
    return f"array_to_string([upper(left(w, 1)) || lower(substr(w, 2)) FOR w IN string_split({x}, ' ')], ' ')"


def bucket(key_sql: str, salt: str, n: int) -> str:
    return f"(('0x'||substr(md5('{salt}'||CAST({key_sql} AS VARCHAR)),1,8))::BIGINT % {n})"


def pick(key_sql: str, salt: str, pool: Sequence[str]) -> str:
    arr = "[" + ", ".join("'" + p.replace("'", "''") + "'" for p in pool) + "]"
    return f"({arr})[{bucket(key_sql, salt, len(pool))} + 1]"


def between(key_sql: str, salt: str, lo: int, hi: int) -> str:
    return f"({lo} + {bucket(key_sql, salt, hi - lo + 1)})"


def values(rows: Sequence[tuple], cols: Sequence[str], alias: str = "t") -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS {alias}({', '.join(cols)})"
