"""The list of jobs and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.text import COMMON_ENTITIES, WS

Job = Callable[[SparkSession, str], DataFrame]

JOBS: dict[str, Job] = {}
SQL: dict[str, str] = {}
_PARTS: dict[str, str] = {"WS": WS}


def define(**parts: str) -> None:
    """Named SQL fragments, written ``@NAME@`` inside the SQL twins."""
    for name, text in parts.items():
        _PARTS[name] = fill(text)


def fill(text: str) -> str:
    for name, part in _PARTS.items():
        text = text.replace(f"@{name}@", part)
    return text


def job(name: str, sql: str | None = None) -> Callable[[Job], Job]:
    def add(fn: Job) -> Job:
        JOBS[name] = fn
        if sql is not None:
            SQL[name] = fill(sql)
        return fn
    return add


def sql_unescape(expr: str) -> str:
    for name, value in COMMON_ENTITIES:
        quoted = value.replace("'", "''")
        expr = f"replace({expr}, '{name}', '{quoted}')"
    return expr


def sql_collapse(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '{WS}+', ' ', 'g'))"


def sql_strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{WS}+|{WS}+$', '', 'g')"


def sql_markup(expr: str, sep: str = " ", entities: bool = True) -> str:
    bare = f"regexp_replace({expr}, '<[^>]+>', '{sep}', 'g')"
    return sql_collapse(sql_unescape(bare) if entities else bare)
