"""Independent DuckDB text for each registered query.

``build`` completes a query with the CTEs it names. ``@asof`` stands for the newest
request of the log, the same reference instant the Spark side uses.
"""

from __future__ import annotations

import re

from oracle.base import CTES

_WORD = {name: re.compile(rf"\b{name}\b") for name in CTES}
_WORD["clock"] = re.compile(r"\bclock\b|@asof")


def _needed(text: str, found: set[str]) -> None:
    for name, pattern in _WORD.items():
        if name not in found and pattern.search(text):
            found.add(name)
            _needed(CTES[name], found)


def build(sql: str) -> str:
    if sql.startswith("--compressed"):  # time before the newest event runs 288 times as fast
        whole = build(sql.removeprefix("--compressed"))
        events = """events AS (SELECT * EXCLUDE (newest) REPLACE (make_timestamp(epoch_us(newest) - CAST(floor((epoch_us(newest) - epoch_us(ts)) / 288) AS BIGINT)) AS ts) FROM (SELECT *, max(ts) OVER () AS newest FROM main.events))"""
        return f"WITH {events},\n{whole.removeprefix('WITH ')}"
    body = sql.strip().rstrip(";").replace("@asof", "(SELECT as_of FROM clock)")
    found: set[str] = set()
    _needed(body, found)
    if not found:
        return body
    ctes = [
        f"{name} AS ({text.strip().replace('@asof', '(SELECT as_of FROM clock)')})"
        for name, text in CTES.items()
        if name in found
    ]
    head = ",\n".join(ctes)
    for opening in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(opening):
            return f"{opening}{head},\n{body[len(opening):]}"
    return f"WITH {head}\n{body}"


SECTIONS = ["tables", "analytics", "dashboards", "relational", "observability", "ingest", "streams", "stored", "loads"]


def texts() -> dict[str, str]:
    from importlib import import_module

    out: dict[str, str] = {}
    for section in SECTIONS:
        for name, sql in import_module(f"oracle.{section}").SQL.items():
            out[name] = build(sql)
    return out
