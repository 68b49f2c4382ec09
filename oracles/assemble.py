"""Put the common table expressions a query mentions in front of it, in order."""

from __future__ import annotations

import re

from oracles.marts import MARTS
from oracles.tables import TABLES

EXPRESSIONS = {**TABLES, **MARTS}


def with_tables(body: str, local: str | None = None) -> str:
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in EXPRESSIONS:
            if name not in needed and re.search(rf"(?:\bFROM|\bJOIN|,)\s+{name}\b(?!\s*\()", text):
                visit(EXPRESSIONS[name])
                needed.append(name)

    visit(f"{local or ''} {body}")
    defined = [f"{n} AS MATERIALIZED ({EXPRESSIONS[n]})" for n in needed] + ([local] if local else [])
    if not defined:
        return body.strip()
    return "WITH " + ",\n".join(defined) + "\n" + body.strip()
