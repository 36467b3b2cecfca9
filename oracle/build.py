"""Put together a statement and the derived tables it reads."""

import re

from oracle.tables import TABLES

_NAME = re.compile(r"\b[a-z]_[a-z0-9_]+\b")


def with_tables(body: str) -> str:
    """Prefix a statement with the tables it uses, in dependency order."""
    order: list[str] = []

    def need(sql: str) -> None:
        for name in _NAME.findall(sql):
            if name in TABLES and name not in order:
                need(TABLES[name])
                order.append(name)

    need(body)
    body = body.strip()
    if not order:
        return body
    parts = ",\n".join(f"{n} AS ({TABLES[n].strip()})" for n in order)
    if body.startswith("WITH "):
        return f"WITH {parts},\n{body[5:]}"
    return f"WITH {parts}\n{body}"
