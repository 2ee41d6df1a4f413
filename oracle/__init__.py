"""Independent DuckDB statements that every query is compared with."""

from __future__ import annotations

import re


def compose(statement: str, relations: dict[str, str]) -> str:
    """Prefix ``statement`` with the relations it needs, in definition order."""
    needed: set[str] = set()
    pending = [statement]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in relations:
            if name in words and name not in needed:
                needed.add(name)
                pending.append(relations[name])
    parts = [f"{name} AS ({body.strip()})" for name, body in relations.items() if name in needed]
    if not parts:
        return statement.strip()
    return f"WITH {', '.join(parts)} SELECT * FROM ({statement.strip()})"
