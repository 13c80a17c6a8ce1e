"""Put a query's common table expressions in front of it, in dependency order."""

from __future__ import annotations

from . import cleaning

CTES: dict[str, tuple[tuple[str, ...], str]] = dict(cleaning.CTES)


def with_ctes(needs: tuple[str, ...] | str, body: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for need in CTES[name][0]:
            visit(need)
        order.append(name)

    for name in ((needs,) if isinstance(needs, str) else needs):
        visit(name)
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name][1]})" for name in order)
    return f"WITH {ctes}\n{body}"
