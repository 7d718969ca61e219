"""DuckDB oracle SQL for the registered queries (same names, same output columns).

Every statement is literal SQL in ``sql/<query>.sql``; ``${views}`` stands for ``sql/views.sql``, the common table
expressions of the raw tables, staging models and marts. Nothing here is derived from the library's own
constants, so a change of a rule in the library shows as a difference.
"""

from __future__ import annotations

from pathlib import Path

_SQL = Path(__file__).parent / "sql"
_VIEWS = (_SQL / "views.sql").read_text().rstrip()

ORACLE: dict[str, str] = {
    p.stem: p.read_text().replace("${views}", _VIEWS) for p in sorted(_SQL.glob("*.sql")) if p.stem != "views"
}
