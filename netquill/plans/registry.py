"""Every query of the library with the SQL that checks it."""

from __future__ import annotations

from netquill.plans import catalog, q_aggregate, q_chain, q_detect, q_enrich, q_flatten, q_raw, q_store, q_verdicts  # noqa: F401  (query modules register on import)


def queries() -> dict:
    return dict(catalog.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(catalog.SQL)
