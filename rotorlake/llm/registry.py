"""What the driver's entry point adds: the operators' queries and their SQL."""

from __future__ import annotations

import corpus_pipeline
from rotorlake.llm.queries import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES) | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return dict(SQL) | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
