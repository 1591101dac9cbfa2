"""Query catalogue: every implemented operator as a named query over the
driver tables, with the equivalent SQL for an independent engine.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> str``.
Names without SQL (model fits, hashing splits, sinks) are checked on rows
only.  Every query reads whole tables; nothing is sampled or capped except
where the limit is the operator (top-k, head).
"""

from __future__ import annotations

from forkcast.plans import q_geo, q_profile, q_clean, q_explore, q_features, q_impute, q_models, q_io  # noqa: F401  (registration)
from forkcast.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
