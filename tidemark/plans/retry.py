"""The five retry checks for one source, reading nothing of the others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.registry import require_source
from tidemark.operators.windows import Sources
from tidemark.plans import checks


def retry_validation(
    registry: DataFrame,
    runs: DataFrame,
    history: DataFrame,
    sources: Sources,
    system: str,
    schema: str,
    name: str,
) -> dict[str, DataFrame]:
    """Check name → result. Raises GuardError 55001 for an unknown source."""
    source_id = require_source(registry, system, schema, name, 55001)
    mine = F.col("SourceObjectId") == F.lit(source_id)
    one = registry.where(mine)
    own_runs = runs.where(mine)
    if isinstance(sources, DataFrame):
        own = sources.where(mine)
    else:
        own = {i: df for i, df in sources.items() if i == source_id}
    return {
        "readiness": checks.retry_readiness(own, one),
        "failed_run": checks.failed_run_check(own_runs),
        "history": checks.failed_run_history_check(one, own_runs, history),
        "eligible_rows": checks.retry_eligible_rows(own, one),
        "summary": checks.retry_summary(one, own_runs, history, own),
    }
