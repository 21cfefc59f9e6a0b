"""The controlled failure: preview, prepare, restore, for one source."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.model import (
    CONFIGURATION_RESTORED,
    CURRENT_CONFIGURATION,
    FAILURE_PREPARED,
    PREPARE_FAILURE,
    PREVIEW,
)
from tidemark.operators.registry import (
    prepare_failure,
    preview_failure,
    require_action,
    require_source,
    restore_config,
    restore_note,
)
from tidemark.plans.checks import source_config


@dataclass(frozen=True)
class Setup:
    """The frames an action shows, in order, and the registry after it."""

    shown: list[DataFrame]
    registry: DataFrame


def failure_setup(
    registry: DataFrame,
    system: str,
    schema: str,
    name: str,
    folder: str,
    now: datetime,
    action: str = PREVIEW,
) -> Setup:
    """Carry out one action. Guards raise before anything is shown."""
    source_id = require_source(registry, system, schema, name)
    require_action(action)

    def target(rows: DataFrame) -> DataFrame:
        return rows.where(F.col("SourceObjectId") == F.lit(source_id))

    current = source_config(target(registry), CURRENT_CONFIGURATION)
    if action == PREVIEW:
        only = target(registry)
        return Setup([current, preview_failure(only), restore_note(only)], registry)
    if action == PREPARE_FAILURE:
        changed = prepare_failure(registry, source_id, now)
        after = source_config(target(changed), FAILURE_PREPARED)
    else:
        changed = restore_config(registry, source_id, folder, now)
        after = source_config(target(changed), CONFIGURATION_RESTORED)
    return Setup([current, after], changed)
