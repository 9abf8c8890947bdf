"""Settings of a refresh run."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

# Stored watermarks and refresh times start here when nothing is known yet,
# and these HTTP results are worth another attempt.
WATERMARK_FLOOR = datetime(1990, 1, 1)
HISTORY_FLOOR = datetime(1985, 1, 1)
MAX_ATTEMPTS = 3
MAX_RUN_HOURS = 1
RETRY_CODES = (429, 500, 502, 503, 504)
ACCEPTED_CODE = 200


@dataclass(frozen=True)
class ManifestSettings:
    """How a manifest record is written.

    ``constants`` are passed through unchanged to every record, in the given order.
    ``names`` renames the computed parameters inside the payload (for example
    ``{"entity_id": "account"}``); names that are not listed stay as they are.
    ``list_style`` is ``"json"`` or ``"python"``, the text form of the object list.
    """

    job_id: int
    constants: Mapping[str, str | None] = field(default_factory=dict)
    names: Mapping[str, str] = field(default_factory=dict)
    list_style: str = "json"


@dataclass(frozen=True)
class RefreshSettings:
    """What one run looks at. ``as_of`` stands for the wall clock, ``run_id`` names the run's commit.

    ``change_source`` is the (schema, table) under which the change feed as a whole keeps its
    watermark; with None every (schema, object) keeps its own, and a run reads the whole feed.
    """

    source: str
    subject_area: str
    batch_ids: tuple[str, ...]
    as_of: datetime
    manifest: ManifestSettings
    change_source: tuple[str, str] | None = ("meta", "change_feed")
    max_hours: int = MAX_RUN_HOURS
    watermark_floor: datetime = WATERMARK_FLOOR
    history_floor: datetime = HISTORY_FLOOR
    max_attempts: int = MAX_ATTEMPTS
    retry_codes: tuple[int, ...] = RETRY_CODES
    run_id: str | None = None
