"""Names of runs: the logical run (run_key) and each attempt at it (run_id)."""

from __future__ import annotations

import datetime as dt
import logging
import secrets

log = logging.getLogger(__name__)
LONGEST_RUN_ID = 200


def build_run_key(*parts: object, delimiter: str = "_") -> str:
    if not parts:
        raise ValueError("a run_key needs at least one part")
    return delimiter.join(map(str, parts))


def default_run_key() -> str:
    """Today's local date."""
    return dt.date.today().isoformat()


def run_id(*labels: object, timestamp: dt.datetime | None = None) -> str:
    """labels, timestamp and six random hex digits, joined by ``::``; empty labels are left out."""
    when = (timestamp or dt.datetime.now()).strftime("%Y%m%dT%H%M%S.%f")
    name = "::".join([*(str(x) for x in labels if x not in (None, "")), when, secrets.token_hex(3)])
    if len(name) > LONGEST_RUN_ID:
        log.warning("run_id has %d characters, more than %d", len(name), LONGEST_RUN_ID)
    return name


def group_run_id(project: str | None, group: str, run_key: str, attempt: int, triggered_by: str) -> str:
    return run_id(f"{project}.{group}" if project else group, run_key, f"attempt-{attempt}", triggered_by)
