"""Run parameters. Every plan takes them explicitly, so a rerun gives the same rows."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from datetime import date
from decimal import Decimal


@dataclass(frozen=True)
class RunContext:
    """What one run of the pipeline depends on besides its input tables.

    ``as_of`` plays the part of "today" and ``run_ts`` the part of "now" (UTC, without a zone).
    """

    as_of: date
    run_ts: str
    pii_salt: str = field(default_factory=lambda: os.environ.get("CAUCE_PII_SALT", ""))
    first_valid_date: date = date(2015, 1, 1)
    cop_per_usd: Decimal = Decimal("4050.0")

    def __post_init__(self) -> None:
        if not self.pii_salt:
            raise ValueError("a salt for the PII hash is required (CAUCE_PII_SALT or pii_salt=)")
