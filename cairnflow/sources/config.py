"""Settings, from the environment or keywords, checked once."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

from cairnflow import model


@dataclass(frozen=True)
class Config:
    global_per_minute: int = 2000
    pages_per_minute: int = 200
    files_per_minute: int = 1800
    fetch_batch: int = model.CLAIM_BATCH
    convert_batch: int = model.CLAIM_BATCH
    convert_workers: int = 0
    max_attempts: int = model.MAX_ATTEMPTS
    backoff_base_s: float = model.BACKOFF_BASE_S
    backoff_cap_s: float = model.BACKOFF_CAP_S
    block_bytes: int = model.BLOCK_BYTES
    seal_bytes: int = model.SEAL_BYTES
    seal_age_s: int = model.SEAL_AGE_S
    zstd_level: int = model.ZSTD_LEVEL
    handoff_bytes: int = model.HANDOFF_BYTES
    disk_floor_bytes: int = model.DISK_FLOOR_BYTES
    error_retention_days: int = model.ERROR_RETENTION_DAYS
    index_poll_s: float = 300.0
    breaker_failures: int = model.BREAKER_FAILURES
    breaker_recovery_s: float = model.BREAKER_RECOVERY_S

    def __post_init__(self) -> None:
        for f in fields(self):
            value = getattr(self, f.name)
            if value < 0 or value == 0 and f.name not in {"convert_workers", "disk_floor_bytes"}:
                raise ValueError(f"{f.name} must be positive: {value}")
        if self.pages_per_minute + self.files_per_minute > self.global_per_minute:
            raise ValueError("the reserves are above the global rate")
        if self.backoff_cap_s < self.backoff_base_s:
            raise ValueError("the cap is below the base")

    def workers(self, cores: int | None = None) -> int:
        return self.convert_workers or max(1, (cores or os.cpu_count() or 1) - 2)


def config_from_env(env: Mapping[str, str], prefix: str = "CAIRNFLOW_") -> Config:
    """Every field by its upper-case name behind the prefix; a value of the wrong type is an error that names it."""
    given = {}
    for f in fields(Config):
        text = env.get(prefix + f.name.upper())
        if text is not None:
            try:
                given[f.name] = type(f.default)(text)
            except ValueError as e:
                raise ValueError(f"{prefix}{f.name.upper()}: {text!r}") from e
    return Config(**given)
