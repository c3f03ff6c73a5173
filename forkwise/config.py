"""Settings of the ingest, index and read sides."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    store: str
    poll_seconds: float = 2.0
    max_blocks_per_batch: int = 1000
    max_files_per_trigger: int = 100
    require_compacted: bool = False
    log_format: str = "parquet"  # or "json", a notification's block on each line
    heights_per_bucket: int = 1000

    @property
    def poll_interval(self) -> str:
        return f"{int(self.poll_seconds * 1000)} milliseconds"
