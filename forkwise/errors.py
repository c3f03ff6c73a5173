"""Typed errors of the read API, each with the status that a service would send."""

from __future__ import annotations


class ApiError(Exception):
    status = 500

    def body(self) -> dict:
        """What may be shown to a caller; an internal error doesn't show its message."""
        return {"status": self.status, "error": str(self) if self.status < 500 else "internal error"}


class NotFound(ApiError):
    status = 404


class BadRequest(ApiError):
    status = 400


class Corrupt(ApiError):
    """Stored data contradict each other."""


class Quarantined(RuntimeError):
    """A batch of the log that can't be taken in; its store has a quarantine row for each cause."""


class Damaged(RuntimeError):
    """Rows that no batch may hold; nothing of the batch has been published."""
