"""Times as tests write them."""

from datetime import datetime


def at(text: str) -> datetime:
    """``HH:MM[:SS[.f]]`` on a fixed day, or a full ISO timestamp."""
    return datetime.fromisoformat(text if "-" in text else f"2025-11-24T{text}")
