"""Folders for intermediate tables."""

from __future__ import annotations

import uuid


def work_folder(shared: str) -> str:
    """A fresh folder below ``shared``, which all executors have to reach."""
    return f"{shared.rstrip('/')}/calepin-{uuid.uuid4().hex}"
