"""Locks between processes, and the settings that the environment may give."""

from __future__ import annotations

import contextlib
import fcntl
import os
import re
import time
from collections.abc import Iterator
from pathlib import Path

_UNITS = {"us": 1e-6, "ms": 1e-3, "s": 1.0, "min": 60.0, "h": 3600.0}


def seconds(text: str | float | None) -> float | None:
    """A timeout: a number counts milliseconds, a unit may follow; None or 0 waits without end."""
    if text is None or text == "":
        return None
    found = re.fullmatch(r"(\d+(?:\.\d+)?)\s*(us|ms|s|min|h)?", str(text).strip())
    if not found:
        raise ValueError(f"not a lock timeout: {text!r}")
    return float(found[1]) * _UNITS[found[2] or "ms"] or None


def lock_timeout(given: str | float | None = None) -> float | None:
    return seconds(given if given is not None else os.environ.get("FACTVIEW_LOCK_TIMEOUT"))


def retention_seconds() -> float:
    """How long a folder that nothing names any more stays: FACTVIEW_RETENTION (a number counts milliseconds), else a day."""
    return seconds(os.environ.get("FACTVIEW_RETENTION")) or 86_400.0


def keeps_old(given: bool | None = None) -> bool:
    return given if given is not None else os.environ.get("FACTVIEW_KEEP_OLD", "").strip().lower() in ("1", "on", "true", "yes")


def analyzes(given: bool | None = None) -> bool:
    if given is not None:
        return given
    text = os.environ.get("FACTVIEW_ANALYZE", "on").strip().lower()
    if text not in ("1", "on", "true", "yes", "0", "off", "false", "no", ""):
        raise ValueError(f"FACTVIEW_ANALYZE: {text!r} is neither on nor off")
    return text not in ("0", "off", "false", "no")


@contextlib.contextmanager
def held(path: Path, timeout: float | None = None) -> Iterator[None]:
    """The file's lock; a TimeoutError if another process keeps it too long."""
    path.parent.mkdir(parents=True, exist_ok=True)
    end = None if timeout is None else time.monotonic() + timeout
    with path.open("a") as file:
        while True:
            try:
                fcntl.flock(file, fcntl.LOCK_EX | fcntl.LOCK_NB)
                break
            except BlockingIOError:
                if end is not None and time.monotonic() >= end:
                    raise TimeoutError(f"{path.name} is locked by another process") from None
                time.sleep(0.02)
        yield
