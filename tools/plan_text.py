"""The physical plan of a DataFrame as text, through the public ``explain``."""

from __future__ import annotations

import contextlib
import io


def plan_text(df) -> str:
    """What ``df.explain()`` prints (the physical plan tree)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()
