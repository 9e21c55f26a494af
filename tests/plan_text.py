"""Capture ``DataFrame.explain`` output as text (for plan assertions)."""

import contextlib
import io


def plan_of(df, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
