"""Send this package to the executors, so that functions run there find it."""

from __future__ import annotations

from lateline.shipping import ship  # noqa: F401
