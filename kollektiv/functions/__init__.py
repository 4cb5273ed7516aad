"""Column-level functions (SCL-*) — all JVM-side expressions."""

from kollektiv.functions.scalars import *  # noqa: F401,F403
