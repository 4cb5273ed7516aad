"""Sinks: bronze append (SNK-1), day-partition overwrite (SNK-2), views (SNK-3),
rebuilt gold tables (SNK-4), and schema-pinned bronze scans (SRC-13)."""

from kollektiv.sinks.tables import *  # noqa: F401,F403
