"""Registered queries, with the SQL that must give the same result.

Each module has QUERIES (name -> function of session and table folder) and ORACLES (name -> SQL).
"""

from __future__ import annotations

from importlib import import_module

MODULES = ["logs", "payloads", "readings", "camera_frames", "streams"]


def _collect(attribute: str) -> dict:
    found: dict = {}
    for module in MODULES:
        found.update(getattr(import_module(f"sensorloom.plans.{module}"), attribute))
    return found


def queries() -> dict:
    return _collect("QUERIES")


def oracles() -> dict:
    return _collect("ORACLES")
