"""All registered queries."""

from importlib import import_module

from .base import ORACLES, QUERIES

AREAS = ["variants", "reads", "cells", "bulk", "models", "files", "plans"]


def load():
    for area in AREAS:
        import_module(f"{__name__}.{area}")
    return QUERIES, ORACLES
