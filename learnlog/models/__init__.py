"""Small committed models as node tables (``tools/export_models.py`` writes them)."""

from __future__ import annotations

import functools
from importlib import resources

from ..functions.ensemble import Ensemble


@functools.lru_cache(maxsize=None)
def committed(name: str) -> Ensemble:
    return Ensemble.from_json(resources.files(__package__).joinpath(f"{name}.json").read_text())
