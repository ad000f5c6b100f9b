"""Dimension rows from settings files, read once on the driver."""

from __future__ import annotations

import json
from collections.abc import Mapping
from pathlib import Path
from typing import Any

from homeload import dims

try:
    import yaml
except ImportError:  # YAML is optional; the same settings may be given as JSON
    yaml = None


def load(path: str | Path) -> dict[str, Any]:
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith((".yaml", ".yml")):
        if yaml is None:
            raise ImportError("reading YAML settings needs the yaml package; JSON works without it")
        return yaml.safe_load(text) or {}
    return json.loads(text)


def price_rows(config: Mapping[str, Any]) -> tuple[list[tuple], tuple[float, float]]:
    """``(provider, model, in, out)`` rows and the default rates of a price file."""

    def rates(entry: Mapping[str, Any]) -> tuple[float, float]:
        return (
            float(entry.get("input_cost_per_million", 1.0)), float(entry.get("output_cost_per_million", 3.0)),
        )

    default = rates(config.get("default", {}))
    rows = [
        (provider, model, *rates(entry))
        for provider, models in config.items()
        if provider != "default"
        for model, entry in models.items()
    ]
    return rows, default


def role_rows(config: Mapping[str, Any]) -> list[tuple[str, str]]:
    """``(role, model)`` of every role that names a model."""
    return [(r, c["model"]) for r, c in config.get("roles", {}).items() if c.get("model")] or list(dims.ROLES)


def weekend_rows(config: Mapping[str, Any]) -> list[tuple]:
    return [
        (code, p["start"], p["end"], list(p["weekend"]))
        for code, periods in config["countries"]["weekends"].items()
        for p in periods
    ]


def country_rows(config: Mapping[str, Any]) -> tuple[list[tuple], list[tuple]]:
    """``(code, name)`` and ``(alias, code)`` rows."""
    countries = config["countries"]
    return list(countries["code_to_name"].items()), list(countries.get("aliases", {}).items())


def coordinate_rows(config: Mapping[str, Any]) -> tuple[list[tuple], list[str]]:
    """``(country, lat, lon)`` rows and the southern countries."""
    places = config["tmy"]
    return [(c, *map(float, p)) for c, p in places["coordinates"].items()], list(places.get("southern_hemisphere", []))
