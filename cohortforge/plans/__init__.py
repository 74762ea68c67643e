"""Stages and extracts; importing the package registers them all."""

from cohortforge.plans import (
    clinical,
    codecounts,
    cohort,
    diagnoses,
    drivers,
    encounters,
    extracts,
    orders,
    panels,
    people,
    procedures,
    providers,
    quality,
    release,
    selection,
)

__all__ = [
    "clinical",
    "codecounts",
    "cohort",
    "diagnoses",
    "drivers",
    "encounters",
    "extracts",
    "orders",
    "panels",
    "people",
    "procedures",
    "providers",
    "quality",
    "release",
    "selection",
]
