"""Counts taken in the pass that writes the data."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation


def observed(observation: Observation, frame: DataFrame, measures: list[Column]) -> dict:
    """What ``observation`` saw of ``frame``.

    Where adaptive execution finds a part of the plan empty it drops that part with its
    metrics. Then ``frame`` is aggregated on its own.
    """
    try:
        return observation.get
    except Py4JJavaError:
        return frame.agg(*measures).first().asDict()
