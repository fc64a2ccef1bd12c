"""Affinity: item-to-item and user-to-item recommendations as Spark DataFrame plans.

Every operator is a pure function ``DataFrame -> DataFrame`` built from joins,
aggregates and windows, so Catalyst and AQE pick the physical strategy.
"""

from affinity.params import RecParams, PARAMS_T, PARAMS_E, PARAMS_B

__all__ = ["RecParams", "PARAMS_T", "PARAMS_E", "PARAMS_B"]
