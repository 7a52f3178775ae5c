"""Rollout, reward and training-metric analytics as Spark DataFrame functions.

Column builders live in ``functions``, DataFrame -> DataFrame operators in
``operators``, table readers in ``sources``, bindings of the driver tables and
the registered queries in ``plans``, and Structured Streaming forms in
``streaming``.
"""

__all__ = ["functions", "operators", "sources", "plans", "streaming"]


def _ship_by_value() -> None:
    """Python functions of this package that run on executors (Arrow UDFs,
    state functions, batch handlers) are pickled by value, so workers need
    neither an install of the package nor a PYTHONPATH pointing at it."""
    import sys

    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001 - older cloudpickle: fall back to by-reference
        pass


_ship_by_value()
