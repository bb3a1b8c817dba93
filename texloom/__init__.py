"""texloom: paper-source corpora (LaTeX archives) into training tables, on Spark."""

from __future__ import annotations


def _ship_by_value() -> None:
    """Send texloom's functions to Python workers by value.

    The few Python steps (archive codecs in ``mapInPandas``) are defined in this
    package; workers started outside the repository cannot import it, so the
    functions travel with the task instead of by module name.
    """
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001  (older cloudpickle: workers must import texloom themselves)
        pass


_ship_by_value()
