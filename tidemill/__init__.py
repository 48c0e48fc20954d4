"""tidemill: tabular cleaning, profiling, feature, model and evaluation operators on Spark.

Every operator is a function ``DataFrame -> DataFrame`` (or a fitted ``pyspark.ml``
model where a fit is needed). Work runs on executors; only model-sized results
(coefficients, centroids, class lists, metric rows) ever reach the driver.
"""

__version__ = "0.1.0"


def _pickle_by_value() -> None:
    """Functions of this package used inside Python UDFs / ``mapInPandas`` travel with the
    task closure (pickled by value), so executors need no copy of the package."""
    import sys

    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001 - older cloudpickle: the package must be installed on executors
        pass


_pickle_by_value()
