"""geoprep: geospatial reference-data preparation as Spark DataFrame operators."""

# Functions and classes of this package that run inside Python workers (the pandas
# passes of the batch planners, the GeoPackage source and writer) travel with their code:
# the executors need no installed copy of the package.
try:
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - an older cloudpickle: the package must then be on the workers' path
    pass
