"""Registering Python data sources so that any process can load them."""

from __future__ import annotations

from types import ModuleType

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource


def register(spark: SparkSession, module: ModuleType, source: type[DataSource]) -> None:
    """Makes a source known, sent by value: the processes that plan a scan or a write may not import this package.

    The module must import nothing of the package.
    """
    cloudpickle.register_pickle_by_value(module)
    try:
        spark.dataSource.register(source)
    finally:
        cloudpickle.unregister_pickle_by_value(module)
