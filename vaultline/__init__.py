"""Warehouse modeling (hubs, links, satellites, as-of, star schema) on PySpark.

Main entry points::

    from vaultline import get_spark, Warehouse, build_warehouse
"""

from vaultline.plans.build import build_warehouse
from vaultline.plans.warehouse import Warehouse
from vaultline.session import get_spark

__all__ = ["Warehouse", "build_warehouse", "get_spark"]
