"""Retail star schema and reporting marts, built on the Spark DataFrame API."""

from tillmart.plans.publish import publish
from tillmart.plans.reports import REPORTS, Marts
from tillmart.plans.star import StarPlan
from tillmart.workspace import Workspace

__all__ = ["REPORTS", "Marts", "StarPlan", "Workspace", "publish"]
