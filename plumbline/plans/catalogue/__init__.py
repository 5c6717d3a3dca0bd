"""Named queries over the supplied tables, each with its SQL twin where one exists."""

from plumbline.plans.catalogue import accumulating, cleaning, counting, drifting, featuring, learning, measuring, planted, running, streams  # noqa: F401
from plumbline.plans.catalogue.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
