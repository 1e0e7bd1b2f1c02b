"""Queries over the driver tables; importing the package registers them all."""

from . import (attendance, calendar, camp, gold, ingest, people, quality,  # noqa: F401
               silver, stream)
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
