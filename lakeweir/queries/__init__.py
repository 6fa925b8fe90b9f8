"""Registered queries over the test tables, each beside its SQL equivalent."""

from __future__ import annotations

from lakeweir.queries import columns, files, joins, streams, topics
from lakeweir.queries.base import Query

MODULES = (columns, joins, files, streams, topics)
ALL: dict[str, Query] = {q.name: q for module in MODULES for q in module.QUERIES}
