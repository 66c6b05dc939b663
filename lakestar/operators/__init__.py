"""Relational building blocks composed from DataFrame operations."""

from lakestar.operators.dedupe import Order, first_per_key  # noqa: F401
from lakestar.operators.joins import materialize  # noqa: F401
from lakestar.operators.keys import dense_ids  # noqa: F401
