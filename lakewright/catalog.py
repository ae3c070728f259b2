"""All queries of the library and their SQL."""

from __future__ import annotations

from .queries import base
from .queries import catalogue as _catalogue  # noqa: F401
from .queries import explore as _explore  # noqa: F401
from .queries import ledger as _ledger  # noqa: F401
from .queries import schema as _schema  # noqa: F401
from .queries import sources as _sources  # noqa: F401
from .queries import streams as _streams  # noqa: F401
from .queries import scalars as _scalars  # noqa: F401

QUERIES = base.QUERIES
ORACLE_SQL = base.ORACLE_SQL
