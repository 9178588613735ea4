"""The registered queries over the driver's tables, each with its SQL counterpart."""

from . import checks, cleaning, loading, ranks, reshaping, sales, stored
from .tables import shown

_MODULES = (cleaning, sales, ranks, checks, reshaping, loading, stored)

QUERIES = {name: shown(query) for module in _MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in _MODULES for name, sql in module.SQL.items()}
