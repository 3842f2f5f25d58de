"""All registered queries: importing the query modules fills the registry."""

from tessera.plans import queries as _rec  # noqa: F401
from tessera.plans import cf_queries as _cf  # noqa: F401
from tessera.plans import text_queries as _txt  # noqa: F401
from tessera.plans import content_queries as _cb  # noqa: F401
from tessera.plans import weighting_queries as _wt  # noqa: F401
from tessera.plans import factor_queries as _mf  # noqa: F401
from tessera.plans import io_queries as _io  # noqa: F401
from tessera.plans import more_queries as _more  # noqa: F401
from tessera.plans.queries import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
