"""All registered queries: importing this module registers every group."""

from . import registry
from . import registry_rules  # noqa: F401
from . import registry_policies  # noqa: F401
from . import registry_lifecycle  # noqa: F401
from . import registry_sources  # noqa: F401
from . import registry_streams  # noqa: F401
from . import registry_stores  # noqa: F401

QUERIES = registry.QUERIES
ORACLE = registry.ORACLE
