"""Sources: readers, the ``Tables`` bundle and the fixture binding."""

from lumenrec.sources.tables import Tables, from_catalog
from lumenrec.sources.fixtures import bind_fixtures

__all__ = ["Tables", "from_catalog", "bind_fixtures"]
