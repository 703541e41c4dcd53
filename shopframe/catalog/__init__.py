"""All registered queries (importing the modules fills the registry)."""

from shopframe.catalog.base import REGISTRY, Entry, register  # noqa: F401
from shopframe.catalog import warehouse  # noqa: F401,E402
from shopframe.catalog import survey  # noqa: F401,E402
from shopframe.catalog import features  # noqa: F401,E402
from shopframe.catalog import rules  # noqa: F401,E402
from shopframe.catalog import prediction  # noqa: F401,E402
from shopframe.catalog import etl  # noqa: F401,E402
from shopframe.catalog import serving  # noqa: F401,E402
from shopframe.catalog import clusters  # noqa: F401,E402
from shopframe.catalog import checks  # noqa: F401,E402
