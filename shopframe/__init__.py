"""shopframe: retail warehouse, survey and mining operators as Spark DataFrame plans.

Every operator is a function ``DataFrame(s), params -> DataFrame``. Nothing is
collected to the driver in the core; Catalyst plans the joins, shuffles and
aggregations.
"""

from shopframe.session import build_session, checkpoint_dir
from shopframe.sources.tables import Tables, load_tables

__all__ = ["build_session", "checkpoint_dir", "Tables", "load_tables"]
