"""Every operator as a query over the given tables, with its SQL where one exists.

Importing this package fills `QUERIES` and `SQL`.
"""

from .base import QUERIES, SQL  # noqa: F401
from . import ingest, decode, normalize, validate, correlate, enrich, fuse, final, xml, deliver, whole, sentences  # noqa: F401,E402
