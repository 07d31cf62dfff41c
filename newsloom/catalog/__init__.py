"""Every operator as a query over the test tables, with the SQL it must agree with."""

from newsloom.catalog import articles, content, exchange, scoring, storage, vectors  # noqa: F401
from newsloom.catalog.registry import ORACLES, QUERIES  # noqa: F401
