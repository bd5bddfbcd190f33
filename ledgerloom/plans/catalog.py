"""All registered queries; importing the modules fills the registry."""

from . import finance_queries, job_queries, platform_queries, stream_queries, workforce_queries  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
