"""The registered queries of the engine; importing this package fills the registry."""

from . import changes, identity, market, quality, retention, scalars, urls  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
