from .registry import Sources
from .schemas import CONNECTION_OF, TABLES

__all__ = ["CONNECTION_OF", "Sources", "TABLES"]
