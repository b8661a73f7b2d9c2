"""Company credit-risk features computed as Spark plans."""

from .functions.dates import AsOn
from .operators.members import Universe
from .plans.audit import AuditorFeatures
from .plans.directors import DirectorsFeatures
from .plans.enterprise import EfFinancialFeatures
from .plans.financial_services import FsFinancialFeatures
from .plans.litigation import LitigationFeatures
from .plans.scorecard import scorecard
from .session import tune
from .sources import Sources

__all__ = [
    "AsOn",
    "AuditorFeatures",
    "DirectorsFeatures",
    "EfFinancialFeatures",
    "FsFinancialFeatures",
    "LitigationFeatures",
    "Sources",
    "Universe",
    "scorecard",
    "tune",
]
