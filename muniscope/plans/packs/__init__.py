"""Rule packs. Variable names and coded values are fixed by the survey questionnaires."""

from .deprivation import DEPRIVATION
from .income import INCOME
from .poverty import poverty_rules

PACKS = {**DEPRIVATION, **INCOME, "pobreza_multidimensional": poverty_rules()}

__all__ = ["PACKS", "DEPRIVATION", "INCOME", "poverty_rules"]
