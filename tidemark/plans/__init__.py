"""Query plans built from the operators, registered by name."""

from tidemark.plans import core, detection, explanations, governance, serving, streams  # noqa: F401
from tidemark.plans.registry import REGISTRY  # noqa: F401
