"""All registered queries; importing the modules fills the registry."""

from .registry import QUERIES, Query  # noqa: F401
from . import evaluate_q, features_q, landing_q, ml_q, models_q, registry_q, stats_q  # noqa: F401
