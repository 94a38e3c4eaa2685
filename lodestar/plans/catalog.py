"""All registered queries; importing a module registers its queries."""

from lodestar.plans import q_ltr, q_features, q_monitoring, q_retrieval, q_embeddings, q_streaming, q_train  # noqa: F401
from lodestar.plans.registry import ORACLE, QUERIES  # noqa: F401
