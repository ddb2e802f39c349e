"""Every query of the subpackage, registered by import."""

from folioscope.llm import document_queries, token_queries, tree_queries, vector_queries, word_queries  # noqa: F401
from folioscope.llm.registry import LLM_ORACLES, LLM_QUERIES  # noqa: F401
