"""Imports every operator module so that the registry of text queries is complete."""

from skyloom.llm import (  # noqa: F401
    decontamination, html_text, language_id, language_model, merkle, mixing, packing, quality_classifier, quality_rules,
    similarity_join, spelling, token_counts, warc,
)
from skyloom.llm.common import ORACLES, QUERIES  # noqa: F401
