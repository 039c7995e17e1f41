"""Imports every operator, which registers its query."""

from obsflow.llm import merkle, minhash, mixing, negatives, prefix_forest, quality, sentencepiece, sharding, simhash, substring, tokens, topk, toxicity  # noqa: F401
from obsflow.llm.registry import ORACLES, QUERIES  # noqa: F401
