"""The production queries of this package: id -> callable, id -> oracle SQL."""

from pitwall.llm import (
    conversations,
    language,
    licenses,
    lines,
    mixing,
    packing,
    phrases,
    pii,
    quality,
    sharding,
    simhash,
    spelling,
    token_files,
)
from pitwall.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
