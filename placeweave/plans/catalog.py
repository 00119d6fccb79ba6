"""Imports every module that registers queries."""

from placeweave.plans import (  # noqa: F401
    changes,
    documents,
    geography,
    matching,
    reporting,
    searching,
    streams,
    texts,
    transfer,
)
from placeweave.plans.registry import ORACLES, QUERIES  # noqa: F401
