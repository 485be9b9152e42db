"""Operators for preparing large training texts, with their queries."""

import sys

from pyspark import cloudpickle

from . import (  # noqa: F401
    byte_bpe,
    decontaminate,
    divergence,
    importance,
    licenses,
    near_copies,
    pseudonyms,
    quality,
    secret_scan,
    sharding,
    simhash,
    token_files,
    toxicity,
    warc,
)
from .registry import QUERIES, SQL

# Executors need not have this package: its functions travel with their code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["QUERIES", "SQL"]
