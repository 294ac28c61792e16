"""Plain versions of what the stages compute."""

from test_decontaminate import grams
from test_near_dedup import brute as dedup_plain
from test_pii import brute as pii_plain

__all__ = ["dedup_plain", "grams", "pii_plain"]
