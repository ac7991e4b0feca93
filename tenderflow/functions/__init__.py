"""Column helpers (F1-F33, A10-A12) and the two string-distance Pandas UDFs."""

from .columns import *  # noqa: F401,F403
