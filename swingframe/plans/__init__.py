"""Every registered query; importing the package fills the registry."""

from swingframe.plans import bags, courses, files, made, planning, shots, strategy  # noqa: F401
from swingframe.plans.registry import QUERIES, oracle_texts

ORACLE_TEXTS = oracle_texts()
