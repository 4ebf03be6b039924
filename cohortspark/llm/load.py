"""Imports every query module of the subpackage, which registers its queries."""

from . import decontaminate_queries, language_id_queries, line_chunks_queries, media_queries, mixing_queries, recompression_queries, roles_queries, sanitise_queries, secrets_queries, simhash_queries, spelling_queries, structure_queries, warc_queries  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
