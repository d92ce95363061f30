"""Queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline

from . import decontaminate, html_extract, kneser_ney, language_id, licenses, mixing, simhash, token_binary, url_filter, webp

_MODULES = (language_id, mixing, token_binary, simhash, kneser_ney, webp, html_extract, decontaminate, url_filter, licenses, corpus_pipeline)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in getattr(module, "ORACLE", {}).items()}
