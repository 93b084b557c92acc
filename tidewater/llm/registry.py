"""The training-data queries and their oracles, by name."""

from __future__ import annotations

from . import (bpe, chat, decontaminate, embeddings, language, lexical, pii, sharding, simhash, spelling,
               suffixes, url_rules, warc)

_MODULES = (chat, embeddings, simhash, pii, url_rules, suffixes, decontaminate, sharding, language, bpe, lexical,
            spelling, warc)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
