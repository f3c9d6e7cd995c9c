"""The queries of this subpackage and, where SQL can say it, their SQL."""

from __future__ import annotations

from caseloom.llm import (
    chat,
    cotrain,
    decontaminate,
    language_id,
    licenses,
    line_rules,
    merkle,
    mixing,
    segment,
    simhash,
    warc,
    whitening,
    wrapper,
)

_MODULES = (
    language_id,
    cotrain,
    licenses,
    segment,
    warc,
    wrapper,
    line_rules,
    decontaminate,
    simhash,
    chat,
    merkle,
    whitening,
    mixing,
)

QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
