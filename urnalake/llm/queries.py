"""Importing this module registers the query of every operator."""

from urnalake.llm import (  # noqa: F401
    bpe,
    centroids,
    chat,
    langid,
    licences,
    merkle,
    mixing,
    neardup,
    substrings,
    topk,
    trie,
    warc,
    wordbpe,
)
