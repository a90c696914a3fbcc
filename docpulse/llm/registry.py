"""All queries of the subpackage with their SQL."""

from docpulse.llm import bpe, chat, exact_dedup, lexical, licences, mixing, ngram_join, quality, resharding, spelling, suffix_dedup, topk, url_filter  # noqa: F401
from docpulse.llm.common import ORACLES, QUERIES  # noqa: F401
