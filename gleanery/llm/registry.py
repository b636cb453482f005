"""Queries of this subpackage and their SQL, by the names that __spark_entry__.py registers."""

from __future__ import annotations

from .bpe import op1_bpe
from .exact_dedup import OP2_SQL, op2_exact_dedup
from .langid import op8_langid
from .near_join import OP3_SQL, op3_ngram_jaccard
from .packing import op7_packing
from .quality import OP9_SQL, op9_quality_rules
from .sentence_spans import op5_sentence_spans
from .toxicity import op6_toxicity
from .url_filter import OP4_SQL, op4_url_filter
from .warc import OP10_SQL, op10_warc

QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_url_filter": op4_url_filter,
    "op5_sentence_spans": op5_sentence_spans,
    "op6_toxicity": op6_toxicity,
    "op7_packing": op7_packing,
    "op8_langid": op8_langid,
    "op9_quality_rules": op9_quality_rules,
    "op10_warc": op10_warc,
}
ORACLES: dict[str, str] = {"op2_exact_dedup": OP2_SQL, "op3_ngram_jaccard": OP3_SQL, "op4_url_filter": OP4_SQL, "op9_quality_rules": OP9_SQL, "op10_warc": OP10_SQL}
