"""The registered queries of this subpackage and their SQL, where SQL can
express them."""

from __future__ import annotations

from termflow.llm.ann import op5_nearest_neighbours
from termflow.llm.bpe import op3_bpe_encoding
from termflow.llm.html import op1_html_extraction
from termflow.llm.jaccard import op2_ngram_jaccard_join
from termflow.llm.packing import op10_best_fit_packing
from termflow.llm.ranked import ORACLE_SQL as RANKED_SQL, op13_ranked_search
from termflow.llm.secrets import op4_secret_scans
from termflow.llm.substrings import ORACLE_SQL as SUBSTRINGS_SQL, op12_substring_dedup
from termflow.llm.topk import ORACLE_SQL as TOPK_SQL, op6_exact_top_k
from termflow.llm.toxicity import op8_toxicity
from termflow.llm.warc import ORACLE_SQL as WARC_SQL, op7_warc_archives
from termflow.llm.wavelet import op9_wavelet_token_files
from termflow.llm.whitening import op11_embedding_whitening

QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_bpe_encoding": op3_bpe_encoding,
    "op4_secret_scans": op4_secret_scans,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_warc_archives": op7_warc_archives,
    "op8_toxicity": op8_toxicity,
    "op9_wavelet_token_files": op9_wavelet_token_files,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_ranked_search": op13_ranked_search,
}

ORACLE_SQL: dict[str, str] = {
    "op6_exact_top_k": TOPK_SQL,
    "op7_warc_archives": WARC_SQL,
    "op12_substring_dedup": SUBSTRINGS_SQL,
    "op13_ranked_search": RANKED_SQL,
}
