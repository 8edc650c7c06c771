"""The registered query of every operator, with its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from tabrisk.llm import bpe, embed_dedup, fingerprint, html_extract, language, lexical, lm_score, ngram_join, packing, periodic, quality, secret_scan, topk

QUERIES = {
    "op1_embedding_dedup": embed_dedup.op1,
    "op2_fingerprint": fingerprint.op2,
    "op3_lm_score": lm_score.op3,
    "op4_ngram_join": ngram_join.op4,
    "op5_html_extract": html_extract.op5,
    "op6_language_id": language.op6,
    "op7_secret_scan": secret_scan.op7,
    "op8_packing": packing.op8,
    "op9_quality": quality.op9,
    "op10_bpe": bpe.op10,
    "op11_periodic_runs": periodic.op11,
    "op12_lexical_search": lexical.op12,
    "op13_topk_search": topk.op13,
}
ORACLE: dict[str, str] = {
    "op1_embedding_dedup": embed_dedup.OP1_SQL.strip(),
    "op4_ngram_join": ngram_join.OP4_SQL.strip(),
    "op11_periodic_runs": periodic.OP11_SQL.strip(),
    "op12_lexical_search": lexical.OP12_SQL.strip(),
    "op13_topk_search": topk.OP13_SQL.strip(),
}
