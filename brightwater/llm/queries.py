"""Queries of the training-data operators; each covers its whole table."""

from brightwater.llm import byte_bpe, decontaminate, language, line_dedup, near_dedup, quality, suffix_dedup, token_store, vector_search, web_archive

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.query,
    "op2_byte_bpe": byte_bpe.query,
    "op3_decontaminate": decontaminate.query,
    "op4_near_dedup": near_dedup.query,
    "op5_web_archive": web_archive.query,
    "op6_vector_search": vector_search.query,
    "op7_token_store": token_store.query,
    "op8_line_dedup": line_dedup.query,
    "op9_language_id": language.query,
    "op10_quality": quality.query,
}
#: The same operators over further tables.
FURTHER = {"op9_language_of_pages": language.pages_query}
ORACLE_SQL = {"op5_web_archive": web_archive.ORACLE_SQL, "op6_vector_search": vector_search.ORACLE_SQL, "op8_line_dedup": line_dedup.ORACLE_SQL}
