"""Registered queries of the operators and the SQL of those that SQL can express."""

from docloom.llm import (
    ann_search,
    chat_format,
    decontaminate,
    filter_audit,
    hard_negatives,
    language_id,
    line_dedup,
    minhash_dedup,
    mixing,
    pii,
    secret_scan,
    substring_dedup,
    warc,
)

QUERIES = {
    "op1_secret_scan": secret_scan.op1_secret_scan,
    "op2_chat_formatting": chat_format.op2_chat_formatting,
    "op3_pii": pii.op3_pii,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_ann_search": ann_search.op5_ann_search,
    "op6_language_id": language_id.op6_language_id,
    "op7_minhash_near_dedup": minhash_dedup.op7_minhash_near_dedup,
    "op8_warc": warc.op8_warc,
    "op9_benchmark_decontamination": decontaminate.op9_benchmark_decontamination,
    "op10_mixing": mixing.op10_mixing,
    "op11_substring_dedup": substring_dedup.op11_substring_dedup,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

#: Search, language identification and bootstrapped extraction are held against brute force in the tests.
SQL = {
    "op2_chat_formatting": chat_format.SQL,
    "op4_line_dedup": line_dedup.SQL,
    "op7_minhash_near_dedup": minhash_dedup.SQL,
    "op8_warc": warc.SQL,
    "op9_benchmark_decontamination": decontaminate.SQL,
    "op10_mixing": mixing.SQL,
    "op11_substring_dedup": substring_dedup.SQL,
    "op12_filter_audit": filter_audit.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}
