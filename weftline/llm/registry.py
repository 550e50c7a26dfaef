"""Queries of this subpackage and the SQL that some of them can be held against."""

from weftline.llm import decontaminate, exactdedup, htmltext, langid, licenses, packing, repeats, simhash, tokenfile, toxicity

QUERIES = {
    "op1_html_text": htmltext.op1_html_text,
    "op2_license_scan": licenses.op2_license_scan,
    "op3_token_file": tokenfile.op3_token_file,
    "op4_language_id": langid.op4_language_id,
    "op5_exact_dedup": exactdedup.op5_exact_dedup,
    "op6_packing": packing.op6_packing,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_simhash": simhash.op8_simhash,
    "op9_repeated_strings": repeats.op9_repeated_strings,
    "op10_decontamination": decontaminate.op10_decontamination,
}
ORACLES = {"op5_exact_dedup": exactdedup.ORACLE, "op10_decontamination": decontaminate.ORACLE}
