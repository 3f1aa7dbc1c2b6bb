"""The registered queries of these operators, over whole tables with production parameters."""

from tablelift.llm import (
    attribution, decontaminate, filter_audit, htmltext, language, licenses, packing, pii, prefix_trie, quality, secrets, simhash,
    tokenfile,
)
from tablelift.llm.common import table
from tablelift.session import new_staging_dir


def op1_main_text(spark, sf_dir):
    return htmltext.main_text(table(spark, sf_dir, "pages"))


def op2_token_file(spark, sf_dir):
    path = new_staging_dir(spark, "tokens")
    tokenfile.write_tokens(table(spark, sf_dir, "documents"), path)
    return tokenfile.with_crc(tokenfile.read_tokens(spark, path))


def op3_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_decontamination(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_personal_data(spark, sf_dir):
    return pii.find(table(spark, sf_dir, "documents"))


def op6_quality(spark, sf_dir):
    return quality.rules(table(spark, sf_dir, "documents"))


def op7_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_secrets(spark, sf_dir):
    return secrets.find(table(spark, sf_dir, "documents"))


def op9_token_counts(spark, sf_dir):
    return attribution.count_tokens(table(spark, sf_dir, "documents"))


def op10_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark, sf_dir):
    return filter_audit.filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def op13_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_main_text, op2_token_file, op3_simhash, op4_decontamination, op5_personal_data, op6_quality, op7_packing,
        op8_secrets, op9_token_counts, op10_licenses, op11_filter_audit, op12_prefix_trie, op13_language,
    )
}

ORACLES = {
    "op6_quality": quality.ORACLE, "op10_licenses": licenses.ORACLE, "op11_filter_audit": filter_audit.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
}
