"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pinwheel.llm import (bpe, chunks, collocations, langid, licenses, lmscore, mainhtml, mixing, pii, quality, repair, simhash,
                          toxicity)
from pinwheel.sources.tables import load


def tokenizer_path(name: str) -> str:
    """Where an installed public vocabulary file lies."""
    import public_tokenizers
    return public_tokenizers.path(name)


def q_bpe(spark, sf_dir):
    return bpe.bpe_digest(load(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def q_toxicity(spark, sf_dir):
    return toxicity.toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def q_langid(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return langid.identify_language(docs, langid.fit_language_id(docs))


def q_simhash(spark, sf_dir):
    return simhash.simhash_components(load(spark, sf_dir, "documents"))


def q_mixing(spark, sf_dir):
    return mixing.mix(load(spark, sf_dir, "documents"))


def q_pii(spark, sf_dir):
    return pii.pii_documents(load(spark, sf_dir, "documents"))


def q_quality(spark, sf_dir):
    return quality.quality_rules(load(spark, sf_dir, "documents"))


def q_chunks(spark, sf_dir):
    return chunks.edited_neighbours(load(spark, sf_dir, "documents"))


def q_html(spark, sf_dir):
    return mainhtml.page_texts(load(spark, sf_dir, "pages"))


def q_licenses(spark, sf_dir):
    return licenses.license_scan(load(spark, sf_dir, "documents"))


def q_repair(spark, sf_dir):
    return repair.repair_report(repair.damage(load(spark, sf_dir, "conversations")))


def q_collocations(spark, sf_dir):
    return collocations.collocations(load(spark, sf_dir, "documents"))


def q_lmscore(spark, sf_dir):
    return lmscore.lm_scores(load(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality": q_quality,
    "op2_mixing": q_mixing,
    "op3_toxicity": q_toxicity,
    "op4_html": q_html,
    "op5_chunks": q_chunks,
    "op6_bpe": q_bpe,
    "op7_pii": q_pii,
    "op8_simhash": q_simhash,
    "op9_licenses": q_licenses,
    "op10_langid": q_langid,
    "op11_repair": q_repair,
    "op12_collocations": q_collocations,
    "op13_lmscore": q_lmscore,
}

ORACLES = {
    "op9_licenses": licenses.oracle_sql(),
    "op1_quality": quality.oracle_sql(),
    "op2_mixing": mixing.MIX_SQL,
    "op11_repair": repair.oracle_sql(),
    "op12_collocations": collocations.oracle_sql(),
}
