"""The registered queries of the training-data operators, each over its whole tables, and their SQL."""

from __future__ import annotations

from . import codes, digests, hnsw, jaccard, licenses, lm, mixing, packing, rules, spelling, toxicity, urls, warc
from .common import table


def op1_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op2_licenses(spark, sf_dir):
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("matches")


def op3_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_jaccard(spark, sf_dir):
    return jaccard.jaccard_join(table(spark, sf_dir, "documents"))


def op5_mixing(spark, sf_dir):
    copies = mixing.shuffled(mixing.replicate(table(spark, sf_dir, "documents").select("doc_id", "text", "source")))
    return copies.select("row.doc_id", "row.source", "copy", "shuffle_key")


def op6_warc(spark, sf_dir):
    read = warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages")))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_rules(spark, sf_dir):
    return rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_urls(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages"))


def op9_lm(spark, sf_dir):
    return lm.lm_scores(table(spark, sf_dir, "documents"))


def op10_hnsw(spark, sf_dir):
    return hnsw.search_table(table(spark, sf_dir, "embeddings"))


def op11_spelling(spark, sf_dir):
    return spelling.spelling(table(spark, sf_dir, "documents"))


def op12_fingerprints(spark, sf_dir):
    return digests.fingerprints(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark, sf_dir):
    return codes.vector_codes(table(spark, sf_dir, "embeddings"))


OPERATORS = (op1_packing, op2_licenses, op3_toxicity, op4_jaccard, op5_mixing, op6_warc, op7_rules, op8_urls, op9_lm, op10_hnsw, op11_spelling, op12_fingerprints, op13_vector_codes)
QUERIES = {f.__name__: f for f in OPERATORS}
ORACLES = {"op5_mixing": mixing.MIX_SQL.format(docs="documents"), "op6_warc": warc.ROUNDTRIP_SQL, "op13_vector_codes": codes.CODES_SQL}
