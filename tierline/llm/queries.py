"""The registered queries of this subpackage, one per operator."""

from __future__ import annotations

from tierline.llm.store import table


def op5_toxicity(spark, sf_dir):
    from tierline.llm.toxicity import op5_toxicity
    return op5_toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_jaccard_join(spark, sf_dir):
    from tierline.llm.jaccard import op4_jaccard_join
    return op4_jaccard_join(spark, table(spark, sf_dir, "documents"))


def op8_decontamination(spark, sf_dir):
    from tierline.llm.decontam import op8_decontamination
    return op8_decontamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_mixing(spark, sf_dir):
    from tierline.llm.mixing import op10_mixing
    return op10_mixing(spark, table(spark, sf_dir, "documents"))


def op3_token_output(spark, sf_dir):
    from tierline.llm.tokens import op3_token_output
    return op3_token_output(spark, table(spark, sf_dir, "documents"))


def op2_secret_scan(spark, sf_dir):
    from tierline.llm.secrets import op2_secret_scan
    return op2_secret_scan(spark, table(spark, sf_dir, "documents"))


def op9_warc(spark, sf_dir):
    from tierline.llm.warc import op9_warc
    return op9_warc(spark, table(spark, sf_dir, "pages"))


def op7_html_main(spark, sf_dir):
    from tierline.llm.html_main import op7_html_main
    return op7_html_main(spark, table(spark, sf_dir, "pages"))


def op1_suffix_dedup(spark, sf_dir):
    from tierline.llm.suffix_dedup import op1_suffix_dedup
    return op1_suffix_dedup(spark, table(spark, sf_dir, "documents"))


def op6_embedding_dedup(spark, sf_dir):
    from tierline.llm.embed_dedup import op6_embedding_dedup
    return op6_embedding_dedup(spark, table(spark, sf_dir, "embeddings"))


def op11_packing(spark, sf_dir):
    from tierline.llm.packing import op11_packing
    return op11_packing(spark, table(spark, sf_dir, "documents"))


def op12_vector_codes(spark, sf_dir):
    from tierline.llm.vector_codes import op12_vector_codes
    return op12_vector_codes(spark, table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark, sf_dir):
    from tierline.llm.periodic import op13_periodic_runs
    return op13_periodic_runs(spark, table(spark, sf_dir, "documents"))


def queries():
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def oracle_sql():
    from tierline.llm.decontam import OP8_SQL
    from tierline.llm.mixing import OP10_SQL
    from tierline.llm.vector_codes import OP12_SQL
    from tierline.llm.warc import OP9_SQL
    return {"op8_decontamination": OP8_SQL, "op9_warc": OP9_SQL, "op10_mixing": OP10_SQL,
            "op12_vector_codes": OP12_SQL}
