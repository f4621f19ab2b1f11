"""The operators over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from partnerscope.llm import chat_format, collocations, decontaminate, html_extract, language_id, lm_score, minhash, packing, quality_lines, spelling, substring, token_counts, toxicity
from partnerscope.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_html_extract(spark, sf_dir):
    return html_extract.main_text(table(spark, sf_dir, "pages"))


@query
def op2_pack(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


@query
def op3_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@query
def op4_quality_rules(spark, sf_dir):
    return quality_lines.rated_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_chat_format(spark, sf_dir):
    return chat_format.formatted(table(spark, sf_dir, "conversations"))


@query
def op6_substring(spark, sf_dir):
    return substring.repeat_digest(table(spark, sf_dir, "documents"))


@query
def op7_toxicity(spark, sf_dir):
    return toxicity.toxic_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_minhash(spark, sf_dir):
    return minhash.near_copies(table(spark, sf_dir, "documents"), size=3, percent=85)


@query
def op9_decontaminate(spark, sf_dir):
    return decontaminate.contaminated_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query
def op10_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language_id.identify_all(table(spark, sf_dir, "pages"), docs, language_id.fit(docs))


@query
def op11_lm_score(spark, sf_dir):
    return lm_score.scored_documents(table(spark, sf_dir, "documents"))


@query
def op12_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op13_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


#: DuckDB's form of those that SQL can express.
ORACLE: dict[str, str] = {
    "op5_chat_format": chat_format.ORACLE_SQL,
    "op6_substring": substring.oracle_sql(),
    "op8_minhash": minhash.oracle_sql(size=3, percent=85),
    "op12_collocations": collocations.oracle_sql(),
}
