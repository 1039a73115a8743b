"""Registered queries of this subpackage, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewright.llm import chat, chunks, html_text, katz, kneser_ney, maxscore, mixing, pieces, repeats, runs, simhash, toxicity, treap
from sitewright.llm.common import table

#: Weights of the mixture by path: domains, then languages within each; sources of a language weigh the same.
LEVELS = ("domain", "lang", "source")
WEIGHTS = {(f"domain{d}",): parts for d, parts in enumerate((4, 3, 2, 1))} | {(f"domain{d}", lang): parts for d in range(4) for lang, parts in (("en", 6), ("de", 2), ("fr", 2), ("es", 1))}

#: Tools of the calls that ``tool_calls`` reads from conversations.
TOOLS = {
    "search": {"query": ("string", True), "limit": ("integer", True), "exact": ("boolean", False)},
    "lookup": {"key": ("string", True), "limit": ("integer", False)},
}


def with_domain(docs: DataFrame) -> DataFrame:
    """The tables have no domains: sources are dealt into four by the last letter of their name."""
    letter = F.ascii(F.substring(F.coalesce("source", F.lit("")), -1, 1))
    return docs.withColumn("domain", F.concat(F.lit("domain"), (letter % 4).cast("string")))


def tool_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results read from chat turns: a user's turn is a call, an assistant's turn answers the turn before it.

    A call builds on the call two turns earlier. Long questions go to search, short ones to
    lookup; turns of every tenth conversation give the limit as text, which the schema refuses.
    """
    name = F.when(F.length("text") >= 80, "search").otherwise("lookup")
    ident = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), (F.col("turn") + turn).cast("string"))
    limit = F.when(F.col("conv_id") % 10 == 3, F.concat(F.lit('"'), F.col("turn").cast("string"), F.lit('"'))).otherwise(F.col("turn").cast("string"))
    quoted = lambda key: F.expr(f"substring(to_json(named_struct('{key}', text)), 2, length(to_json(named_struct('{key}', text))) - 2)")
    body = F.when(F.length("text") >= 80, quoted("query")).otherwise(quoted("key"))
    arguments = F.concat(F.lit("{ "), body, F.lit(', "limit": '), limit, F.lit("}"))
    after = F.when(F.col("turn") >= 2, F.array(ident(-2))).otherwise(F.array().cast("array<string>"))
    calls = conversations.where("role = 'user'").select("conv_id", "turn", ident(0).alias("call_id"), name.alias("name"), arguments.alias("arguments"), after.alias("after"))
    results = conversations.where("role = 'assistant'").select("conv_id", "turn", ident(-1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def other_turns(conversations: DataFrame) -> DataFrame:
    """Turns of neither user nor assistant, those of no role too."""
    return conversations.where("role is null or role not in ('user', 'assistant')").select("conv_id", "turn", "role", F.col("text").alias("content"))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(table(spark, sf_dir, "documents"), kneser_ney.trusted_labels(table(spark, sf_dir, "labels")))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = maxscore.quantised(table(spark, sf_dir, "embeddings"))
    return maxscore.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op4_katz_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"), katz.every_seventh())


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), keep_text=False).drop("kept")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(with_domain(table(spark, sf_dir, "documents")), LEVELS, WEIGHTS)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), pieces.load())


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return chat.format_calls(*tool_calls(conversations), TOOLS, other_turns(conversations))


def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.fingerprints(table(spark, sf_dir, "documents"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.find_runs(table(spark, sf_dir, "documents"), plant=True, keep_text=False)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treap.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_extraction, op2_quality_classifier, op3_exact_top_k, op4_katz_scoring, op5_suffix_array_dedup,
        op6_source_mixing, op7_sentencepiece, op8_chat_formatting, op9_document_fingerprints, op10_simhash_near_dedup,
        op11_toxicity, op12_run_detection, op13_lexical_search,
    )
}
