"""How the supplied tables become chat records.  These bindings are choices of
this repository, and stand here only; ``sql`` repeats them for the oracle.

Conversations: a record per conversation, domain chat.  Documents: the first
line is the user's, the rest the answer (a single line is both); every third
document's answer begins with its first line as a think block; the domain goes
round by id; a label of quality stands for the pass rate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.storage import cut, spread
from ..functions.text import text, think_parts, words
from ..operators import mix, normalize
from ..operators.render import record_text
from ..operators.tokens import token_count

ROTATION = ("math", "code", "science", "chat", "if")
LICENSES = ("CC-BY-4.0", "cc-by-nc-4.0", "check-card", "MIT")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def conversation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("turns"))
    at = turns.select(F.col("conv_id").alias("idx"), F.col("conv_id").cast("string").alias("_native"), normalize.clean_turns(F.col("turns"), "role", "content", normalize.PLAIN_ROLES).alias("messages"))
    fixed = {"domain": "chat", "source": "conversations", "name": "conversations", "license": "unknown"}
    at = at.withColumns({k: F.lit(v) for k, v in fixed.items()}).withColumn("source_rank", F.lit(100))
    return normalize.assemble(at.withColumns({"_config": F.lit(None).cast("string"), "_expected": F.lit(None).cast("string"), "_rate": F.lit(None).cast("double")}))


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, source, body, its first line and the rest."""
    body = text("text")
    rest = F.when(F.contains(body, F.lit("\n")), F.substring(body, F.locate("\n", body) + 1, F.length(body))).otherwise(body)
    return docs.select("doc_id", "source", body.alias("body"), F.split_part(body, F.lit("\n"), F.lit(1)).alias("usr"), rest.alias("rest"))


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lines(table(spark, sf_dir, "documents"))
    raw = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("<think>"), F.split_part("rest", F.lit("\n"), F.lit(1)), F.lit("</think>"), F.col("rest"))).otherwise(F.col("rest"))
    rank = F.substring("source", 4, 10).cast("int")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("_rate"))
    at = at.withColumn("messages", normalize.answered(F.col("usr"), think_parts(raw))).join(labels, "doc_id", "left")
    return normalize.assemble(
        at.select(
            F.col("doc_id").alias("idx"), F.col("doc_id").cast("string").alias("_native"), "messages", "source", F.col("source").alias("name"), rank.alias("source_rank"),
            F.element_at(F.array(*map(F.lit, ROTATION)), (F.col("doc_id") % 5 + 1).cast("int")).alias("domain"),
            F.element_at(F.array(*map(F.lit, LICENSES)), (rank % 4 + 1).cast("int")).alias("license"),
            "_rate", F.lit(None).cast("string").alias("_config"), F.lit(None).cast("string").alias("_expected"),
        )
    )


def items(records: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """The narrow index of the mix: bodies stay behind and are joined back later.
    Tokens are those of the tokenizer file, or words where none is given."""
    tokens = F.size(words(record_text(F.col("messages")))).cast("long") if tokenizer_path is None else token_count(record_text(F.col("messages")), tokenizer_path)
    rlen = F.aggregate("messages", F.lit(0).cast("long"), lambda a, m: a + F.length(text(m["reasoning"])))
    return records.select("name", "idx", "domain", "source", "source_rank", tokens.alias("tokens"), rlen.alias("rlen"), F.col("meta.pass_rate").alias("difficulty"))


SEED = 42
# The default ratios of the recipes.
STAGE1 = {"math": 0.30, "code": 0.26, "science": 0.12, "chat": 0.22, "if": 0.10}
STAGE2 = {"code": 0.34, "math": 0.22, "chat": 0.18, "if": 0.14, "tool": 0.12}
BUDGET = {"stage1": 150_000.0, "stage2": 60_000.0, "stage3": 40_000.0}
REPLAY = 0.20
EXCLUSIVE, LONGEST, HARDEST = ["src18", "src19"], ["src3"], ["src5"]


def stage1(index: DataFrame) -> DataFrame:
    return mix.stage_mix(index.filter(~F.col("source").isin(EXCLUSIVE)), STAGE1, BUDGET["stage1"], SEED, "stage1")


def stage2(index: DataFrame) -> DataFrame:
    own = mix.stage_mix(index.filter(~F.col("source").isin(EXCLUSIVE)), STAGE2, BUDGET["stage2"] * (1 - REPLAY), SEED, "stage2").withColumn("copy", F.lit(None).cast("int")).withColumn("part", F.lit("recipe"))
    again = mix.replay(cut(stage1(index)), BUDGET["stage2"] * REPLAY, SEED).withColumn("part", F.lit("replay"))
    return own.unionByName(again)


def stage3(index: DataFrame) -> DataFrame:
    return mix.polish_stage(index, EXCLUSIVE, LONGEST, HARDEST, BUDGET["stage3"])


def all_stages(index: DataFrame) -> DataFrame:
    keep = ["stage", "name", "idx", "domain", "tokens"]
    parts = [f(index).withColumn("stage", F.lit(n)).select(*keep) for n, f in (("stage1", stage1), ("stage2", stage2), ("stage3", stage3))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
