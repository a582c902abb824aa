"""Tables in the shapes the operators take, derived from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatprep.functions.chat import message
from chatprep.functions.scores import tokens_per_second
from chatprep.functions.text import word_count
from chatprep.operators.examples import MiningRules

# The invented prose of the test tables holds none of the usual words, so these stand in.
TEST_WORDS = ("license", "whwh", "bless")
TEST_SECTIONS = {
    "overview": "(?i)tiontion",
    "requirements": "(?i)bless?",
    "steps": "(?i)whwh",
}
LINE_RULES = MiningRules(separator="\n", indicators=TEST_WORDS, clean_first=False)
DOCUMENT_RULES = MiningRules(indicators=TEST_WORDS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").withColumnRenamed("text", "content")


def chat(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """Every document as a chat record: its lines are the turns, roles go round in a cycle that
    starts at another place for each document."""
    roles = F.array(*[F.lit(r) for r in ("system", "user", "assistant", "user")])

    def turn(line: Column, i: Column) -> Column:
        place = (F.col("doc_id") + i) % 4
        return message(F.get(roles, place.cast("int")), line)

    docs = table(spark, sf_dir, "documents")
    messages = F.transform(F.split("text", "\n"), turn)
    return docs.select("doc_id", *keep, messages.alias("messages"))


def chat_with_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a label carry its quality and an id of their own in their metadata."""
    labels = table(spark, sf_dir, "labels")
    metadata = F.create_map(
        F.lit("id"),
        F.concat(F.lit("doc-"), F.col("doc_id")),
        F.lit("quality"),
        F.col("quality").cast("string"),
    )
    return chat(spark, sf_dir).join(
        labels.select("doc_id", metadata.alias("metadata")), "doc_id", "left"
    )


def alpaca(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as instruction records: first line, second line (may be missing), the rest."""
    lines = F.split("text", "\n")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.get(lines, F.lit(0)).alias("instruction"),
        F.get(lines, F.lit(1)).alias("input"),
        F.array_join(F.slice(lines, 3, F.size(lines)), "\n").alias("output"),
    )


def word_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as word problems; the answer ends in the marked result."""
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    pieces = F.col("l_quantity").cast("bigint").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.concat(
            F.lit("An order of "), pieces, F.lit(" pieces costs "), price,
            F.lit(". What is the total?"),
        ).alias("question"),
        F.concat(
            F.lit(" The "), pieces, F.lit(" pieces cost "), price, F.lit(" together.\n#### "),
            price, F.lit(" "),
        ).alias("answer"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as responses to a price question, in several ways of putting the answer; those of
    urgent orders name a wrong one."""
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    key = F.col("o_orderkey").cast("string")
    said = {
        "1-URGENT": F.concat(F.lit("The answer is "), key, F.lit(", more or less.")),
        "2-HIGH": F.concat(
            F.lit("Order "), key, F.lit(" costs \\boxed{"), price, F.lit("}, not 7.")
        ),
        "3-MEDIUM": F.concat(
            F.lit("Order "), key, F.lit(". Therefore, the answer is "), price, F.lit(". Sure 1")
        ),
        "4-NOT SPECIFIED": F.concat(F.lit("I paid for "), key, F.lit(". So "), price),
    }
    text = F.concat(F.lit("For order "), key, F.lit(" you pay $"), price, F.lit("."))
    for priority, sentence in said.items():
        text = F.when(F.col("o_orderpriority") == priority, sentence).otherwise(text)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        text.alias("response"),
        F.concat(F.lit("The price is on the bill. #### "), price).alias("answer"),
    )


def timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded generations: the turns of the conversations, timed by their length."""
    tokens = word_count(F.col("content"))
    seconds = F.length("content") / 1000
    return turns(spark, sf_dir).select(
        "conv_id",
        "turn",
        tokens.alias("tokens_generated"),
        seconds.alias("generation_time"),
        tokens_per_second(tokens, seconds).alias("tokens_per_second"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the log of one training run per user. Evaluations are logged as views."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("user_id").alias("run"),
        F.col("event_id").alias("step"),
        "ts",
        F.col("value").alias("loss"),
        F.when(F.col("event_type") == "view", F.col("value")).alias("eval_loss"),
    )


def log_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log entries with a JSON object of metrics."""
    events = table(spark, sf_dir, "events")
    metrics = F.to_json(
        F.struct(
            F.col("value").alias("loss"),
            F.get_json_object("props", "$.k").cast("int").alias("k"),
            (F.col("event_type") == "error").alias("failed"),
            F.col("event_type").alias("note"),
        )
    )
    return events.select(
        F.lit("shop").alias("project"),
        F.col("event_type").alias("experiment"),
        F.col("user_id").cast("string").alias("run"),
        F.col("event_id").alias("step"),
        metrics.alias("metrics"),
    )


def chat_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat records as JSON lines, many of them broken in some way that depends on their length."""
    records = chat(spark, sf_dir, "n_chars")
    good = F.to_json(F.struct("messages"))
    bot = F.to_json(
        F.struct(
            F.transform(
                "messages",
                lambda m: message(
                    F.when(m["role"] == "assistant", "bot").otherwise(m["role"]), m["content"]
                ),
            ).alias("messages")
        )
    )
    contents = F.to_json(F.struct(F.col("messages.content").alias("messages")))
    roles = F.to_json(
        F.struct(
            F.transform("messages", lambda m: F.struct(m["role"].alias("role"))).alias("messages")
        )
    )
    kind = F.col("n_chars") % 8
    value = (
        F.when(kind == 0, F.substring(good, 1, 12))
        .when(kind == 1, F.to_json(F.struct(F.col("messages").alias("turns"))))
        .when(kind == 2, F.lit('{"messages":[]}'))
        .when(kind == 3, contents)
        .when(kind == 4, roles)
        .when(kind == 5, bot)
        .otherwise(good)
    )
    return records.select("doc_id", value.alias("value"))
