"""Queries: evaluation pairs, generations, scores, answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatprep.functions import answers as an
from chatprep.functions import chat as ch
from chatprep.functions import scores as sc
from chatprep.functions.text import clean_text
from chatprep.operators import evaluate as ev
from chatprep.operators import turns as tn
from chatprep.plans import inputs, sql
from chatprep.plans.registry import query
from chatprep.sources.scratch import scratch_path


def echo_factory():
    """A generator factory for tests: the response is the last user turn, a character takes a
    millisecond, a word is a token. Defined inside a function, so that it is shipped by value."""

    def factory(options):
        def answer(messages):
            said = [m["content"] for m in messages if m["role"] == "user"]
            response = said[-1] if said else ""
            return response, len(response) / 1000, len(response.split())

        def generate(conversations):
            return [answer(messages) for messages in conversations]

        return generate

    return factory


def _round(column: str, digits: int = 6):
    return F.round(column, digits).alias(column)


@query(
    "eval_pairs",
    f"""WITH {sql.PAIRS} SELECT doc_id, {sql.as_json("prompt")} AS prompt_messages,
  expected AS expected_response FROM pairs""",
)
def eval_pairs(spark, sf_dir):
    prompt = F.to_json("prompt_messages").alias("prompt_messages")
    return ev.eval_pairs(inputs.chat(spark, sf_dir)).select("doc_id", prompt, "expected_response")


_TURN_PAIRS = """opening AS (
  SELECT conv_id, min(turn) AS first_turn FROM conversations WHERE role <> 'assistant' GROUP BY 1),
answers AS (
  SELECT c.conv_id, first_turn, turn AS answer_turn, text AS expected_response,
    row_number() OVER (PARTITION BY c.conv_id ORDER BY turn) AS rn
  FROM conversations c JOIN opening o ON c.conv_id = o.conv_id AND c.turn > o.first_turn
  WHERE role = 'assistant'),
pairs AS (SELECT conv_id, first_turn, answer_turn, expected_response FROM answers
  WHERE rn = 1 AND expected_response <> '')"""


@query(
    "eval_pairs_turns",
    f"WITH {_TURN_PAIRS} SELECT conv_id, first_turn, answer_turn, expected_response FROM pairs",
)
def eval_pairs_turns(spark, sf_dir):
    return tn.eval_pairs(inputs.turns(spark, sf_dir))


@query(
    "eval_prompt_turns",
    f"""WITH {_TURN_PAIRS} SELECT c.conv_id, turn, role, text AS content
FROM conversations c JOIN pairs p ON c.conv_id = p.conv_id
WHERE turn >= first_turn AND turn < answer_turn""",
)
def eval_prompt_turns(spark, sf_dir):
    turns = inputs.turns(spark, sf_dir)
    return tn.prompt_turns(turns, tn.eval_pairs(turns))


@query(
    "expected_answer_coherence",
    f"""WITH {_TURN_PAIRS}, prompts AS (
  SELECT p.conv_id, count(*) AS prompt_turns FROM conversations c JOIN pairs p
    ON c.conv_id = p.conv_id WHERE turn >= first_turn AND turn < answer_turn GROUP BY 1)
SELECT prompt_turns, count(*) AS n, round(avg({sql.coherence("expected_response")}), 6)
    AS avg_coherence, min(length(expected_response))::INTEGER AS min_length,
  max(length(expected_response))::INTEGER AS max_length
FROM pairs JOIN prompts ON pairs.conv_id = prompts.conv_id GROUP BY prompt_turns""",
)
def expected_answer_coherence(spark, sf_dir):
    """How coherent the expected answers are, by the length of their prompt."""
    pairs = tn.eval_pairs_sized(inputs.turns(spark, sf_dir))
    expected = F.col("expected_response")
    return (
        pairs.select(
            "prompt_turns",
            sc.coherence_score(expected).alias("coherence"),
            F.length(expected).alias("chars"),
        )
        .groupBy("prompt_turns")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.avg("coherence"), 6).alias("avg_coherence"),
            F.min("chars").alias("min_length"),
            F.max("chars").alias("max_length"),
        )
    )


_PROMPT = "list_filter(messages, lambda m: m.role <> 'assistant' OR m = messages[1])"
_WITH_IDS = f"""{sql.CHAT}, prompts AS (
  SELECT chat.doc_id, CASE WHEN quality IS NULL THEN chat.doc_id::VARCHAR
      ELSE 'doc-' || chat.doc_id END AS conversation_id, {_PROMPT} AS prompt
  FROM chat LEFT JOIN labels ON chat.doc_id = labels.doc_id)"""


@query(
    "conversation_prompt",
    f"WITH {_WITH_IDS} SELECT conversation_id, {sql.as_json('prompt')} AS prompt FROM prompts",
)
def conversation_prompt(spark, sf_dir):
    return inputs.chat_with_metadata(spark, sf_dir).select(
        ch.conversation_id(F.col("metadata"), F.col("doc_id")).alias("conversation_id"),
        F.to_json(ch.conversation_prompt(F.col("messages"))).alias("prompt"),
    )


@query(
    "conversation_prompt_turns",
    """WITH first AS (SELECT conv_id, arg_min(role, turn) AS role, arg_min(text, turn) AS text
  FROM conversations GROUP BY 1)
SELECT c.conv_id, turn, c.role, c.text AS content FROM conversations c JOIN first f
  ON c.conv_id = f.conv_id WHERE c.role <> 'assistant' OR (c.role = f.role AND c.text = f.text)""",
)
def conversation_prompt_turns(spark, sf_dir):
    return tn.conversation_prompt(inputs.turns(spark, sf_dir))


_ECHOED = f"""echoed AS (SELECT *, length(response) / 1000::DOUBLE AS generation_time,
    len({sql.words("response")})::INTEGER AS tokens_generated FROM responses)"""
_SPEED = (
    "CASE WHEN generation_time > 0 THEN tokens_generated / generation_time ELSE 0 END "
    "AS tokens_per_second"
)


@query(
    "batch_generate",
    f"""WITH {sql.CHAT}, responses AS (
  SELECT doc_id, {sql.ECHO.format(prompt="messages")} AS response FROM chat), {_ECHOED}
SELECT doc_id, response, generation_time, tokens_generated, {_SPEED} FROM echoed""",
)
def batch_generate(spark, sf_dir):
    results = ev.batch_generate(inputs.chat(spark, sf_dir), echo_factory())
    return results.drop("messages")


@query(
    "tokens_per_second",
    f"""WITH {sql.TIMINGS}
SELECT conv_id, turn, tokens_per_second FROM timings""",
)
def tokens_per_second(spark, sf_dir):
    return inputs.timings(spark, sf_dir).select("conv_id", "turn", "tokens_per_second")


@query(
    "zip_results",
    f"""WITH {sql.CHAT}, results AS (SELECT doc_id, {sql.clean("text")} AS response FROM documents)
SELECT chat.doc_id, messages[-1].content AS user_message, response
FROM chat JOIN results ON chat.doc_id = results.doc_id""",
)
def zip_results(spark, sf_dir):
    chat = inputs.chat(spark, sf_dir)
    results = inputs.table(spark, sf_dir, "documents").select(
        "doc_id", clean_text(F.col("text")).alias("response")
    )
    last = F.try_element_at("messages", F.lit(-1))["content"].alias("user_message")
    return ev.zip_results(chat, results, "doc_id").select("doc_id", last, "response")


METRICS_SQL = """SELECT count(*) AS total_samples,
  round(sum(generation_time), 6) AS total_generation_time,
  sum(tokens_generated)::BIGINT AS total_tokens_generated,
  round(avg(generation_time), 6) AS avg_generation_time,
  round(quantile_cont(generation_time, 0.5), 6) AS median_generation_time,
  round(avg(tokens_per_second), 6) AS avg_tokens_per_second,
  round(quantile_cont(tokens_per_second, 0.5), 6) AS median_tokens_per_second,
  round(avg(tokens_generated), 6) AS avg_tokens_per_response,
  round(quantile_cont(tokens_generated, 0.5), 6) AS median_tokens_per_response FROM timings"""


def rounded(df):
    kinds = dict(df.dtypes)
    return df.select(*[_round(c) if kinds[c] == "double" else c for c in df.columns])


@query("eval_metrics", f"WITH {sql.TIMINGS} {METRICS_SQL}")
def eval_metrics(spark, sf_dir):
    stored = scratch_path(spark, "timings")
    inputs.timings(spark, sf_dir).write.parquet(stored)
    return rounded(ev.eval_metrics(spark.read.parquet(stored)))


_METRICS = ("generation_time", "tokens_per_second", "tokens_generated")
_EACH = " UNION ALL ".join(
    f"""SELECT '{m}' AS metric, count({m}) AS n, round(sum({m}::DOUBLE), 6) AS total,
  round(avg({m}::DOUBLE), 6) AS mean, min({m}::DOUBLE) AS lo, max({m}::DOUBLE) AS hi,
  true AS median_in_bounds FROM timings"""
    for m in _METRICS
)


@query("eval_summaries", f"WITH {sql.TIMINGS} {_EACH}")
def eval_summaries(spark, sf_dir):
    """Summaries of two shards stored at different times, merged; the medians' true ranks are within
    the stated error."""
    base = scratch_path(spark, "summaries")
    timings = inputs.timings(spark, sf_dir)
    timings.write.parquet(f"{base}/details")
    details = spark.read.parquet(f"{base}/details")
    for shard in range(2):
        part = details.where(F.col("turn") % 2 == shard).withColumn("shard", F.lit(shard))
        ev.eval_summaries(part, ["shard"]).write.parquet(f"{base}/sums/part={shard}")
    merged = ev.merge_summaries(spark.read.parquet(f"{base}/sums"))
    ranks = ev.median_ranks(details, merged)
    error = F.col("rank_error")
    within = (F.col("below") <= 0.5 + error) & (F.col("upto") >= 0.5 - error)
    return merged.join(ranks, "metric").select(
        "metric",
        "n",
        F.round("total", 6).alias("total"),
        F.round("mean", 6).alias("mean"),
        "lo",
        "hi",
        within.alias("median_in_bounds"),
    )


@query(
    "evaluate_on_dataset",
    f"""WITH {sql.PAIRS}, responses AS (
  SELECT doc_id + 1 AS sample_id, expected AS expected_response,
    {sql.ECHO.format(prompt="prompt")} AS response FROM pairs), {_ECHOED}
SELECT sample_id, expected_response, response AS generated_response, generation_time,
  tokens_generated, {_SPEED} FROM echoed""",
)
def evaluate_on_dataset(spark, sf_dir):
    details, _ = ev.evaluate_on_dataset(
        inputs.chat(spark, sf_dir), "doc_id", echo_factory(), scratch_path(spark, "details")
    )
    return details.drop("prompt_messages")


@query(
    "evaluate_on_dataset_metrics",
    f"""WITH {sql.PAIRS}, responses AS (
  SELECT {sql.ECHO.format(prompt="prompt")} AS response FROM pairs), {_ECHOED},
timings AS (SELECT generation_time, tokens_generated, {_SPEED} FROM echoed) {METRICS_SQL}""",
)
def evaluate_on_dataset_metrics(spark, sf_dir):
    chat = inputs.chat(spark, sf_dir)
    return rounded(
        ev.evaluate_quick(chat, "doc_id", echo_factory(), scratch_path(spark, "details"), None)
    )


@query(
    "evaluate_conversations",
    f"""WITH {_WITH_IDS}, responses AS (SELECT conversation_id,
  {sql.ECHO.format(prompt="prompt")} AS response FROM prompts), {_ECHOED}
SELECT conversation_id, response AS generated_response, generation_time, tokens_generated, {_SPEED},
  length(response)::INTEGER AS response_length, {sql.coherence("response")}
    AS coherence_score FROM echoed""",
)
def evaluate_conversations(spark, sf_dir):
    return ev.evaluate_conversations(
        inputs.chat_with_metadata(spark, sf_dir), "doc_id", echo_factory(), metadata="metadata"
    )


@query(
    "response_length",
    f"""SELECT conv_id, turn, length(text)::INTEGER AS response_length,
  len({sql.words("text")})::INTEGER AS response_words FROM conversations""",
)
def response_length(spark, sf_dir):
    text = F.col("content")
    return inputs.turns(spark, sf_dir).select(
        "conv_id",
        "turn",
        sc.response_length(text).alias("response_length"),
        sc.response_words(text).alias("response_words"),
    )


@query(
    "coherence_score",
    f"SELECT doc_id, {sql.coherence('text')} AS coherence_score FROM documents",
)
def coherence_score(spark, sf_dir):
    score = sc.coherence_score(F.col("text"))
    return inputs.table(spark, sf_dir, "documents").select(
        "doc_id", score.alias("coherence_score")
    )


@query(
    "speed_summary",
    f"""WITH {sql.TIMINGS} SELECT round(sum(generation_time), 6) AS total_benchmark_time,
  count(*) AS num_samples, round(avg(generation_time), 6) AS avg_generation_time,
  round(min(generation_time), 6) AS min_generation_time,
  round(max(generation_time), 6) AS max_generation_time,
  round(avg(tokens_per_second), 6) AS avg_tokens_per_second,
  round(min(tokens_per_second), 6) AS min_tokens_per_second,
  round(max(tokens_per_second), 6) AS max_tokens_per_second FROM timings""",
)
def speed_summary(spark, sf_dir):
    return rounded(ev.speed_summary(inputs.timings(spark, sf_dir)))


# Phrases that occur in the invented prose.
_FORCED = ("you ", "wh an")
_TONE = ("thou", "erth")
_PHRASE = "Le "
_FLAGS = f"""flagged AS (
  SELECT conv_id, turn, role, NOT {sql.contains_any("text", _FORCED)} AS natural_ending,
    {sql.contains_any("text", _TONE)} AS conversational,
    contains(text, {sql.text(_PHRASE)}) AS says_phrase,
    len({sql.words("text")})::INTEGER AS response_length FROM conversations)"""
_FLAG_NAMES = ("natural_ending", "conversational", "says_phrase")


def _flagged(spark, sf_dir):
    text = F.col("content")
    return inputs.turns(spark, sf_dir).select(
        "conv_id",
        "turn",
        "role",
        sc.has_none(text, _FORCED).alias("natural_ending"),
        sc.has_any(text, _TONE).alias("conversational"),
        sc.has_exact(text, _PHRASE).alias("says_phrase"),
        sc.response_words(text).alias("response_length"),
    )


@query(
    "keyword_flags",
    f"WITH {_FLAGS} SELECT conv_id, turn, natural_ending, conversational, says_phrase FROM flagged",
)
def keyword_flags(spark, sf_dir):
    return _flagged(spark, sf_dir).drop("role", "response_length")


_SUMMARY = (
    "count(*) AS total, "
    + ", ".join(f"count(*) FILTER ({f}) AS {f}_count" for f in _FLAG_NAMES)
    + ", round(avg(response_length), 6) AS avg_response_length, "
    + ", ".join(
        f"round(100 * count(*) FILTER ({f}) / count(*)::DOUBLE, 6) AS {f}_pct" for f in _FLAG_NAMES
    )
)


@query("flag_summary", f"WITH {_FLAGS} SELECT role, {_SUMMARY} FROM flagged GROUP BY role")
def flag_summary(spark, sf_dir):
    flags = _flagged(spark, sf_dir)
    return rounded(ev.flag_summary(flags, _FLAG_NAMES, "response_length", by=["role"]))


_GATE = {"natural_ending": 0.7, "conversational": 0.3}


@query(
    "quality_gate",
    f"""WITH {_FLAGS} SELECT role, count(*) AS total,
  count(*) FILTER (natural_ending) AS natural_ending_count,
  count(*) FILTER (conversational) AS conversational_count,
  count(*) FILTER (natural_ending) >= count(*) * 0.7::DOUBLE
    AND count(*) FILTER (conversational) >= count(*) * 0.3::DOUBLE AS success
FROM flagged GROUP BY role""",
)
def quality_gate(spark, sf_dir):
    summary = ev.flag_summary(_flagged(spark, sf_dir), list(_GATE), by=["role"])
    gate = ev.quality_gate(summary, _GATE)
    return gate.select("role", "total", "natural_ending_count", "conversational_count", "success")


@query(
    "extract_answer",
    f"""WITH {sql.RESPONSES} SELECT o_orderkey, {sql.answer("response")} AS answer FROM responses""",
)
def extract_answer(spark, sf_dir):
    return inputs.responses(spark, sf_dir).select(
        "o_orderkey", an.extract_answer(F.col("response")).alias("answer")
    )


@query(
    "extract_answer_documents",
    f"SELECT doc_id, {sql.answer('text')} AS answer FROM documents",
)
def extract_answer_documents(spark, sf_dir):
    return inputs.table(spark, sf_dir, "documents").select(
        "doc_id", an.extract_answer(F.col("text")).alias("answer")
    )


@query(
    "extract_boxed",
    f"""WITH {sql.RESPONSES} SELECT o_orderkey,
  regexp_extract(response, '{sql.BOXED}', 1) AS boxed FROM responses""",
)
def extract_boxed(spark, sf_dir):
    return inputs.responses(spark, sf_dir).select(
        "o_orderkey", an.extract_boxed(F.col("response")).alias("boxed")
    )


@query(
    "extract_first_of",
    f"""WITH {sql.RESPONSES} SELECT o_orderkey, coalesce({sql.conclusion_number("response")},
  {sql.boxed_number("response")}, -1::DOUBLE) AS answer FROM responses""",
)
def extract_first_of(spark, sf_dir):
    strategies = (an.conclusion_number, an.boxed_number, lambda _: F.lit(-1.0))
    answer = an.extract_first_of(F.col("response"), strategies)
    return inputs.responses(spark, sf_dir).select("o_orderkey", answer.alias("answer"))


@query(
    "accuracy",
    f"""WITH {sql.RESPONSES} SELECT o_orderpriority, count(*) AS n_samples, round(100 *
  avg(CASE WHEN {sql.answer("response")} = p::DOUBLE THEN 1 ELSE 0 END), 6) AS accuracy
FROM responses GROUP BY o_orderpriority""",
)
def accuracy(spark, sf_dir):
    judged = inputs.responses(spark, sf_dir).select(
        "o_orderpriority",
        an.extract_answer(F.col("response")).alias("predicted"),
        ch.gsm8k_gold(F.col("answer")).try_cast("double").alias("gold"),
    )
    return rounded(ev.accuracy(judged, "predicted", "gold", by=["o_orderpriority"]))


@query(
    "best_checkpoint",
    """WITH scored AS (SELECT user_id AS run, event_id AS step,
  abs((props->>'$.k')::DOUBLE - value) AS gap FROM events),
ranked AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY gap, step) AS rn FROM scored)
SELECT run, step AS best_step, round(gap, 6) AS gap FROM ranked WHERE rn = 1""",
)
def best_checkpoint(spark, sf_dir):
    log = inputs.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"),
        F.col("event_id").alias("step"),
        F.col("value").alias("train_loss"),
        F.get_json_object("props", "$.k").cast("double").alias("eval_loss"),
    )
    return rounded(ev.best_checkpoint(log, ["run"], "step", "train_loss", "eval_loss"))


@query(
    "ensemble_results",
    f"""SELECT lang AS model, round(avg({sql.coherence("text")}), 6) AS custom,
  round(avg(quality), 6) AS official, round(avg(1 - toxic), 6) AS human
FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id GROUP BY lang""",
)
def ensemble_results(spark, sf_dir):
    """Languages as models, judged by coherence, by quality label and by toxicity label."""
    docs = inputs.table(spark, sf_dir, "documents").select(
        "doc_id", "lang", sc.coherence_score(F.col("text")).alias("custom")
    )
    judged = docs.join(inputs.table(spark, sf_dir, "labels"), "doc_id", "left")
    means = judged.groupBy(F.col("lang").alias("model")).agg(
        F.avg("custom").alias("custom"),
        F.avg("quality").alias("official"),
        F.avg(1 - F.col("toxic")).alias("human"),
    )
    scores = means.unpivot("model", ["custom", "official", "human"], "method", "score")
    return rounded(ev.ensemble_results(scores, ["custom", "official", "human"]))
