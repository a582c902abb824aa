"""Queries: conversions and chat rendering."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatprep.functions import chat as ch
from chatprep.operators import turns as tn
from chatprep.plans import inputs, sql
from chatprep.plans.registry import query



def _shown(messages):
    """Messages as JSON text, which compares equal across engines."""
    return F.to_json(messages).alias("messages")


def _chat_sql(expression: str, name: str = "messages", source: str = sql.CHAT) -> str:
    return f"WITH {source} SELECT doc_id, {expression} AS {name} FROM chat"


def _qa_cell(x: str) -> str:
    return sql.strip(f"coalesce({x}, 'nan')")


_SYSTEM = sql.message("system", sql.text(sql.SYSTEM))


@query(
    "csv_to_chat",
    f"WITH {sql.ALPACA} SELECT doc_id, "
    + sql.as_json(
        f"[{_SYSTEM}, {sql.message('user', _qa_cell('instruction'))}, "
        f"{sql.message('assistant', _qa_cell('input'))}]"
    )
    + " AS messages FROM alpaca",
)
def csv_to_chat(spark, sf_dir):
    chat = ch.qa_to_chat(F.col("instruction"), F.col("input"))
    return inputs.alpaca(spark, sf_dir).select("doc_id", _shown(chat))


_BOTH = sql.strip("instruction || chr(10) || input")


@query(
    "alpaca_to_chat",
    f"WITH {sql.ALPACA} SELECT doc_id, "
    + sql.as_json(
        f"[{_SYSTEM}, "
        + sql.message("user", f"CASE WHEN length(input) > 0 THEN {_BOTH} ELSE instruction END")
        + f", {sql.message('assistant', 'output')}]"
    )
    + " AS messages FROM alpaca",
)
def alpaca_to_chat(spark, sf_dir):
    chat = ch.alpaca_to_chat(F.col("instruction"), F.col("input"), F.col("output"))
    return inputs.alpaca(spark, sf_dir).select("doc_id", _shown(chat))


_STRICT = sql.strip("instruction || chr(10) || coalesce(input, 'None')")


@query(
    "alpaca_format_strict",
    f"WITH {sql.ALPACA} SELECT doc_id, "
    + sql.as_json(
        f"[{_SYSTEM}, {sql.message('user', _STRICT)}, {sql.message('assistant', 'output')}]"
    )
    + " AS messages FROM alpaca",
)
def alpaca_format_strict(spark, sf_dir):
    chat = ch.alpaca_format_strict(F.col("instruction"), F.col("input"), F.col("output"))
    return inputs.alpaca(spark, sf_dir).select("doc_id", _shown(chat))


@query("ensure_system", _chat_sql(sql.as_json(sql.ensure_system("messages"))))
def ensure_system(spark, sf_dir):
    return inputs.chat(spark, sf_dir).select("doc_id", _shown(ch.ensure_system(F.col("messages"))))


@query("prepend_system", _chat_sql(sql.as_json(f"list_concat([{_SYSTEM}], messages)")))
def prepend_system(spark, sf_dir):
    return inputs.chat(spark, sf_dir).select("doc_id", _shown(ch.prepend_system(F.col("messages"))))


_LAST_USER = sql.message("user", "messages[-1].content")


@query(
    "build_chat",
    _chat_sql(
        sql.as_json(
            f"CASE WHEN len(messages) > 1 THEN list_concat(messages[:-2], [{_LAST_USER}]) "
            f"ELSE [{_SYSTEM}, {_LAST_USER}] END"
        )
    ),
)
def build_chat(spark, sf_dir):
    history = F.slice(F.col("messages"), 1, F.size(F.col("messages")) - 1)
    last = F.try_element_at(F.col("messages"), F.lit(-1))["content"]
    return inputs.chat(spark, sf_dir).select("doc_id", _shown(ch.build_chat(last, history)))


@query(
    "append_turn",
    _chat_sql(
        sql.as_json(
            f"list_concat(messages, [{sql.message('assistant', 'messages[1].content')}])"
        )
    ),
)
def append_turn(spark, sf_dir):
    said = F.get(F.col("messages"), F.lit(0))["content"]
    longer = ch.append_turn(F.col("messages"), "assistant", said)
    return inputs.chat(spark, sf_dir).select("doc_id", _shown(longer))


@query("render_chat", _chat_sql(sql.render("messages"), "text"))
def render_chat(spark, sf_dir):
    return inputs.chat(spark, sf_dir).select("doc_id", ch.render_chat(F.col("messages")).alias("text"))


@query(
    "render_prompt",
    _chat_sql(f"{sql.render('messages')} || '<|im_start|>assistant' || chr(10)", "text"),
)
def render_prompt(spark, sf_dir):
    return inputs.chat(spark, sf_dir).select("doc_id", ch.render_prompt(F.col("messages")).alias("text"))


_STRICT_CHAT = (
    f"[{_SYSTEM}, {sql.message('user', _STRICT)}, {sql.message('assistant', 'output')}]"
)


@query(
    "preprocess_dataset",
    f"WITH {sql.CHAT}, {sql.ALPACA} "
    f"SELECT {sql.render(sql.ensure_system('messages'))} AS text FROM chat "
    f"UNION ALL SELECT {sql.render(_STRICT_CHAT)} AS text FROM alpaca",
)
def preprocess_dataset(spark, sf_dir):
    chat = inputs.chat(spark, sf_dir)
    alpaca = inputs.alpaca(spark, sf_dir)
    texts = [
        df.select(ch.preprocess({c: F.col(c) for c in df.columns}, kind).alias("text"))
        for df, kind in ((chat, "chatml"), (alpaca, "alpaca"))
    ]
    return texts[0].unionByName(texts[1])


_SERVICE = (
    "You are a helpful, empathetic customer support agent for Initech. Provide concise, "
    "professional assistance while being understanding of customer concerns."
)
_CODE = (
    "You are a helpful programming assistant. Provide clear, well-commented code examples and "
    "explanations."
)


@query(
    "format_preset",
    f"WITH {sql.CHAT} SELECT doc_id, "
    f"{sql.render(sql.ensure_system('messages', _SERVICE))} AS customer_service, "
    f"{sql.render(sql.ensure_system('messages', _CODE))} AS code_assistant FROM chat",
)
def format_preset(spark, sf_dir):
    return inputs.chat(spark, sf_dir).select(
        "doc_id",
        ch.format_preset(F.col("messages"), "customer_service", "Initech").alias("customer_service"),
        ch.format_preset(F.col("messages"), "code_assistant").alias("code_assistant"),
    )


_MATH = (
    "You are a helpful math tutor. Solve problems step-by-step and provide your final answer in "
    "\\boxed{}."
)
_ASK = (
    "'Solve this math word problem step by step.' || chr(10) || chr(10) || 'Problem: ' || question"
    " || chr(10) || chr(10) || "
    "'Show your work clearly and put your final numerical answer in \\boxed{}.'"
)
_RATIONALE = sql.strip("string_split(answer, '####')[1]")
_GOLD = sql.strip("string_split(answer, '####')[-1]")
_TELL = (
    f"{_RATIONALE} || chr(10) || chr(10) || 'Therefore, the final answer is \\boxed{{' || {_GOLD}"
    " || '}.'"
)


@query(
    "gsm8k_to_chat",
    f"WITH {sql.PROBLEMS} SELECT l_orderkey, l_linenumber, "
    + sql.as_json(
        f"[{sql.message('system', sql.text(_MATH))}, {sql.message('user', _ASK)}, "
        f"{sql.message('assistant', _TELL)}]"
    )
    + " AS messages FROM problems",
)
def gsm8k_to_chat(spark, sf_dir):
    chat = ch.gsm8k_to_chat(F.col("question"), F.col("answer"))
    return inputs.word_problems(spark, sf_dir).select("l_orderkey", "l_linenumber", _shown(chat))


@query(
    "gsm8k_gold",
    f"WITH {sql.PROBLEMS} SELECT l_orderkey, l_linenumber, {_GOLD} AS gold FROM problems",
)
def gsm8k_gold(spark, sf_dir):
    gold = ch.gsm8k_gold(F.col("answer"))
    return inputs.word_problems(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", gold.alias("gold")
    )


@query(
    "gsm8k_adapter_prompt",
    f"WITH {sql.PROBLEMS} SELECT l_orderkey, l_linenumber, 'Solve this step by step:' || chr(10) "
    "|| chr(10) || question || chr(10) || chr(10) || 'Put your final answer in \\boxed{}.' "
    "AS prompt FROM problems",
)
def gsm8k_adapter_prompt(spark, sf_dir):
    prompt = ch.gsm8k_adapter_prompt(F.col("question"))
    return inputs.word_problems(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", prompt.alias("prompt")
    )


# ---- tables of single turns --------------------------------------------------------------------

_ENSURED = f"""ensured AS (
  SELECT conv_id, turn, role, text AS content FROM conversations
  UNION ALL
  SELECT conv_id, min(turn) - 1, 'system', {sql.text(sql.SYSTEM)} FROM conversations
  GROUP BY conv_id HAVING arg_min(role, turn) <> 'system')"""


@query("ensure_system_turns", f"WITH {_ENSURED} SELECT conv_id, turn, role, content FROM ensured")
def ensure_system_turns(spark, sf_dir):
    return tn.ensure_system(inputs.turns(spark, sf_dir))


@query(
    "prepend_system_turns",
    f"""SELECT conv_id, turn, role, text AS content FROM conversations
  UNION ALL SELECT conv_id, min(turn) - 1, 'system', {sql.text(sql.SYSTEM)}
  FROM conversations GROUP BY conv_id""",
)
def prepend_system_turns(spark, sf_dir):
    return tn.prepend_system(inputs.turns(spark, sf_dir))


@query(
    "append_turn_turns",
    """SELECT conv_id, turn, role, text AS content FROM conversations
  UNION ALL SELECT conv_id, max(turn) + 1, 'user', 'Goodbye after ' || count(*) || ' turns.'
  FROM conversations GROUP BY conv_id""",
)
def append_turn_turns(spark, sf_dir):
    turns = inputs.turns(spark, sf_dir)
    said = F.concat(F.lit("Goodbye after "), F.count(F.lit(1)).cast("string"), F.lit(" turns."))
    return tn.append_turn(turns, "user", turns.groupBy("conv_id").agg(said.alias("content")))


@query(
    "render_chat_turns",
    f"WITH {_ENSURED} SELECT conv_id, turn, '<|im_start|>' || role || chr(10) || content || "
    "'<|im_end|>' || chr(10) AS text FROM ensured",
)
def render_chat_turns(spark, sf_dir):
    return tn.render_turns(tn.ensure_system(inputs.turns(spark, sf_dir)))
