"""Pieces of the checking SQL. They state each rule anew, in SQL terms."""

from __future__ import annotations

SYSTEM = "You are a helpful assistant."

LINES = "string_split(text, chr(10))"

# Documents as chat records.
CHAT = f"""chat AS (
  SELECT doc_id, n_chars, list_transform({LINES}, lambda x, i: {{
    'role': CASE (doc_id + i - 1) % 4 WHEN 0 THEN 'system' WHEN 2 THEN 'assistant' ELSE 'user' END,
    'content': x}}) AS messages
  FROM documents)"""

# Documents as instruction records.
ALPACA = f"""alpaca AS (
  SELECT doc_id, ({LINES})[1] AS instruction, ({LINES})[2] AS input,
    coalesce(array_to_string(({LINES})[3:], chr(10)), '') AS output
  FROM documents)"""

PROBLEMS = """problems AS (
  SELECT l_orderkey, l_linenumber, p,
    'An order of ' || q || ' pieces costs ' || p || '. What is the total?' AS question,
    ' The ' || q || ' pieces cost ' || p || ' together.' || chr(10) || '#### ' || p || ' ' AS answer
  FROM (SELECT l_orderkey, l_linenumber, l_extendedprice::DECIMAL(18,2)::VARCHAR AS p,
          l_quantity::BIGINT::VARCHAR AS q FROM lineitem))"""

RESPONSES = r"""responses AS (
  SELECT o_orderkey, o_orderpriority, CASE o_orderpriority
      WHEN '1-URGENT' THEN 'The answer is ' || k || ', more or less.'
      WHEN '2-HIGH' THEN 'Order ' || k || ' costs \boxed{' || p || '}, not 7.'
      WHEN '3-MEDIUM' THEN 'Order ' || k || '. Therefore, the answer is ' || p || '. Sure 1'
      WHEN '4-NOT SPECIFIED' THEN 'I paid for ' || k || '. So ' || p
      ELSE 'For order ' || k || ' you pay $' || p || '.' END AS response, p
  FROM (SELECT o_orderkey, o_orderpriority, o_orderkey::VARCHAR AS k,
          o_totalprice::DECIMAL(18,2)::VARCHAR AS p FROM orders))"""


def message(role: str, content: str) -> str:
    """``content`` is an SQL expression."""
    return f"{{'role': '{role}', 'content': {content}}}"


def text(value: str) -> str:
    """A string constant."""
    return "'" + value.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def as_json(messages: str) -> str:
    return f"to_json({messages})::VARCHAR"


def render(messages: str) -> str:
    return (
        f"array_to_string(list_transform({messages}, lambda m: "
        "'<|im_start|>' || m.role || chr(10) || m.content || '<|im_end|>' || chr(10)), '')"
    )


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def words(x: str) -> str:
    return rf"list_filter(regexp_split_to_array({x}, '\s+'), lambda w: w <> '')"


def ensure_system(messages: str, prompt: str = SYSTEM) -> str:
    first = message("system", text(prompt))
    return (
        f"CASE WHEN {messages}[1].role = 'system' THEN {messages} "
        f"ELSE list_concat([{first}], {messages}) END"
    )


def clean(x: str) -> str:
    spaced = rf"regexp_replace({x}, '\s+', ' ', 'g')"
    return strip(rf"regexp_replace({spaced}, '[^\p{{L}}\p{{N}}_\s\-.,!?:;()]', '', 'g')")


def contains_any(x: str, phrases: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(lower({x}), {text(p)})" for p in phrases) + ")"


def coherence(x: str) -> str:
    per_sentence = (
        rf"len(list_filter(regexp_split_to_array({x}, '[.\s]+'), lambda w: w <> ''))::DOUBLE"
        f" / len(string_split({x}, '.'))"
    )
    total = f"len({words(f'lower({x})')})"
    distinct = f"len(list_distinct({words(f'lower({x})')}))"
    last = rf"right(regexp_replace({x}, '\s+$', ''), 1)"
    return f"""CASE WHEN {strip(x)} = '' THEN 0::DOUBLE ELSE (
      (CASE WHEN {per_sentence} BETWEEN 5 AND 25 THEN 1::DOUBLE ELSE 0.7::DOUBLE END)
      + least({distinct}::DOUBLE / {total} * 2, 1::DOUBLE)
      + (CASE WHEN regexp_matches({x}, '^\\p{{Lu}}') AND {last} IN ('.', '!', '?')
           THEN 1::DOUBLE ELSE 0.8::DOUBLE END)) / 3 END"""


def last_number_of(x: str, pattern: str) -> str:
    return f"TRY_CAST(replace(regexp_extract_all({x}, '{pattern}', 1)[-1], ',', '') AS DOUBLE)"


NUMBER = r"([0-9,]+(?:\.[0-9]+)?)"
BOXED = r"\\boxed\{([^}]+)\}"
CONCLUSIONS = (
    r"[Tt]herefore,?\s*(?:the\s+)?(?:answer\s+is\s*)?" + NUMBER,
    r"[Ss]o,?\s*(?:the\s+)?(?:answer\s+is\s*)?" + NUMBER,
    r"[Tt]he\s+answer\s+is\s+" + NUMBER,
)


def boxed_number(x: str) -> str:
    inside = f"replace(regexp_extract_all({x}, '{BOXED}', 1)[-1], ',', '')"
    return f"TRY_CAST(regexp_extract({inside}, '{NUMBER}', 1) AS DOUBLE)"


def conclusion_number(x: str) -> str:
    return "coalesce(" + ", ".join(last_number_of(x, p) for p in CONCLUSIONS) + ")"


def answer(x: str) -> str:
    return f"coalesce({boxed_number(x)}, {conclusion_number(x)}, {last_number_of(x, NUMBER)})"


TIMINGS = f"""timings AS (
  SELECT conv_id, turn, seconds AS generation_time, tokens AS tokens_generated,
    CASE WHEN seconds > 0 THEN tokens / seconds ELSE 0 END AS tokens_per_second
  FROM (SELECT conv_id, turn, length(text) / 1000::DOUBLE AS seconds,
          len({words("text")})::DOUBLE AS tokens FROM conversations))"""

# The stub generator repeats the last user turn of its prompt.
ECHO = "coalesce(list_filter({prompt}, lambda m: m.role = 'user')[-1].content, '')"

PAIRS = f"""{CHAT},
  opened AS (SELECT doc_id, messages,
    list_position(list_transform(messages, lambda m: m.role <> 'assistant'), true) AS i0 FROM chat),
  answered AS (SELECT doc_id, messages, i0, list_position(
    list_transform(messages, lambda m, i: m.role = 'assistant' AND i > i0), true) AS i1
    FROM opened WHERE i0 > 0),
  pairs AS (SELECT doc_id, messages[i0:i1 - 1] AS prompt, messages[i1].content AS expected
    FROM answered WHERE i1 > 0 AND messages[i1].content <> '')"""

RUN_LOG = """run_log AS (
  SELECT user_id AS run, event_id AS step, ts, value AS loss,
    CASE WHEN event_type = 'view' THEN value END AS eval_loss FROM events)"""
