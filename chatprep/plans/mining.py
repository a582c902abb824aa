"""Queries: training examples out of documents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chatprep.functions import text as tx
from chatprep.operators import examples as ex
from chatprep.operators import packing as pk
from chatprep.plans import inputs, sql
from chatprep.plans.registry import query


def _docs(spark, sf_dir):
    return inputs.table(spark, sf_dir, "documents")


@query("clean_text", f"SELECT doc_id, {sql.clean('text')} AS cleaned FROM documents")
def clean_text(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", tx.clean_text(F.col("text")).alias("cleaned"))


_PATTERN = " ".join(
    f"WHEN regexp_matches(line, '{pattern}') THEN '{name}'"
    for name, pattern in inputs.TEST_SECTIONS.items()
)


@query(
    "extract_sections",
    f"""WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw,
    unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents),
lines AS (SELECT doc_id, pos, {sql.strip("raw")} AS line FROM split),
marked AS (SELECT doc_id, pos, line, CASE {_PATTERN} END AS header FROM lines WHERE line <> ''),
placed AS (SELECT *, coalesce(last_value(header IGNORE NULLS) OVER (
    PARTITION BY doc_id ORDER BY pos), 'general') AS section FROM marked),
kept AS (SELECT *, max(CASE WHEN header IS NOT NULL THEN pos END) OVER (
    PARTITION BY doc_id, section) AS opened FROM placed)
SELECT doc_id, section, pos::INTEGER AS pos, line FROM kept
WHERE header IS NULL AND (opened IS NULL OR pos > opened)""",
)
def extract_sections(spark, sf_dir):
    return ex.section_rows(_docs(spark, sf_dir), inputs.TEST_SECTIONS)


_CHUNKS = """chunks AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS chunk,
    unnest(range(len(string_split(text, chr(10)))))::INTEGER AS pos FROM documents)"""
_IS_USEFUL = (
    f"length({sql.strip('chunk')}) > 50 AND {sql.contains_any('chunk', inputs.TEST_WORDS)}"
)


@query("chunk_text", f"WITH {_CHUNKS} SELECT doc_id, pos, chunk FROM chunks")
def chunk_text(spark, sf_dir):
    return ex.chunk_rows(_docs(spark, sf_dir), tx.chunk_text(F.col("text"), "\n"))


@query(
    "filter_useful_chunks",
    f"""WITH {_CHUNKS} SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1)
    ::INTEGER AS pos, {sql.strip("chunk")} AS chunk FROM chunks WHERE {_IS_USEFUL}""",
)
def filter_useful_chunks(spark, sf_dir):
    chunks = tx.useful_chunks(tx.chunk_text(F.col("text"), "\n"), inputs.TEST_WORDS)
    return ex.chunk_rows(_docs(spark, sf_dir), chunks)


@query(
    "limit_chunks_per_doc",
    f"""WITH {_CHUNKS}, long AS (
  SELECT doc_id, pos, chunk, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS rn
  FROM chunks WHERE length({sql.strip("chunk")}) > 50),
kept AS (SELECT doc_id, pos, {sql.strip("chunk")} AS chunk FROM long WHERE rn <= 20)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1)::INTEGER AS pos, chunk
FROM kept WHERE len({sql.words("chunk")}) > 10""",
)
def limit_chunks_per_doc(spark, sf_dir):
    """Every long line counts as useful here, so that many documents have more than 20."""
    chunks = tx.useful_chunks(tx.chunk_text(F.col("text"), "\n"), ("",))
    return ex.chunk_rows(_docs(spark, sf_dir), tx.limit_chunks(chunks))


_LIMITED = f"""{_CHUNKS},
cleaned AS (SELECT doc_id, pos, {sql.clean("chunk")} AS chunk FROM chunks),
ranked AS (SELECT doc_id, pos, chunk, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS rn
  FROM cleaned WHERE {_IS_USEFUL}),
mined AS (SELECT doc_id, chunk, (row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1)::INTEGER
    AS pos FROM ranked WHERE len({sql.words("chunk")}) > 10)"""
_EXAMPLE = "[" + ", ".join(
    (
        sql.message("system", sql.text(ex.DOCUMENTATION_PROMPT)),
        sql.message("user", sql.text(ex.DOCUMENTATION_QUESTION)),
        sql.message("assistant", "chunk"),
    )
) + "]"
_WHOLE = sql.clean("text")


@query(
    "make_training_examples",
    f"""WITH whole AS (SELECT doc_id, {_WHOLE} AS chunk FROM documents)
SELECT doc_id, 0::INTEGER AS pos, {sql.as_json(_EXAMPLE)} AS messages FROM whole
WHERE {_IS_USEFUL} AND len({sql.words("chunk")}) > 10""",
)
def make_training_examples(spark, sf_dir):
    examples = ex.make_training_examples(_docs(spark, sf_dir), inputs.DOCUMENT_RULES)
    return examples.withColumn("messages", F.to_json("messages"))


@query(
    "make_training_examples_by_line",
    f"WITH {_LIMITED} SELECT doc_id, pos, {sql.as_json(_EXAMPLE)} AS messages FROM mined",
)
def make_training_examples_by_line(spark, sf_dir):
    examples = ex.make_training_examples(_docs(spark, sf_dir), inputs.LINE_RULES)
    return examples.withColumn("messages", F.to_json("messages"))


@query(
    "chunk_topic",
    f"""WITH {_CHUNKS} SELECT doc_id, pos, array_to_string({sql.words("chunk")}[:10], ' ') AS topic
FROM chunks""",
)
def chunk_topic(spark, sf_dir):
    chunks = ex.chunk_rows(_docs(spark, sf_dir), tx.chunk_text(F.col("text"), "\n"))
    return chunks.select("doc_id", "pos", tx.chunk_topic(F.col("chunk")).alias("topic"))


@query(
    "examples_per_doc",
    f"""WITH {_LIMITED} SELECT d.doc_id, count(m.pos)::INTEGER AS n_examples
FROM documents d LEFT JOIN mined m ON m.doc_id = d.doc_id GROUP BY d.doc_id""",
)
def examples_per_doc(spark, sf_dir):
    return ex.examples_per_doc(_docs(spark, sf_dir), inputs.LINE_RULES)


@query(
    "examples_total",
    f"""WITH {_LIMITED} SELECT (SELECT count(*) FROM documents) AS n_documents,
  count(DISTINCT doc_id) AS n_with_examples, count(*) AS n_examples FROM mined""",
)
def examples_total(spark, sf_dir):
    return ex.examples_total(_docs(spark, sf_dir), inputs.LINE_RULES)


_BLOCK = 256


@query(
    "pack_sequences",
    f"""WITH sized AS (
  SELECT doc_id, len({sql.words("text")})::BIGINT AS n_tokens FROM documents),
placed AS (SELECT doc_id, n_tokens,
    (sum(n_tokens) OVER (ORDER BY doc_id))::BIGINT - n_tokens AS before FROM sized
  WHERE n_tokens > 0),
pieces AS (SELECT *, unnest(range(before // {_BLOCK}, (before + n_tokens - 1) // {_BLOCK} + 1))
    AS block FROM placed)
SELECT doc_id, block, greatest(before, block * {_BLOCK}) - block * {_BLOCK} AS block_offset,
  greatest(before, block * {_BLOCK}) - before AS token_from,
  least(before + n_tokens, (block + 1) * {_BLOCK}) - greatest(before, block * {_BLOCK}) AS n
FROM pieces""",
)
def pack_sequences(spark, sf_dir):
    sized = _docs(spark, sf_dir).select(
        "doc_id", tx.word_count(F.col("text")).alias("n_tokens")
    )
    return pk.pack_sequences(sized, "doc_id", "n_tokens", _BLOCK, width=4096)


_CONVERSATIONS = f"""sized AS (SELECT conv_id, sum(len({sql.words("text")}))::BIGINT AS n_tokens
  FROM conversations GROUP BY conv_id)"""
_WHOLE_BLOCK = 2048


def _conversation_sizes(spark, sf_dir):
    words = tx.word_count(F.col("content")).cast("bigint")
    return inputs.turns(spark, sf_dir).groupBy("conv_id").agg(F.sum(words).alias("n_tokens"))


@query(
    "pack_whole",
    f"""WITH {_CONVERSATIONS} SELECT conv_id, n_tokens,
  CASE WHEN n_tokens BETWEEN 1 AND {_WHOLE_BLOCK} THEN 'packed' ELSE 'left out' END AS place
FROM sized""",
)
def pack_whole(spark, sf_dir):
    """Whether each conversation lies whole in its block, without touching another one there."""
    packed = pk.pack_whole(_conversation_sizes(spark, sf_dir), "conv_id", "n_tokens", _WHOLE_BLOCK)
    end = F.col("block_offset") + F.col("n_tokens")
    following = F.lead("block_offset", 1, _WHOLE_BLOCK).over(
        Window.partitionBy("block").orderBy("block_offset")
    )
    apart = packed.where("block IS NOT NULL").withColumn("apart", end <= following)
    judged = apart.unionByName(packed.where("block IS NULL"), allowMissingColumns=True)
    place = F.when(F.col("block").isNull(), "left out").when(F.col("apart"), "packed").otherwise("overlaps")
    return judged.select("conv_id", "n_tokens", place.alias("place"))


@query(
    "pack_whole_fill",
    f"""WITH {_CONVERSATIONS} SELECT count(*) FILTER (n_tokens BETWEEN 1 AND {_WHOLE_BLOCK}) AS n_packed,
  sum(n_tokens) FILTER (n_tokens BETWEEN 1 AND {_WHOLE_BLOCK})::BIGINT AS n_tokens,
  true AS well_filled FROM sized""",
)
def pack_whole_fill(spark, sf_dir):
    """Blocks are filled to 95 % at least, but for the last one."""
    packed = pk.pack_whole(_conversation_sizes(spark, sf_dir), "conv_id", "n_tokens", _WHOLE_BLOCK)
    fill = pk.packing_fill(packed, _WHOLE_BLOCK)
    full = F.col("n_tokens") >= 0.95 * _WHOLE_BLOCK * (F.col("n_blocks") - 1)
    return fill.select("n_packed", "n_tokens", full.alias("well_filled"))


_MEGA, _BUDGET = 64, 4096
_BATCHES = f"""RECURSIVE {_CONVERSATIONS}, ranked AS (SELECT *, (row_number() OVER (
      ORDER BY md5(conv_id || ':42'), conv_id) - 1) // {_MEGA} AS mega FROM sized),
ordered AS (SELECT *, row_number() OVER (PARTITION BY mega ORDER BY n_tokens DESC, conv_id) - 1 AS pos,
    greatest({_BUDGET} // greatest(n_tokens, 1), 1) AS room FROM ranked),
starts AS (SELECT mega, pos, room FROM ordered WHERE pos = 0
  UNION ALL
  SELECT o.mega, o.pos, o.room FROM starts s JOIN ordered o ON o.mega = s.mega AND o.pos = s.pos + s.room),
numbered AS (SELECT mega, pos, room, row_number() OVER (ORDER BY mega, pos) - 1 AS batch FROM starts),
batches AS (SELECT o.conv_id, o.n_tokens AS length, o.mega, b.batch, (o.pos - b.pos)::INTEGER AS place
  FROM ordered o JOIN numbered b ON b.mega = o.mega AND o.pos >= b.pos AND o.pos < b.pos + b.room)"""


def _length_batches(spark, sf_dir):
    sizes = _conversation_sizes(spark, sf_dir)
    return pk.length_batches(sizes, "conv_id", "n_tokens", _BUDGET, mega_batch=_MEGA)


@query("length_batches", f"WITH {_BATCHES} SELECT conv_id, length, mega, batch, place FROM batches")
def length_batches(spark, sf_dir):
    return _length_batches(spark, sf_dir)


@query(
    "length_batches_padding",
    f"""WITH {_BATCHES}, padded AS (SELECT sum(length)::BIGINT AS own, max(length) * count(*) AS padded
  FROM batches GROUP BY batch)
SELECT count(*) AS n_batches, sum(own)::BIGINT AS n_tokens, sum(padded)::BIGINT AS n_padded,
  round(1 - sum(own) / sum(padded), 6) AS padding FROM padded""",
)
def length_batches_padding(spark, sf_dir):
    share = pk.padding_share(_length_batches(spark, sf_dir))
    return share.withColumn("padding", F.round("padding", 6))


@query(
    "length_buckets",
    """SELECT n_chars // 512 AS bucket, count(*) AS n, min(n_chars) AS min_length,
  max(n_chars) AS max_length FROM documents GROUP BY 1""",
)
def length_buckets(spark, sf_dir):
    return pk.length_buckets(_docs(spark, sf_dir), "n_chars", 512)
