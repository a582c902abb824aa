"""Queries: split, sample, mix, limit."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatprep.operators import sample as sm
from chatprep.plans import inputs
from chatprep.plans.registry import query

_ORDER = "ORDER BY md5(doc_id::VARCHAR || ':42'), doc_id"
_SPLIT = f"""split AS (
  SELECT doc_id, CASE WHEN row_number() OVER ({_ORDER})
      <= floor(count(*) OVER () * (1::DOUBLE - 0.15::DOUBLE))
    THEN 'train' ELSE 'validation' END AS split FROM documents)"""

#: Shares of each source.
WEIGHTS = {f"src{i}": share for i, share in enumerate((0.7, 0.3, 1.0, 0.0, 0.15) * 4)}


@query("split_dataset", f"WITH {_SPLIT} SELECT doc_id, split FROM split")
def split_dataset(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents")
    return sm.split_dataset(docs, ["doc_id"], val_ratio=0.15).select("doc_id", "split")


@query(
    "split_dataset_turns",
    """SELECT conv_id, turn, CASE WHEN
      row_number() OVER (ORDER BY md5(conv_id || ':' || turn || ':7'), conv_id, turn)
      <= floor(count(*) OVER () * (1::DOUBLE - 0.1::DOUBLE))
    THEN 'train' ELSE 'validation' END AS split FROM conversations""",
)
def split_dataset_turns(spark, sf_dir):
    turns = inputs.turns(spark, sf_dir)
    split = sm.split_dataset(turns, ["conv_id", "turn"], val_ratio=0.1, seed=7)
    return split.select("conv_id", "turn", "split")


@query(
    "split_by_group",
    """WITH sizes AS (SELECT conv_id, count(*) AS n, md5(conv_id || ':42') AS h
  FROM conversations GROUP BY conv_id),
placed AS (SELECT conv_id, n, h, sum(n) OVER (ORDER BY h, conv_id) AS upto,
    (SELECT floor(count(*) * (1::DOUBLE - 0.15::DOUBLE)) FROM conversations) AS goal FROM sizes),
nearest AS (SELECT upto FROM (SELECT upto, goal FROM placed UNION ALL SELECT 0, max(goal) FROM placed)
  ORDER BY abs(upto - goal), upto LIMIT 1)
SELECT c.conv_id, c.turn,
  CASE WHEN p.upto <= (SELECT upto FROM nearest) THEN 'train' ELSE 'validation' END AS split
FROM conversations c JOIN placed p ON p.conv_id = c.conv_id""",
)
def split_by_group(spark, sf_dir):
    """The turns of a conversation stay together."""
    turns = inputs.turns(spark, sf_dir)
    return sm.split_by_group(turns, ["conv_id"], val_ratio=0.15).select("conv_id", "turn", "split")


@query("split_counts", f"WITH {_SPLIT} SELECT split, count(*) AS n FROM split GROUP BY split")
def split_counts(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents")
    return sm.split_counts(sm.split_dataset(docs, ["doc_id"], val_ratio=0.15))


@query(
    "sample_n",
    f"SELECT doc_id, lang FROM documents {_ORDER} LIMIT 100",
)
def sample_n(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents")
    return sm.sample_n(docs, 100, ["doc_id"]).select("doc_id", "lang")


_CASES = " ".join(f"WHEN '{source}' THEN {weight}::DOUBLE" for source, weight in WEIGHTS.items())


@query(
    "mix_datasets",
    f"""SELECT source, doc_id FROM (
  SELECT source, doc_id, row_number() OVER (PARTITION BY source {_ORDER}) AS rn,
    count(*) OVER (PARTITION BY source) AS n FROM documents)
WHERE rn <= floor(n * CASE source {_CASES} ELSE 0::DOUBLE END)""",
)
def mix_datasets(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents")
    return sm.mix_sources(docs, WEIGHTS, ["doc_id"]).select("source", "doc_id")


@query(
    "mix_datasets_separate",
    f"""SELECT kind AS source, doc_id FROM (
  SELECT kind, doc_id, row_number() OVER (PARTITION BY kind {_ORDER}) AS rn,
    count(*) OVER (PARTITION BY kind) AS n
  FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN 'english' ELSE 'other' END AS kind FROM documents))
WHERE rn <= floor(n * CASE kind WHEN 'english' THEN 0.25::DOUBLE ELSE 0.75::DOUBLE END)""",
)
def mix_datasets_separate(spark, sf_dir):
    """English documents and all others as two data sets of their own."""
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id", "lang")
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    parts = {"english": docs.where(english), "other": docs.where(~english)}
    return sm.mix_datasets(parts, (0.25, 0.75), ["doc_id"]).select("source", "doc_id")


@query(
    "head_limit",
    "SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 50",
)
def head_limit(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents")
    return sm.head_limit(docs, 50, "doc_id").select("doc_id", F.col("n_chars"))
