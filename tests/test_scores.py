import functools
import math
import random
import re
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chatprep.functions import answers as an
from chatprep.functions import scores as sc
from chatprep.operators import evaluate as ev

few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@pytest.mark.parametrize(
    "text, value",
    [
        ("x \\boxed{1,234.5} \\boxed{7}", 7.0),
        ("\\boxed{abc} Therefore, the answer is 42. Then 9", 42.0),
        ("So 5 but the answer is 6", 5.0),
        ("Also 5, then 8", 5.0),
        ("So, 1,000 items", 1000.0),
        ("price $3.50.", 3.5),
        ("\\boxed{-4}", 4.0),
        ("\\boxed{\\frac{1}{2}}", 1.0),
        ("Therefore , 3", 3.0),
        ("Some 5, So the total is 6", 6.0),
        ("Therefore, , So 8 and 9", 8.0),
        ("a, b", None),
        ("nothing", None),
        ("", None),
        (None, None),
    ],
)
def test_extract_answer(over, text, value):
    assert over([text], "string", an.extract_answer) == [value]


def test_boxed_and_own_strategies(over):
    assert over(["a \\boxed{x+1} \\boxed{2}", "b"], "string", an.extract_boxed) == ["x+1", ""]
    got = over(["7", "none"], "string",
               lambda x: an.extract_first_of(x, [an.last_number, lambda _: F.lit(-1.0)]))
    assert got == [7.0, -1.0]


def coherence(text):
    """The same three parts, counted with regular expressions."""
    words = re.findall(r"\S+", text.lower())
    if not words:
        return 0.0
    per_sentence = len(re.findall(r"[^\s.]+", text)) / (text.count(".") + 1)
    parts = (
        0.7 + 0.3 * (5 <= per_sentence <= 25),
        min(1.0, 2 * len(set(words)) / len(words)),
        1.0 if text[:1].isupper() and re.search(r"[.!?]\s*\Z", text) else 0.8,
    )
    return sum(parts) / 3


@few
@given(
    st.lists(
        st.lists(
            st.sampled_from(["A", "b", "b", "ab", "Éa", "ǅ", ".", ". ", "! ", "? ", " ", "\n",
                             "\xa0", "\x1c", "\U0001f600"]),
            max_size=30,
        ).map("".join),
        min_size=30,
        max_size=60,
    )
)
def test_coherence(over, values):
    got = over(values, "string", sc.coherence_score)
    # Sums of three terms in another order may differ in the last bit.
    assert got == pytest.approx([coherence(v) for v in values], abs=1e-12)


def test_flags(over):
    values = ["You CAN do it", "hope this helps!", "Drive safe!", "drive safe!"]
    assert over(values, "string", lambda x: sc.has_any(x, sc.CONVERSATIONAL)) == [
        True, False, False, False,
    ]
    assert over(values, "string", lambda x: sc.has_none(x, sc.FORCED_ENDINGS)) == [
        True, False, True, True,
    ]
    assert over(values, "string", lambda x: sc.has_exact(x, "Drive safe!")) == [
        False, False, True, False,
    ]


def test_tokens_per_second(over):
    got = over([0.0, 2.0, -1.0], "double", lambda s: sc.tokens_per_second(F.lit(5), s))
    assert got == [0.0, 2.5, 0.0]


def test_eval_metrics(spark):
    rows = [(1, 0.5, 3, 6.0), (2, 1.5, 4, 2.0), (3, 0.25, 8, 32.0), (4, 9.0, 1, 0.1)]
    names = "sample_id int, generation_time double, tokens_generated int, tokens_per_second double"
    got = ev.eval_metrics(spark.createDataFrame(rows, names)).first()
    assert got.total_samples == 4
    assert got.total_tokens_generated == 16
    assert got.median_generation_time == statistics.median(r[1] for r in rows)
    assert got.median_tokens_per_response == statistics.median(r[2] for r in rows)
    assert got.avg_tokens_per_second == pytest.approx(statistics.mean(r[3] for r in rows))
    empty = ev.eval_metrics(spark.createDataFrame([], names)).first()
    assert empty.total_samples == 0 and empty.median_generation_time is None


def test_flag_summary_and_gate(spark):
    df = spark.createDataFrame([(True, 2)] * 7 + [(False, 4)] * 3, "ok boolean, n int")
    summary = ev.flag_summary(df, ["ok"], "n")
    row = summary.first()
    assert (row.total, row.ok_count, row.ok_pct, row.avg_response_length) == (10, 7, 70.0, 2.6)
    assert ev.quality_gate(summary, {"ok": 0.7}).first().success
    assert not ev.quality_gate(summary, {"ok": 0.8}).first().success


def test_accuracy_counts_missing_as_wrong(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 1.0), (2.0, 1.0), (3.0, 3.0)], "p double, g double")
    assert ev.accuracy(df, "p", "g").first().accuracy == 50.0


def test_best_checkpoint(spark):
    rows = [(2000, 0.5, 0.6), (2200, 0.4, 0.403), (2400, 0.3, 0.303), (2600, 0.2, None)]
    df = spark.createDataFrame(rows, "step int, a double, b double")
    best = ev.best_checkpoint(df.where("step <> 2400"), [], "step", "a", "b").first()
    assert best.best_step == 2200 and best.gap == pytest.approx(0.003)


def test_evaluation_keeps_gaps_in_sample_ids(spark, tmp_path):
    from chatprep.plans.evaluation import echo_factory
    from tests.test_chat import KIND, chat

    rows = [(0, chat("ua")), (1, chat("u")), (2, chat("aua")), (3, chat("sua"))]
    df = spark.createDataFrame(rows, f"id bigint, messages {KIND}")
    details, metrics = ev.evaluate_on_dataset(df, "id", echo_factory(), str(tmp_path / "d"))
    got = {r.sample_id: (r.generated_response, r.expected_response) for r in details.collect()}
    assert got == {1: ("u0", "a1"), 3: ("u1", "a2"), 4: ("u1", "a2")}
    assert metrics.first().total_samples == 3
    few_metrics = ev.evaluate_quick(df, "id", echo_factory(), str(tmp_path / "q"), max_samples=2)
    assert few_metrics.first().total_samples == 1


def test_generation_options_override_defaults(spark):
    from tests.test_chat import KIND, chat

    def factory(options):
        return lambda batch: [(f"{options['t']}/{options['k']}", 0.0, len(m)) for m in batch]

    df = spark.createDataFrame([(1, chat("us"))], f"id int, messages {KIND}")
    got = ev.batch_generate(df, factory, defaults={"t": 1, "k": 2}, t=9).first()
    assert (got.response, got.tokens_generated, got.tokens_per_second) == ("9/2", 2, 0.0)


def test_generator_is_called_once_per_batch(spark):
    from tests.test_chat import KIND, chat

    def factory(options):
        calls = []

        def generate(batch):
            calls.append(len(batch))
            return [(",".join(map(str, calls)), 0.0, 1)] * (len(batch) - options.get("missing", 0))

        return generate

    rows = [(i, chat("us")) for i in range(5)]
    df = spark.createDataFrame(rows, f"id int, messages {KIND}").coalesce(1)
    got = ev.batch_generate(df, factory, batch_size=2).orderBy("id").collect()
    assert [r.response for r in got] == ["2", "2", "2,2", "2,2", "2,2,1"]
    with pytest.raises(Exception, match="2 conversations got 1 results"):
        ev.batch_generate(df, factory, batch_size=2, missing=1).collect()


def test_samples_without_a_time_count(spark):
    names = "sample_id int, generation_time double, tokens_generated int, tokens_per_second double"
    rows = [(1, 0.5, 3, 6.0), (2, None, 4, 2.0)]
    got = ev.eval_metrics(spark.createDataFrame(rows, names)).first()
    assert got.total_samples == 2 and got.avg_generation_time == 0.5


def test_two_scores_of_one_method_are_an_error(spark):
    rows = [("m", "a", 1.0), ("m", "b", 2.0), ("m", "b", None)]
    df = spark.createDataFrame(rows, "model string, method string, score double")
    assert tuple(ev.ensemble_results(df, ["a", "b"]).first()) == ("m", 1.0, 2.0)
    with pytest.raises(Exception, match="several scores of m a"):
        ev.ensemble_results(df.union(df), ["a", "b"]).collect()


def test_conversation_metrics_on_request(spark):
    from chatprep.plans.evaluation import echo_factory
    from tests.test_chat import KIND, chat

    df = spark.createDataFrame([(1, chat("us"))], f"id int, messages {KIND}")
    got = ev.evaluate_conversations(df, "id", echo_factory(), metrics=["response_length"])
    assert "response_length" in got.columns and "coherence_score" not in got.columns
    assert "generation_time" in got.columns
    assert got.first().conversation_id == "1"


def test_patterns_are_the_ones_of_the_rule():
    assert re.findall(an.BOXED, "\\boxed{5}") == ["5"]


def test_merged_summaries(spark):
    """Summaries of shards give the counts and sums of all details, and medians within the error."""
    rng = random.Random(2)
    rows = [(i % 7, rng.expovariate(1), None if i % 5 else rng.gauss(0, 9), rng.randrange(4)) for i in range(20_000)]
    kind = "shard int, generation_time double, tokens_per_second double, tokens_generated int"
    details = spark.createDataFrame(rows, kind)
    parts = [ev.eval_summaries(details.where(f"shard = {s}"), ["shard"], 256) for s in range(7)]
    merged = ev.merge_summaries(functools.reduce(lambda a, b: a.unionByName(b), parts), size=256)
    got = {r.metric: r for r in merged.collect()}
    for at, metric in enumerate(ev.METRIC_COLUMNS):
        column = [r[kind.split(", ").index(f"{metric} {'int' if at == 2 else 'double'}")] for r in rows]
        values = sorted(float(v) for v in column if v is not None)
        r = got[metric]
        assert (r.n, r.lo, r.hi) == (len(values), values[0], values[-1])
        assert math.isclose(r.total, sum(values), rel_tol=1e-9, abs_tol=1e-6)
        below = sum(v < r.median for v in values) / r.n
        upto = sum(v <= r.median for v in values) / r.n
        assert below <= 0.5 + r.rank_error and upto >= 0.5 - r.rank_error and r.rank_error < 0.02
    ranks = {r.metric: r for r in ev.median_ranks(details, merged).collect()}
    assert all(r.below <= r.upto for r in ranks.values())
    assert ev.merge_summaries(ev.eval_summaries(details.where("false"))).count() == 0
