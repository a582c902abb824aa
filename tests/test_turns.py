import pytest

from chatprep.operators import turns as tn
from tests.test_chat import chat, eval_pair

CONVERSATIONS = ["ua", "us", "aua", "saua", "a", "aau", "uaua", "nua", "suuuuuua", "aaaaaua"]
KIND = "conv_id int, turn bigint, role string, content string"


@pytest.fixture(params=[2, 1 << 16])
def turns(request, spark, monkeypatch):
    """Also with ranges of two turns, so that conversations span several."""
    monkeypatch.setattr(tn, "TURNS_PER_RANGE", request.param)
    rows = [
        (c, t, m["role"], m["content"])
        for c, roles in enumerate(CONVERSATIONS)
        for t, m in enumerate(chat(roles))
    ]
    rows += [(99, 0, "assistant", "hi"), (99, 1, "user", "x"), (99, 9, "assistant", "hi"),
             (98, 0, "user", "q"), (98, 1, "assistant", "")]
    return spark.createDataFrame(rows, KIND)


def table(df):
    return sorted(tuple(r) for r in df.collect())


def test_pairs_as_for_arrays(turns):
    pairs = tn.eval_pairs(turns)
    prompts = {}
    for r in sorted(tn.prompt_turns(turns, pairs).collect()):
        prompts.setdefault(r.conv_id, []).append((r.role, r.content))
    got = {r.conv_id: (prompts[r.conv_id], r.expected_response) for r in pairs.collect()}
    expected = {c: eval_pair(chat(roles)) for c, roles in enumerate(CONVERSATIONS)}
    expected[99] = ([("user", "x")], "hi")
    assert got == {c: p for c, p in expected.items() if p[1]}


def test_conversation_prompt(turns):
    got = [(r[0], r[1]) for r in table(tn.conversation_prompt(turns))]
    expected = [
        (c, t)
        for c, roles in enumerate(CONVERSATIONS)
        for t, m in enumerate(chat(roles))
        if m["role"] != "assistant" or m == chat(roles)[0]
    ]
    assert got == sorted(expected + [(99, 0), (99, 1), (99, 9), (98, 0)])


def test_system_turns(turns):
    before = turns.count()
    lacking = sum(r[0] != "s" for r in CONVERSATIONS) + 2
    assert tn.ensure_system(turns, "P").count() == before + lacking
    assert tn.prepend_system(turns, "P").count() == before + len(CONVERSATIONS) + 2
    added = tn.ensure_system(turns, "P").where("turn = -1").first()
    assert (added.role, added.content) == ("system", "P")


def test_append_and_render(spark, turns):
    contents = spark.createDataFrame([(0, "bye")], "conv_id int, content string")
    longer = tn.append_turn(turns, "user", contents)
    assert longer.count() == turns.count() + 1
    text = tn.render_turns(longer.where("conv_id = 0")).orderBy("turn").collect()
    assert text[-1].turn == 2
    assert text[-1].text == "<|im_start|>user\nbye<|im_end|>\n"
