import pytest
from pyspark.sql import functions as F

from chatprep.functions import chat as ch
from chatprep.schema import MESSAGES

KIND = MESSAGES.simpleString()


def chat(roles):
    """'usa' -> user, system, assistant; contents are numbered."""
    names = {"u": "user", "s": "system", "a": "assistant", "n": None}
    return [{"role": names[r], "content": f"{r}{i}"} for i, r in enumerate(roles)]


def plain(messages):
    return [(m.role, m.content) for m in messages]


def ours(messages):
    return [(m["role"], m["content"]) for m in messages]


def test_ensure_and_prepend_system(over):
    values = [chat("su"), chat("us"), [], None, chat("nu")]
    got = over(values, KIND, ch.ensure_system)
    head = [("system", ch.DEFAULT_SYSTEM_PROMPT)]
    assert [plain(g) for g in got] == [
        ours(chat("su")),
        head + ours(chat("us")),
        head,
        head,
        head + ours(chat("nu")),
    ]
    got = over(values, KIND, lambda m: ch.prepend_system(m, "P"))
    assert [plain(g) for g in got] == [[("system", "P")] + ours(v or []) for v in values]


def test_build_chat(over):
    values = [[], None, chat("su")]
    got = over(values, KIND, lambda m: ch.build_chat(F.lit("hi"), m, "P"))
    fresh = [("system", "P"), ("user", "hi")]
    assert [plain(g) for g in got] == [fresh, fresh, ours(chat("su")) + [("user", "hi")]]


def test_append_turn(over):
    got = over([chat("u"), None], KIND, lambda m: ch.append_turn(m, "assistant", F.lit("ok")))
    assert [plain(g) for g in got] == [[("user", "u0"), ("assistant", "ok")], [("assistant", "ok")]]


def test_render(over):
    got = over([chat("su"), []], KIND, ch.render_chat)
    assert got == ["<|im_start|>system\ns0<|im_end|>\n<|im_start|>user\nu1<|im_end|>\n", ""]
    assert over([[]], KIND, ch.render_prompt) == ["<|im_start|>assistant\n"]
    short = ch.Template("[", "] ", "\n")
    assert over([chat("u")], KIND, lambda m: ch.render_chat(m, short)) == ["[user] u0\n"]


def eval_pair(messages):
    """By position: the prompt is the slice between the first other turn and the next answer."""
    answers = [i for i, m in enumerate(messages) if m["role"] == "assistant"]
    others = [i for i in range(len(messages)) if i not in answers]
    if not others:
        return [], ""
    following = [i for i in answers if i > others[0]]
    end = following[0] if following else len(messages)
    expected = messages[end]["content"] if following else ""
    return ours(messages[others[0] : end]), expected


def test_eval_pair(over):
    import itertools

    values = [chat(r) for n in range(5) for r in itertools.product("usan", repeat=n)]
    got = over(values, KIND, ch.eval_pair)
    for value, pair in zip(values, got):
        prompt, expected = eval_pair(value)
        assert pair.expected_response == expected
        assert plain(pair.prompt_messages) == prompt


def test_conversation_prompt(over):
    twice = [{"role": "assistant", "content": "x"}] * 2
    values = [chat("ausa"), twice + chat("u"), chat("nau"), []]
    got = [plain(g) for g in over(values, KIND, ch.conversation_prompt)]
    for value, prompt in zip(values, got):
        assert prompt == [
            (m["role"], m["content"]) for m in value if m["role"] != "assistant" or m == value[0]
        ]


def test_conversation_id(over):
    got = over([{"id": "a"}, {"x": "b"}, None], "map<string,string>",
               lambda m: ch.conversation_id(m, F.lit(7)))
    assert got == ["a", "7", "7"]


RECORD = "struct<instruction:string,input:string,output:string>"


def test_alpaca_rules(over):
    values = [(" hi ", "", "o"), ("a", "b", "o"), ("a ", None, None), (None, " c ", "o")]

    def user(rule):
        return lambda x: F.get(rule(x["instruction"], x["input"], x["output"]), F.lit(1))["content"]

    assert over(values, RECORD, user(ch.alpaca_to_chat)) == [" hi ", "a\nb", "a ", "c"]
    assert over(values[:3], RECORD, user(ch.alpaca_format_strict)) == ["hi", "a\nb", "a \nNone"]


def test_qa_cells(over):
    values = [(" q ", None, "")]
    got = over(values, RECORD, lambda x: ch.qa_to_chat(x["instruction"], x["input"]))
    assert [c for _, c in plain(got[0])] == [ch.DEFAULT_SYSTEM_PROMPT, "q", "nan"]


def test_word_problems(over):
    values = [("Q", "two #### 3 #### 4 ", ""), ("Q", "no mark", "")]
    got = over(values, RECORD, lambda x: ch.gsm8k_to_chat(x["instruction"], x["input"]))
    assert got[0][2].content == "two\n\nTherefore, the final answer is \\boxed{4}."
    assert got[1][2].content == "no mark\n\nTherefore, the final answer is \\boxed{no mark}."
    assert got[0][1].content == (
        "Solve this math word problem step by step.\n\nProblem: Q\n\nShow your work clearly and put "
        "your final numerical answer in \\boxed{}."
    )
    assert over(["Q"], "string", ch.gsm8k_adapter_prompt) == [
        "Solve this step by step:\n\nQ\n\nPut your final answer in \\boxed{}."
    ]


def test_presets_and_formats(spark, over):
    text = over([chat("u")], KIND, lambda m: ch.format_preset(m, "customer_service", "Initech"))
    assert "support agent for Initech." in text[0]
    with pytest.raises(ValueError):
        ch.preset_prompt("poet")
    with pytest.raises(ValueError, match="no rule for format"):
        ch.preprocess({}, "csv")
    no_input = {"instruction": F.lit("i"), "output": F.lit("o")}
    text = over([1], "int", lambda _: ch.preprocess(no_input, "alpaca", "P"))
    assert text == [
        "<|im_start|>system\nP<|im_end|>\n<|im_start|>user\ni<|im_end|>\n"
        "<|im_start|>assistant\no<|im_end|>\n"
    ]
