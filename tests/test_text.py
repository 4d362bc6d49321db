import random

import pytest
from pyspark.sql import functions as F

from tunetables.config import Extraction, MatchOptions, active_weights, extraction_from, float_suffix, options_from
from tunetables.functions import text as T
from tunetables.operators import rewards as R


def values(spark, fn, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, c string").select("i", fn(F.col("c")).alias("v"))
    return [r.v for r in sorted(rows.collect())]


def check(spark, fn, table):
    got = values(spark, fn, [a for a, _ in table])
    assert got == [b for _, b in table]


def test_extract_answer(spark):
    check(
        spark,
        T.extract_answer,
        [
            ("### Start\n 7 \n### End tail", "7"),
            ("a <SOLUTION> x </solution> <answer>y</answer>", "x"),
            ("<answer></answer>rest", ""),  # an empty hit is a hit
            ("<solution>open <answer>in</answer>", "in"),  # closed beats unclosed
            ("### Start\nopen", "open"),
            ("x <answer> open", "open"),
            ("t</think>  42\n", "42"),
            ("t</think> 4<5", "4"),  # unquoted eos marker cuts at '<'
            ("  plain ", "  plain "),
            (None, ""),
        ],
    )
    quoted = Extraction(escape_tags=True)
    check(spark, lambda c: T.extract_answer(c, quoted), [("t</think> 4<5<|im_end|>z", "4<5")])
    tags = Extraction(is_answer_tag=True)
    check(spark, lambda c: T.extract_answer(c, tags), [("a<answer> b\nc </ANSWER>", "b\nc"), ("none", "")])


def test_keywords_and_wrappers(spark):
    check(spark, T.split_on_keywords, [("The answer is: A, Answer:  B ", "B"), ("answer is C", "C"), ("none", "none"), ("answer 5", "answer 5")])
    check(
        spark,
        T.strip_wrappers,
        [
            ("$\\boxed{\\text{\\boxed{9}}} x", "9 x"),
            ("((a))", "a"),
            ("\\(x\\)  +\n y", "x\\ + y".replace("\\", "")),
            ("$$5$$", "5"),
            (": = z <", "z"),
            ("p \\boxed{1} \\boxed{2} \\text{3} q", "p 1 2 3 q"),
            (None, ""),
        ],
    )
    check(spark, T.normalise_text, [(" A.b,  C!? ", "a b c"), ("\"x'", "x")])


def test_choice_and_number(spark):
    check(spark, T.extract_choice, [("(b).", "B"), ("take D now", "D"), ("cab", ""), ("", ""), ("éa", "")])
    check(spark, T.extract_number, [("x -007", "-7"), ("000", "0"), ("3.140", "3.140"), ("no", ""), ("1,2", "1")])


def test_other(spark):
    check(spark, lambda c: T.has_category_token(c, "kv"), [("Single_KV", True), ("kvx", False), (None, False)])
    check(spark, T.extract_python_block, [("a```python\nprint(1)\n```b", "print(1)"), ("```\nx\n```", "")])
    check(spark, T.contains_hangul, [("한", True), ("ㄱ", True), ("abc", False)])
    check(spark, T.strip, [("\x1c a b \n", "a b")])
    g4 = "<|turn>model\n<|channel>thought x<channel|>y<|channel>z"
    check(spark, T.normalise_gemma4, [(g4, "y<|channel>z"), ("a<turn|>b<eos>", "a"), ("<|channel>final  t", "t")])
    check(spark, lambda c: T.query_instruction("find", c), [("q", "Instruct: find\nQuery:q")])


def test_names():
    assert MatchOptions(0.5).name == "match_reward_neg0p5"
    assert MatchOptions().name == "match_reward"
    assert float_suffix(1.0) == "1"


def test_options_from_a_mapping():
    config = {
        "is_answer_tag": True, "eos_token": "</s>", "match": {"incorrect_penalty": 0.5}, "code_execution": {"timeout": 2, "wrong_output_penalty": 0.1},
        "retrieval": {"dim": 8, "hit": {"top_k": 20, "stages": [{"k": 10, "bonus": 0.1, "drop": 0.1}]}, "ndcg": {"top_ks": [1, 3], "weighting_mode": "small_k"}},
        "kv": {"allowed_sibling_keys": ["grounding"], "coarse_match_cap": 0.4}, "grounding_bbox": {"iou_05_threshold": 0.4},
        "weight": {"match": 2.0, "kv": 0.0, "rouge": None},
    }
    assert extraction_from(config) == Extraction(is_answer_tag=True, eos_token="</s>")
    assert options_from(config, "match").name == "match_reward_neg0p5"
    assert options_from(config, "code_execution").wrong_output_penalty == 0.1
    assert options_from(config, "retrieval_hit").stages[0].k == 10
    assert options_from(config, "retrieval_ndcg").depth == 3
    assert options_from(config, "kv").coarse_match_cap == 0.4
    assert options_from(config, "grounding_bbox").iou_05_threshold == 0.4
    assert options_from({}, "grounding_selection").extra_target_reward_cap == 1.0
    assert active_weights(config) == {"match": 2.0}


def test_completion_text(spark):
    df = spark.createDataFrame([([("assistant", "hi"), ("user", "x")],)], "c array<struct<role:string,content:string>>")
    assert df.select(T.completion_text(F.col("c"), True)).first()[0] == "hi"
    with pytest.raises(Exception, match="no message"):
        df.select(T.completion_text(F.filter("c", lambda m: F.lit(False)), True)).collect()


def test_match(spark):
    rows = [
        ("math", "5", "answer: 5", 1.0),
        ("math", "5", "answer: \\boxed{05}", 1.0),
        ("choice", "B", "I pick (b)", 1.0),
        ("math", "Yes.", "yes", 1.0),
        ("math", "5", "6", -0.5),
        ("rouge", "5", "5", None),
        ("math", "", "5", None),
        ("math", None, "5", None),
    ]
    df = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(rows)], "i int, category string, solution string, completion string")
    got = {r.i: r.match_reward for r in R.score_match(df, MatchOptions(0.5)).collect()}
    assert [got[i] for i in range(len(rows))] == [r[3] for r in rows]
    zero = R.score_match(df, MatchOptions()).where("i = 4").first().match_reward
    assert str(zero) == "0.0"


def test_format(spark):
    table = [("<think>a</think>", 1.0), ("<think>a<think>b", 0.0), ("<think>a</think><think>", 0.0), ("a<think>\n</think>", 1.0), (None, 0.0)]
    check(spark, R.think_format, table)
    check(spark, lambda c: R.think_format(c, enabled=False), [("<think></think>", None)])


def test_active_rewards(spark):
    df = spark.createDataFrame([(1, "math", "5", "5")], "k int, category string, solution string, completion string")
    rewards = [R.build_reward("match", 2.0), R.build_reward("rouge", 0.0), R.column_reward("mine", 1.0, lambda df: F.lit(0.5))]
    out = R.score_all(df, rewards)
    assert out.columns[-2:] == ["match_reward", "mine"]
    assert tuple(out.first())[-2:] == (2.0, 0.5)
    scores = spark.createDataFrame([(1, 0.25)], "k int, s double")
    joined = R.score_all(df, [R.joined_reward("hit@3[5]", 4.0, scores, "k", "s")])
    assert joined.first()["hit@3[5]"] == 1.0
    with pytest.raises(ValueError):
        R.build_reward("nothing", 1.0)
    with pytest.raises(ValueError):
        R.register_reward("match", None)


def test_texts_without_delimiters_are_told_by_one_search(spark):
    """Where the search finds nothing, extraction changes nothing."""
    rng = random.Random(9)
    pieces = ["<solution>", "</SOLUTION>", "<Answer>", "</answer>", "<an\u017fwer>", "</think>", "</THINK>", "</Th\u0130nk>", "<t.g>", "<txg>", "### Start\n", "### End", "##", "<", "<stop>", " ",
              "\u3000", "\n", "x", "the ANSWER is: ", "an\u017fwer:", "answers", "{}", "<|im_end|>", "think"]
    rows = [("".join(rng.choice(pieces) for _ in range(rng.randint(0, 6))),) for _ in range(3000)]
    df = spark.createDataFrame(rows, "c string")
    c, met = F.col("c"), 0
    for ext in (Extraction(), Extraction(think_end_token="<t.g>"), Extraction(think_end_token="<t.g>", escape_tags=True), Extraction(think_end_token="think"), Extraction(is_answer_tag=True)):
        told, full = T.may_hold_answer(c, ext), T.extract_answer(c, ext)
        for r in df.select("c", told.alias("told"), full.alias("full")).collect():
            assert r.told or r.full == r.c, (r, ext)
            met += not r.told
    assert met > 1000
    found = df.select(T.may_hold_keywords(c).alias("told"), T.split_on_keywords(c).alias("full"), T.strip(c).alias("plain")).collect()
    assert all(r.told or r.full == r.plain for r in found) and not all(r.told for r in found)
