import re

import pytest
from pyspark.sql import functions as F

from lorespan import fixed_values as fixed
from lorespan.functions import text as txt


def one(spark, expression, **values):
    schema = ", ".join(f"{name} string" for name in values) or "x string"
    frame = spark.createDataFrame([tuple(values.values()) or ("",)], schema)
    return frame.select(expression.alias("out")).first()["out"]


def expand(spark, text, table=None):
    return one(spark, txt.expand_abbreviations(F.col("t"), table), t=text)


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("what is ML?", "what is ML (Machine Learning)?"),
        ("ml Ml mL", "ML (Machine Learning) ML (Machine Learning) ML (Machine Learning)"),
        ("HTML MLx xML ML_1", "HTML MLx xML ML_1"),
        ("MLの使い方", "MLの使い方"),
        ("(ML)、UDF", "(ML (Machine Learning))、UDF (User Defined Function)"),
        ("éML MLé ML", "éML MLé ML (Machine Learning)"),
        ("", ""),
        ("line\nml\n", "line\nML (Machine Learning)\n"),
    ],
)
def test_abbreviations(spark, text, wanted):
    assert expand(spark, text) == wanted


def test_abbreviations_follow_dictionary_order(spark):
    table = {"AB": "alpha CD", "CD": "charlie", "EF": "AB too"}
    text = "ab cd ef"
    wanted = text
    for key, full in table.items():
        wanted = re.sub(rf"\b{key}\b", f"{key} ({full})", wanted, flags=re.IGNORECASE)
    assert expand(spark, text, table) == wanted


def test_abbreviations_refuse_what_is_not_a_word():
    with pytest.raises(ValueError):
        txt.expansion_table({"C++": "a language"})
    with pytest.raises(ValueError):
        txt.expansion_table({"ML": "a", "ml": "b"})


def test_null_text_stays_null(spark):
    assert expand(spark, None) is None


@pytest.mark.parametrize("phrase", fixed.REFUSAL_PHRASES)
def test_every_refusal_phrase_rejects(spark, phrase):
    assert one(spark, txt.is_good_answer(F.col("a")), a=f"前 {phrase} 後") is False


@pytest.mark.parametrize("answer, good", [(None, False), ("", True), ("I don't know", True), ("レイクハウスです", True)])
def test_good_answers(spark, answer, good):
    assert one(spark, txt.is_good_answer(F.col("a")), a=answer) is good


def test_phrases_are_a_parameter(spark):
    assert one(spark, txt.is_good_answer(F.col("a"), ["i don't know"]), a="Sorry, I Don't Know.") is False
    assert len(fixed.REFUSAL_PHRASES) == 18


@pytest.mark.parametrize("count", [0, 1, 2, 3, 999])
def test_any_number_of_phrases(spark, count):
    phrases = [f"phrase {i}." for i in range(count)]
    assert one(spark, txt.is_good_answer(F.col("a"), phrases), a="nothing") is True
    for i in {0, count // 2, count - 1} & set(range(count)):
        assert one(spark, txt.is_good_answer(F.col("a"), phrases), a=f"A Phrase {i}.") is False


def test_question_prompt_keeps_values_as_they_are(spark):
    context, question = r"see {question} and $1 \1 {context}", "why?"
    prompt = one(spark, txt.question_prompt(F.col("c"), F.col("q"), "Example Org"), c=context, q=question)
    head, tail = prompt.split(" ### Context ")
    assert tail == rf"see {{question}} and $1 \1 {{context}} ### Question: why?  ### Response: "
    assert "request. 　### Instruction: You are a competent assistant developed by Example Org and" in head


def test_template_needs_every_slot():
    with pytest.raises(ValueError):
        txt.render_template("{a} {b}", a=None)


INTRO = (
    "Below is an instruction that describes a task. Write a response that appropriately completes the request."
)


@pytest.mark.parametrize("context", [None, ""])
def test_instruction_prompt_without_input(spark, context):
    made = one(spark, txt.instruction_prompt(F.col("i"), F.col("c")), i="do it", c=context)
    assert made == INTRO + "\n\n### Instruction:\ndo it\n\n### Response:"


def test_instruction_prompt_with_input(spark):
    made = one(spark, txt.instruction_prompt(F.col("i"), F.col("c")), i="do it", c="facts")
    assert made == INTRO + "\n\n### Instruction:\ndo it\n\nInput:\nfacts\n\n### Response:"


def test_training_text_is_not_escaped(spark):
    made = one(spark, txt.training_text(F.col("p"), F.col("r")), p="it's", r='"x"')
    assert made == "{ 'prompt': it's, 'response': \"x\" }"


def test_serving_prompt(spark):
    gap = "\n        "
    made = one(spark, txt.serving_prompt(F.col("i")), i="do it")
    assert made == INTRO + gap + "### Instruction:" + gap + "do it" + gap + "### Response:" + gap


@pytest.mark.parametrize("answer, source, wanted", [("yes", "s", "yes.  \n Source: s"), (None, None, "None.  \n Source: None")])
def test_reply(spark, answer, source, wanted):
    assert one(spark, txt.reply_message(F.col("a"), F.col("s")), a=answer, s=source) == wanted


def test_names(spark):
    assert one(spark, txt.qualified_name(F.lit("c"), F.lit("s"), F.lit("n"))) == "c.s.n"
    assert one(spark, txt.version_uri(F.lit("c.s.n"), F.lit("Production"))) == "models:/c.s.n@Production"
