"""Constants that have to be the same for results to be the same.

Names of a particular organisation and its products are not constants here: the organisation is a
parameter of the question template, and its abbreviations are passed as a dictionary or a table.
"""

# --- fixed values: begin -----------------------------------------------------------------------

# Phrases that mark an answer as a refusal.
REFUSAL_PHRASES = [
    "わかりません",
    "コンテキストがありません",
    "知りません",
    "答えが明確でありません",
    "すみません",
    "答えがありません",
    "説明がありません",
    "リマインダー",
    "コンテキストが提供されていません",
    "有用な回答がありません",
    "指定されたコンテキスト",
    "有用でありません",
    "適切ではありません",
    "質問がありません",
    "明確でありません",
    "十分な情報がありません",
    "適切な情報がありません",
    "直接関係しているものが無いようです",
]

# Abbreviations in general use.
ABBREVIATIONS = {
    "ML": "Machine Learning",
    "HMS": "Hive Metastore",
    "UDF": "User Defined Function",
}

# Question prompt; note the full-width space before "### Instruction" and the two double spaces.
QUESTION_TEMPLATE = (
    "Below is an instruction with a question in it. Write a response that appropriately completes the request. "
    "　### Instruction: You are a competent assistant developed by {organisation} and are adept at answering "
    "questions based on the context specified, and context is a document. If the context does not provide enough "
    "information to determine an answer, say I don't know. If the context is not appropriate for the question, say "
    "I don't know. If the context does not provide a good answer, say you do not know. You do not repeat the same "
    "words. The following is a combination of a contextual document and a contextual question. Give an answer that "
    "adequately satisfies the question by summarizing the document. ### Context {context} ### Question: {question}"
    "  ### Response: "
)

# Instruction prompt.
PROMPT_INTRO = (
    "Below is an instruction that describes a task. "
    "Write a response that appropriately completes the request."
)
INSTRUCTION_MARK = "### Instruction:"
INPUT_MARK = "Input:"
RESPONSE_MARK = "### Response:"
SERVING_INDENT = 8

# Numbers.
DEMO_CHUNK_SIZE, DEMO_CHUNK_OVERLAP = 100, 10
CHUNK_SIZE, CHUNK_OVERLAP = 3500, 400
HITS_PER_QUESTION = 5
TRAIN_MAX_TOKENS = 512
TRAIN_TEST_ROWS = 1000
TRAIN_SEED = 68
DEADLINE_SECONDS, BACKOFF_SECONDS = 60, 2
DEFAULT_TEMPERATURE, DEFAULT_MAX_TOKENS = 1.0, 100
IGNORED_LABEL = -100

# Names.
END_OF_TEXT = "<|endoftext|>"
PRODUCTION_ALIAS = "Production"
MENTION_EVENT = "app_mention"

# --- fixed values: end -------------------------------------------------------------------------
