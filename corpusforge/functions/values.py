"""Fixed values shared by the functions, the operators and the SQL checks.

Everything under "Fixed values" is part of the published definition of a score
or a format and must not change; the rest of the module derives character
tables from a rule.
"""

from __future__ import annotations

# --- Fixed values -----------------------------------------------------------
# Patterns that define what counts as code, reasoning and a boxed answer.
FENCED_CODE = r"(?s)```.*?```"
INLINE_CODE = r"`[^`]*`"
LATEX = r"(?s)\$[^$]*\$|\\\[.*?\\\]|\\\(.*?\\\)"
THINK = r"(?s)<think>(.*?)</think>"
# One level of inner braces. Possessive, so that Java never recurses per brace.
BOXED = r"\\boxed\{([^{}]*+(?:\{[^{}]*+\}[^{}]*+)*+)\}"

# Role names of the from/value chat layout.
USER_ROLES = ("human", "user")
ASSISTANT_ROLES = ("gpt", "assistant", "chatgpt")
SYSTEM_ROLES = ("system",)

# Characters that end a line, beyond "\n".
LINE_BREAKS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"

# Stripped from the end of an answer together with whitespace.
ANSWER_TAIL = ",、。，．."

# Chat template markers.
TURN_START = "<start_of_turn>"
TURN_END = "<end_of_turn>\n"
MODEL_ROLE = "model"

# Instruction that closes a multiple-choice prompt, and the system prompts.
MCQ_INSTRUCTION = "請選出正確選項的英文字母。"
PROMPT_SYSTEM = (
    "你是一位以臺灣正體中文回答的助理。請先在 <think> 與 </think> 之間逐步推理，"
    "接著給出最終答案，並將最終答案放入 \\boxed{} 之中。全程只使用繁體中文。"
)

# Column sets that identify a row shape: name, columns, consumer, note. A table
# may match several; they are reported in this order.
SHAPES = (
    ("multiple-choice benchmark", ("question", "A", "B", "C", "D", "answer"),
     "evaluation, or GRPO with a letter-accuracy reward", "columns question/A/B/C/D/answer"),
    ("preference (explicit prompt)", ("prompt", "chosen", "rejected"),
     "DPOTrainer, RewardTrainer", ""),
    ("preference (implicit prompt)", ("chosen", "rejected"), "RewardTrainer, DPOTrainer", ""),
    ("unpaired preference", ("prompt", "completion", "label"), "KTOTrainer", ""),
    ("prompt-completion", ("prompt", "completion"), "SFTTrainer",
     "loss on completion only by default"),
    ("conversational language modeling", ("messages",), "SFTTrainer", "chat template is applied"),
    ("ShareGPT conversational", ("conversations",), "SFTTrainer",
     "NEEDS CONVERSION: from/value -> role/content, rename to `messages`"),
    ("Alpaca-style", ("instruction", "output"), "SFTTrainer",
     "NEEDS CONVERSION: map to `prompt`/`completion` or `messages`"),
    ("QA pair", ("question", "answer"), "SFTTrainer / GRPOTrainer",
     "map to prompt/completion for SFT, or prompt+ground_truth for GRPO"),
    ("language modeling", ("text",), "SFTTrainer (packing=True)", "raw text -> use for CPT"),
    ("prompt-only", ("prompt",), "GRPOTrainer, RLOOTrainer", "reward functions supply the signal"),
)
NO_SHAPE = ("unknown", "-", "no known signature matched; map columns manually")

# Columns that hold a conversation, and columns that may hold it as a string.
CONVERSATION_COLUMNS = ("messages", "conversations")
JSON_CANDIDATES = ("messages", "conversations", "chosen", "rejected", "tools")
TEXT_COLUMNS = ("text", "completion", "output", "solution", "answer", "content")

# Row caps of a trial run, and the default target length of `length_target`.
TRIAL_TRAIN_ROWS = 64
TRIAL_EVAL_ROWS = 32
TRIAL_PROMPT_ROWS = 32
TARGET_LENGTH = 600
# A completion set counts as fully cut off from this ratio on.
CLIPPED_AT = 0.999
GUARD_PATIENCE = 3
# --- end of fixed values ----------------------------------------------------

MESSAGES_TYPE = "array<struct<role:string,content:string>>"
SHAREGPT_TYPE = "array<struct<from:string,value:string>>"

CJK_RANGE = "一-鿿"
NOT_CJK = f"[^{CJK_RANGE}]++"
WORD_CHARS = r"\p{L}\p{N}_"

# Every character Python's str.strip() and str.split() treat as whitespace.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
# The same set as a Java class: a property test is several times faster than
# trying 29 characters.
SPACE = r"(?U)[\s\x1c-\x1f]"


def _encodable(char: str, charset: str) -> bool:
    try:
        char.encode(charset)
    except UnicodeEncodeError:
        return False
    return True


def simplified_characters() -> str:
    """Characters of the mainland character set that Taiwan's has not.

    Derived from the two national charsets (GB2312 against Big5). 发 is taken
    out because it proves nothing about the script of a text.
    """
    block = (chr(c) for c in range(0x4E00, 0xA000))
    return "".join(c for c in block
                   if c != "发" and _encodable(c, "gb2312") and not _encodable(c, "big5"))


SIMPLIFIED = simplified_characters()
