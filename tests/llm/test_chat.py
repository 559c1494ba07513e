"""Round trips of rendered conversations and the text under their loss masks."""

import random

import numpy as np

from tests.compare import difference, oracle_connection
from yieldstone.llm import chat
from yieldstone.llm.queries import ORACLE, QUERIES, TOKENIZER

FOLDER = "/root/testdata/sf0.001"


def test_query_matches_sql(spark):
    assert difference(QUERIES["op4_chat_formatting"](spark, FOLDER), oracle_connection(FOLDER), ORACLE["op4_chat_formatting"]) is None


def test_random_round_trips():
    rnd, tokenizer = random.Random(1), chat.load_tokenizer(TOKENIZER)
    bits = ["<", "|", ">", "\\", "[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "\n", " ", "é", "🙂", "<|end|>\n", "word ", "<|endoftext|>"]
    for _ in range(1500):
        turns = [(rnd.choice(["user", "assistant", "<|>\n", "a\\", ""]), "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12)))) for _ in range(rnd.randint(0, 5))]
        text, spans = chat.render(turns)
        assert chat.read_back(text) == turns
        bodies = "\0".join(text[a:b] for a, b, _ in spans)
        assert not any(c in bodies for c in chat.CONTROL)
        offsets = np.array(tokenizer.encode(text, add_special_tokens=False).offsets, np.int32).reshape(-1, 2)
        mask = chat.token_mask(offsets[:, 0], offsets[:, 1], [s[:2] for s in spans if s[2] == "assistant"])
        assert "".join(chat.masked_text(text, offsets[:, 0], offsets[:, 1], mask)) == "".join(t for r, t in turns if r == "assistant")


def test_edge_cases(spark):
    long = "tokens and more of them, " * 8000
    rows = [(1, 0, "user", None, 1), (1, 1, "assistant", "", 1), (2, 0, "user", "a", 1), (2, 0, "user", "a", 1), (2, 0, "assistant", "b", 1),
            (2, None, None, "first", 1), (None, 0, "assistant", "c", 1), (3, 0, "assistant", long, 1)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    out = chat.format_chats(frame, TOKENIZER)
    read = {r["conv_id"]: chat.read_back(r["formatted"]) for r in out.collect()}
    assert read[1] == [("user", ""), ("assistant", "")] and read[None] == [("assistant", "c")] and read[3] == [("assistant", long)]
    assert read[2] == [("", "first"), ("assistant", "b"), ("user", "a"), ("user", "a")]
    digests = {r["conv_id"]: r for r in chat.digest_chats(frame, TOKENIZER).collect()}
    assert (digests[1]["loss_chars"], digests[2]["loss_chars"], digests[3]["loss_chars"]) == (0, 1, len(long))
    assert {c: r["formatted_chars"] for c, r in digests.items()} == {r["conv_id"]: len(r["formatted"]) for r in out.collect()}
    assert chat.format_chats(frame.limit(0), TOKENIZER).count() == chat.digest_chats(frame.limit(0), TOKENIZER).count() == 0


def test_escape_breaks_every_control_string():
    """Against a plain search at every place."""
    rnd = random.Random(2)
    for _ in range(3000):
        text = "".join(rnd.choice(["<", "|", ">", "[", "]", "/", "s", "INST", "SYS", "x", "\\"]) for _ in range(rnd.randint(0, 14)))
        doubled = text.replace("\\", "\\\\")
        plain = "".join(ch + "\\" * any(doubled.startswith(c, i) for c in chat.CONTROL) for i, ch in enumerate(doubled))
        assert chat.escape(text) == plain and chat.unescape(plain) == text


def test_masks_of_whole_output_select_the_learned_texts(spark):
    """The formatted rows themselves, read back outside the operator."""
    rows = [(c, t, ("user", "assistant")[t % 2], f"turn {t} of {c} " * (c % 7)) for c in range(40) for t in range(c % 5)]
    out = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3), TOKENIZER)
    for r in out.collect():
        starts, ends, mask = (np.array(r[k]) for k in ("token_starts", "token_ends", "loss_mask"))
        wanted = [(role, text) for c, _, role, text in rows if c == r["conv_id"]]
        assert chat.read_back(r["formatted"]) == wanted
        assert "".join(chat.masked_text(r["formatted"], starts, ends, mask)) == "".join(t for role, t in wanted if role == "assistant")
