"""Chat formatting with loss masks aligned by offsets.

A conversation is rendered whole, encoded once with the character span of every token, and the spans of its assistant
texts are intersected with the token spans by binary search. Marks of the template are separate pieces for the
tokenizer, so no token reaches over the edge of a text.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal, sized_slices

#: Control strings of common templates. Inside texts and roles a backslash goes after their first character.
CONTROL = ["<|", "|>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>"]
END = "<|end|>\n"

#: The first character of a control string; a class of characters in front lets the search skip all others.
_FIRST = re.escape("".join(sorted({c[0] for c in CONTROL})))
_REST = "|".join(f"(?<={re.escape(c[0])}){re.escape(c[1:])}" for c in CONTROL)
_CONTROL = re.compile(f"([{_FIRST}])(?={_REST})")
_MARK = re.compile(r"<\|(.*?)\|>\n", re.DOTALL)


def escape(text: str) -> str:
    """Looks ahead, so that control strings that overlap are all broken up."""
    return _CONTROL.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def render(turns: Iterable[tuple[str, str]]) -> tuple[str, list[tuple[int, int, str]]]:
    """The whole conversation, and start, end and role of each text in it."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"<|{escape(role)}|>\n", escape(text)
        spans.append((at + len(head), at + len(head) + len(body), role))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation."""
    turns, at = [], 0
    while at < len(formatted):
        head = _MARK.match(formatted, at)
        end = formatted.index(END, head.end())
        turns.append((unescape(head.group(1)), unescape(formatted[head.end() : end])))
        at = end + len(END)
    return turns


def token_mask(starts: np.ndarray, ends: np.ndarray, spans: Iterable[tuple[int, int]]) -> np.ndarray:
    """1 for tokens that overlap a span; spans and tokens are sorted."""
    mask = np.zeros(len(starts), np.int8)
    for low, high in spans:
        if low < high:
            mask[np.searchsorted(ends, low, "right") : np.searchsorted(starts, high, "left")] = 1
    return mask


def masked_text(formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> list[str]:
    """The texts under the mask, unescaped, one for each run of masked tokens."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]])))
    return [unescape(formatted[starts[a] : ends[b - 1]]) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def load_tokenizer(path: str):
    """A byte-level tokenizer that keeps the template's marks apart and spans that cover every character."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Regex, Tokenizer, pre_tokenizers, processors

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    marks = pre_tokenizers.Split(Regex(r"<\|[\s\S]*?\|>\n"), "isolated")
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([marks, tokenizer.pre_tokenizer])
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    return tokenizer


def conversations_of(turns: DataFrame) -> DataFrame:
    """One row for each conv_id with its turns in order; ties by role and text, nulls first."""
    row = F.struct(F.col("turn"), F.col("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("turns"))


class Formatted(NamedTuple):
    """A rendered conversation, its tokens with their spans, and the mask of those that are learned from."""

    text: str
    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    mask: np.ndarray


def formatted(tokenizer, conversations: list[list[dict]], learned_role: str) -> Iterator[Formatted]:
    rendered = [render((turn["role"] or "", turn["text"]) for turn in turns) for turns in conversations]
    encoded = tokenizer.encode_batch([text for text, _ in rendered], add_special_tokens=False)
    for (text, spans), tokens in zip(rendered, encoded, strict=True):
        offsets = np.fromiter(chain.from_iterable(tokens.offsets), np.int32).reshape(-1, 2)
        starts, ends = offsets[:, 0], offsets[:, 1]
        learned = [(low, high) for low, high, role in spans if role == learned_role]
        yield Formatted(text, np.array(tokens.ids, np.int32), starts, ends, token_mask(starts, ends, learned))


def _over_conversations(
    turns: DataFrame, tokenizer_path: str, learned_role: str, columns: Callable[[list[Formatted]], list[pa.Array]], shape: str
) -> DataFrame:
    """conv_id and what ``columns`` makes of the conversations of a slice, in the order of ``shape``."""
    names = ["conv_id", *[part.split()[0] for part in shape.split(", ")]]

    def sizes(lists: pa.ListArray) -> np.ndarray:
        lengths = pc.binary_length(lists.values.field("text")).to_numpy(zero_copy_only=False)
        return np.diff(np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])[lists.offsets.to_numpy()])

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = None
        for batch in batches:
            tokenizer = tokenizer or load_tokenizer(tokenizer_path)
            for part in sized_slices(batch, sizes(batch["turns"])):
                done = columns(list(formatted(tokenizer, part["turns"].to_pylist(), learned_role)))
                yield pa.RecordBatch.from_arrays([part["conv_id"], *done], names)

    return conversations_of(turns).mapInArrow(run, f"conv_id {dict(turns.dtypes)['conv_id']}, {shape}")


def format_chats(turns: DataFrame, tokenizer_path: str, learned_role: str = "assistant") -> DataFrame:
    """conv_id, ``formatted``, ``token_ids``, ``token_starts``, ``token_ends`` and ``loss_mask`` of every conversation.

    ``turns`` has conv_id, turn, role and text; other columns aren't read. A null text or role is empty, rows with a
    null conv_id are one conversation, repeated rows and equal turns all stay (ordered by role and text), an
    empty text has no token under the mask, no rows give no rows. A conversation is one sample and held whole by
    one task, however long; conversations are spread over tasks by their id.
    """

    def columns(chats: list[Formatted]) -> list[pa.Array]:
        ints = [pa.array([getattr(c, name) for c in chats], pa.list_(pa.int32())) for name in ("ids", "starts", "ends")]
        return [pa.array([c.text for c in chats], pa.string()), *ints, pa.array([c.mask for c in chats], pa.list_(pa.int8()))]

    shape = "formatted string, token_ids array<int>, token_starts array<int>, token_ends array<int>, loss_mask array<tinyint>"
    return _over_conversations(turns, tokenizer_path, learned_role, columns, shape)


def digest_chats(turns: DataFrame, tokenizer_path: str, learned_role: str = "assistant") -> DataFrame:
    """What the output of ``format_chats`` says when it is read back: turns, and the text under the loss mask.

    Rows are those of ``format_chats``, cases as there. Each conversation is read back by the task that formats it, so tokens and
    masks stay there.
    """

    def digest(chat: Formatted) -> tuple[int, str, int, str, int]:
        said = read_back(chat.text)
        loss = "".join(masked_text(chat.text, chat.starts, chat.ends, chat.mask))
        whole = "".join(f"{role}\n{text}\n" for role, text in said)
        return len(said), sha256(whole.encode()).hexdigest(), len(loss), sha256(loss.encode()).hexdigest(), len(chat.text)

    def columns(chats: list[Formatted]) -> list[pa.Array]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return [pa.array(list(values), kind) for values, kind in zip(zip(*map(digest, chats), strict=True), kinds, strict=True)]

    shape = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return _over_conversations(turns, tokenizer_path, learned_role, columns, shape)
