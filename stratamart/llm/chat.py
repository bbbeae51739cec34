"""Chat formatting with a loss mask that is aligned by offsets.

A conversation is rendered turn by turn, encoded once with character offsets, and the spans of the
turns are intersected with the token spans by binary search. The template's marks are tokens of
their own, which the tokenizer splits off before anything else; a conversation may therefore be
rendered and encoded in segments of whole turns with the same result, and the longest conversation is
never held in one piece.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# Strings that control this template, the tokenizer, or common other templates.
CONTROLS = [
    "<|turn|>",
    "<|text|>",
    "<|end|>",
    "<|endoftext|>",
    "<|im_start|>",
    "<|im_end|>",
    "<s>",
    "</s>",
    "[INST]",
    "[/INST]",
    "<<SYS>>",
    "<</SYS>>",
]
ASSISTANT = "assistant"
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
# Turn numbers of one segment, and characters after which a segment is closed early.
SEGMENT_TURNS = 64
SEGMENT_CHARS = 1 << 20
TOKENIZER_BYTES = 16 << 20

TAILS = "|".join(re.escape(c[1:]) for c in CONTROLS)
PLAIN = re.compile(rf"([<\[])(\\*)({TAILS})")
ESCAPED = re.compile(rf"([<\[])\\(\\*)({TAILS})")

FORMATTED = """conv_id long, segment long, part int, formatted string, input_ids array<int>,
loss_mask array<boolean>"""


def escape(text: str) -> str:
    """One more backslash after the first character of everything that is a control string but for
    backslashes there; so no control string is left, and taking one away undoes it."""
    return PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of some turns and the spans of the assistant's texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        if role == ASSISTANT and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """The turns of a rendered text."""
    for turn in formatted.split(END)[:-1]:
        role, _, text = turn.removeprefix(TURN).partition(TEXT)
        yield unescape(role), unescape(text)


def load(model: str):
    """A tokenizer from the text of its file, to which the template's marks are added."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(model)
    tokenizer.add_special_tokens([TURN, TEXT, END])
    return tokenizer


def mask_of(offsets: list[tuple[int, int]], spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens lie in a span; both are sorted, so each span is two binary searches."""
    starts = np.array([o[0] for o in offsets], dtype=np.int64)
    mask = np.zeros(len(starts), dtype=bool)
    for low, high in spans:
        mask[np.searchsorted(starts, low, "left") : np.searchsorted(starts, high, "left")] = True
    return mask


def format_conversations(turns: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Formatted segments: ``conv_id``, ``segment``, ``part`` (their order), ``formatted``,
    ``input_ids``, ``loss_mask`` (true for the tokens of assistant texts and nothing else).

    Turns (``conv_id``, ``turn``, ``role``, ``text``; other columns are ignored) follow each other by turn
    number, null first, equal numbers by role and text; repeated rows are turns of their own. Null
    role or text is empty; rows with a null ``conv_id`` form one conversation. An empty table gives
    no segments. ``tokenizer`` is read on the driver and sent as text: tasks need no such file.
    """
    spark = turns.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        model = file.read(TOKENIZER_BYTES + 1)
    if len(model) > TOKENIZER_BYTES:
        raise ValueError(f"{tokenizer} is larger than {TOKENIZER_BYTES}")
    sent = spark.sparkContext.broadcast(model)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = load(sent.value)
        held, key, part, chars = [], None, 0, 0

        def close():
            formatted, spans = render(held)
            found = encoder.encode(formatted, add_special_tokens=False)
            return pd.DataFrame(
                {
                    "conv_id": pd.array([key[0]], dtype="Int64"),
                    "segment": pd.array([key[1]], dtype="Int64"),
                    "part": [part],
                    "formatted": [formatted],
                    "input_ids": [found.ids],
                    "loss_mask": [mask_of(found.offsets, spans).tolist()],
                }
            )

        for rows in batches:
            for conv, segment, role, text in zip(
                *(rows[c].astype("Int64") for c in ("conv_id", "segment")), rows["role"], rows["text"], strict=True
            ):
                now = (None if conv is pd.NA else int(conv), None if segment is pd.NA else int(segment))
                if held and (now != key or chars > SEGMENT_CHARS):
                    yield close()
                    part = part + 1 if now == key else 0
                    held, chars = [], 0
                key = now
                held.append((role, text))
                chars += len(role) + len(text)
        if held:
            yield close()

    return (
        turns.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.floor(F.col("turn") / SEGMENT_TURNS).cast("long").alias("segment"),
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .repartition("conv_id", "segment")
        .sortWithinPartitions("conv_id", "segment", "turn", "role", "text")
        .select("conv_id", "segment", "role", "text")
        .mapInPandas(encode, FORMATTED)
    )


DIGESTS = """conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,
formatted_chars long, n_tokens long"""


def read_back(formatted: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Digests of every conversation, from the formatted text and the masked tokens alone.

    Segments of a conversation arrive in order and are hashed one by one, so that memory does not
    grow with the conversation; a digest over its whole text has to be made by one task. Null roles and texts
    were written as empty ones and are read as such; repeated turns are turns; an empty table gives no rows.
    """
    with open(tokenizer, encoding="utf-8") as file:
        sent = formatted.sparkSession.sparkContext.broadcast(file.read())

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = load(sent.value)
        key, state = "none yet", None

        def close():
            return pd.DataFrame(
                {
                    "conv_id": pd.array([key], dtype="Int64"),
                    "n_turns": [state["turns"]],
                    "turns_sha256": [state["all"].hexdigest()],
                    "loss_chars": [state["loss_chars"]],
                    "loss_sha256": [state["loss"].hexdigest()],
                    "formatted_chars": [state["chars"]],
                    "n_tokens": [state["tokens"]],
                }
            )

        for rows in batches:
            for conv, text, ids, mask in zip(
                rows["conv_id"].astype("Int64"), rows["formatted"], rows["input_ids"], rows["loss_mask"], strict=True
            ):
                now = None if conv is pd.NA else int(conv)
                if now != key:
                    if state:
                        yield close()
                    key = now
                    state = {"turns": 0, "all": hashlib.sha256(), "loss": hashlib.sha256()}
                    state |= {"loss_chars": 0, "chars": 0, "tokens": 0}
                for role, body in parse(text):
                    state["turns"] += 1
                    state["all"].update(f"{role}\n{body}\n".encode())
                ids, edge = np.asarray(ids), np.diff(np.concatenate([[0], mask, [0]]).astype(np.int8))
                for low, high in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
                    body = unescape(decoder.decode(ids[low:high].tolist(), skip_special_tokens=False))
                    state["loss_chars"] += len(body)
                    state["loss"].update(body.encode())
                state["chars"] += len(text)
                state["tokens"] += len(ids)
        if state:
            yield close()

    return (
        formatted.repartition("conv_id")
        .sortWithinPartitions("conv_id", "segment", "part")
        .mapInPandas(digest, DIGESTS)
    )
