import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from stratamart.llm import chat

PIECES = st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "|", ">", "/", "s>", "é", "\n", " ", "INST]", "x"]), max_size=12)


@given(PIECES.map("".join))
def test_escapes_leave_no_control_string_and_come_back(text):
    hidden = chat.escape(text)
    assert not any(c in hidden for c in chat.CONTROLS)
    assert chat.unescape(hidden) == text


@pytest.fixture(scope="module")
def encoder():
    return chat.load(open(chat.TOKENIZER).read())


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "[INST]"]), PIECES.map("".join)), max_size=5))
def test_masked_tokens_are_the_assistants_texts(encoder, turns):
    text, spans = chat.render(turns)
    assert list(chat.parse(text)) == turns
    found = encoder.encode(text, add_special_tokens=False)
    mask = chat.mask_of(found.offsets, spans)
    ids = [i for i, m in zip(found.ids, mask, strict=True) if m]
    assert chat.unescape(encoder.decode(ids, skip_special_tokens=False)) == chat.unescape(
        "".join(chat.escape(t) for r, t in turns if r == "assistant")
    )


def expected(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns = [t[2:] for t in sorted(turns)]
        said = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (
            len(turns),
            hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            len(said),
            hashlib.sha256(said.encode()).hexdigest(),
            len(chat.render(turns)[0]),
        )
    return out


def read(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, segment int, part string")
    out = chat.read_back(chat.format_conversations(df)).collect()
    return {r["conv_id"]: tuple(r)[1:6] for r in out}


def test_read_back(spark, monkeypatch):
    rows = [(1, 0, "user", "hi <|end|>"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 2, "assistant", None)]
    rows += [(2, None, None, None), (2, 5, "assistant", "tie"), (2, 5, "assistant", "tie"), (2, 5, "assistant", "a tie")]
    rows += [(None, 0, "assistant", "no number"), (-3, -70, "user", "early"), (-3, 3, "assistant", "é😀" * 900)]
    rows += [(7, i, "assistant" if i % 2 else "user", f"turn {i}\n") for i in range(500)]
    rows += [(8, 0, "system", ""), (9, 1, "assistant", "long " * 100_000)]
    assert read(spark, rows) == expected(rows)
    monkeypatch.setattr(chat, "SEGMENT_CHARS", 50)
    assert read(spark, rows[:40]) == expected(rows[:40])
    assert read(spark, []) == {}
