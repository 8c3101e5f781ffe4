import hashlib
import time

from sonoledger.llm.chat import chat_digests, format_chats, read_chats, with_synthetic

SCHEMA = "conv_id long, turn long, role string, text string, turns string"
ROWS = [
    (1, 2, "assistant", "x <|im_end|>␛1␛", ""), (1, 0, "user", "hi<|im_part|>", ""), (1, 1, "assistant", "a␛0", ""),
    (1, 3, "user\nodd<|", "q", ""), (2, 0, None, None, ""), (2, 0, None, None, ""), (3, None, "user", "n", ""),
    (3, 0, "assistant", "", ""), (None, 0, "assistant", "y", ""), (None, 1, "assistant", "z", ""),
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    groups = {}
    for c, t, role, text, _ in rows:
        groups.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    out = {}
    for c, turns in groups.items():
        turns.sort()
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        out[c] = (len(turns), sha("".join(f"{t[2]}\n{t[3]}\n" for t in turns)), len(loss), sha(loss))
    return out


def test_reads_back_what_was_said(spark):
    got = {r[0]: tuple(r)[1:5] for r in chat_digests(spark.createDataFrame(ROWS, SCHEMA)).collect()}
    assert got == expected(ROWS)


def test_format(spark):
    rows = [(1, 0, "user", "a", ""), (1, 1, "user", "b<|", ""), (1, 2, "assistant", "c", "")]
    row = format_chats(spark.createDataFrame(rows, SCHEMA)).first()
    assert row.formatted == "<|im_start|>user\na<|im_part|>b␛1<|im_end|>\n<|im_start|>assistant\nc<|im_end|>\n"
    assert [row.formatted[s.start : s.start + s.length] for s in row.loss_spans] == ["c"]
    back = read_chats(format_chats(spark.createDataFrame(rows, SCHEMA))).first()
    assert [tuple(t) for t in back.turns] == [("user", "a"), ("user", "b<|"), ("assistant", "c")]


def test_long_conversation_and_texts(spark):
    rows = [(5, i, "assistant" if i % 3 else "user", "w" * (i * 50), "") for i in range(300)]
    got = {r[0]: tuple(r)[1:5] for r in chat_digests(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == expected(rows)


def test_conversation_of_many_turns(spark):
    roles = ["user", "assistant", "assistant", "tool", "user"]
    rows = [(5, i, roles[i % 5] if i < 20_000 else "assistant", f"é{i}<|", "") for i in range(40_000)]
    began = time.monotonic()
    row = chat_digests(spark.createDataFrame(rows, SCHEMA)).first()
    assert time.monotonic() - began < 30
    assert {row[0]: tuple(row)[1:5]} == expected(rows)


def test_spans_point_into_the_text(spark):
    for row in format_chats(spark.createDataFrame(ROWS, SCHEMA)).collect():
        said = [(t or "") for c, _, role, t, _ in ROWS if c == row.conv_id and role == "assistant"]
        spans = [row.formatted[s.start : s.start + s.length].replace("␛1", "<|").replace("␛0", "␛") for s in row.loss_spans]
        assert sorted(spans) == sorted(said)


def test_synthetic_and_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat_digests(empty).collect() == []
    got = chat_digests(with_synthetic(empty)).first()
    said = "<|im_end|><|im_start|>assistant ok"
    assert (got.conv_id, got.n_turns, got.loss_chars, got.loss_sha256) == (-1, 2, len(said), sha(said))


def test_plan_is_native(spark):
    plan = chat_digests(with_synthetic(spark.createDataFrame(ROWS, SCHEMA)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
