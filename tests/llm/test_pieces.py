import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from sonoledger.llm.pieces import ChunkEncoder, crossing_pieces, encode_texts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
PARTS = [" ", "  ", "\n", "\t", "a", "the", "é", "▁", "日本", "😀", "<s>", "\x00", "　", "1", "!!"]


def test_no_piece_crosses_a_marker():
    assert crossing_pieces(MODEL) == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=20), st.lists(st.sampled_from(PARTS), max_size=12).map("".join)), max_size=6))
def test_encodes_as_the_library(texts):
    encoder = ChunkEncoder(MODEL, table_bytes=9000)
    for _ in range(2):  # a full table is begun anew
        assert [i.tolist() for i in encoder.encode_many(texts)] == LIBRARY.encode(texts)
    assert [encoder.decode(LIBRARY.encode(t)) for t in texts] == [LIBRARY.decode(LIBRARY.encode(t)) for t in texts]


@pytest.mark.parametrize("text", ["x" * 200_000, "word " * 50_000, " " * 5000])
def test_long_texts(text):
    assert ChunkEncoder(MODEL).encode(text) == LIBRARY.encode(text)


def test_memory_of_texts_without_blanks():
    encoder, most = ChunkEncoder(MODEL, table_bytes=4 << 20), 0
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 3000)]
    for i in range(60):
        texts = ["".join(letters[(i * 7 + j * k) % 3000] for j in range(5000)) for k in (1, 3, 7, 11)]
        assert [t.tolist() for t in encoder.encode_many(texts)] == LIBRARY.encode(texts)
        most = max(most, encoder.held_bytes())
        assert not encoder.rows and not encoder.rows.waiting  # long chunks have no entry
    assert most < 9 << 20
    many = ChunkEncoder(MODEL, table_bytes=1 << 20)
    for i in range(50):
        text = " ".join(f"w{i}x{j}" for j in range(3000))
        assert many.encode(text) == LIBRARY.encode(text)
        assert many.held_bytes() < 3 << 20


def test_a_model_with_pieces_across_markers_is_refused(monkeypatch):
    monkeypatch.setattr("sonoledger.llm.pieces._crossing", lambda held: ["a▁b"])
    with pytest.raises(ValueError, match="marker"):
        ChunkEncoder(MODEL)


def test_documents(make_docs, table):
    docs = make_docs(["a  b", None, "", (7, "same"), (7, "same")]).withColumnRenamed("lang", "n_tokens")
    docs = docs.unionByName(table("documents").select("doc_id", "text", "source", "n_chars").selectExpr("*", "'x' n_tokens"))
    rows = docs.select("doc_id", "text").collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in rows:
        ids = LIBRARY.encode(r.text or "")
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids) if ids else "")))
    assert sorted(map(tuple, encode_texts(docs, MODEL).collect())) == sorted(want)
    assert encode_texts(make_docs([]), MODEL).collect() == []
