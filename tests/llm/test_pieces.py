"""Op 4: protobuf parsing, parity with sentencepiece, round trips, awkward rows."""
import struct

import numpy as np
import pytest
import sentencepiece

from metroscope.llm import pieces as P

TEXTS = ["", " ", "  ", " a  b   c ", "<s>hi</s><unk>", "日本語テキスト🎉\x00\t\n", "a" * 300, " " * 100 + "x", "é ﬁ ½", "<0x41>",
         "aaabbb   \n\n  x", "The quick brown fox's 12,345 jumps!\n" * 20, "▁x▁▁y"]


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def msg(*fields):
    """Serialise (number, int | float | str | bytes) fields."""
    out = b""
    for n, v in fields:
        if isinstance(v, float):
            out += varint(n << 3 | 5) + struct.pack("<f", v)
        elif isinstance(v, int):
            out += varint(n << 3) + varint(v)
        else:
            v = v.encode() if isinstance(v, str) else v
            out += varint(n << 3 | 2) + varint(len(v)) + v
    return out


def unigram_model(byte_fallback):
    """A small hand-written unigram model in the wire format."""
    words = {"▁": -3.0, "▁a": -2.5, "a": -3.5, "b": -3.6, "ab": -4.0, "▁ab": -4.2, "c": -5.0, "abc": -6.5, "▁the": -3.1, "t": -6.0,
             "h": -6.1, "e": -6.2, "he": -5.5, "▁▁": -7.0}
    own = [msg((1, "<unk>"), (2, 0.0), (3, 2)), msg((1, "<s>"), (2, 0.0), (3, 3)), msg((1, "</s>"), (2, 0.0), (3, 3))]
    if byte_fallback:
        own += [msg((1, f"<0x{b:02X}>"), (2, 0.0), (3, 6)) for b in range(256)]
    own += [msg((1, w), (2, s)) for w, s in words.items()]
    trainer = msg((3, 1), (35, int(byte_fallback)), (40, 0), (41, 1), (42, 2))
    normalizer = msg((1, "identity"), (3, 1), (4, 0), (5, 1))
    return b"".join(varint(1 << 3 | 2) + varint(len(p)) + p for p in own) + msg((2, trainer), (3, normalizer))


def test_parse_agrees_with_the_library():
    data = P.read_model()
    m, sp = P.parse_model(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    assert len(m.pieces) == sp.get_piece_size() and m.model_type == P.BPE and m.byte_fallback
    for i in range(0, len(m.pieces), 37):
        text, score, kind = m.pieces[i]
        assert text == sp.id_to_piece(i) and score == pytest.approx(sp.get_score(i))
        assert (kind == P.CONTROL, kind == P.BYTE, kind == P.UNKNOWN) == (sp.is_control(i), sp.is_byte(i), sp.is_unknown(i))
    with pytest.raises(ValueError):
        P.parse_model(data[:1000])


@pytest.mark.parametrize("model", [P.read_model(), unigram_model(True), unigram_model(False)], ids=["bpe", "unigram-bytes", "unigram"])
def test_parity(model):
    coder = P.Coder(model)
    texts = TEXTS + ["abc ab a b c the he", "cab the  abcabc", "xyz ab"]
    for text, (ids, same, _) in zip(texts, coder.encode(texts)):
        assert same or "<0x" in text, text
        # the ids are the tokenizer's own, and the flag tells the truth about them
        own = coder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<i4").tolist() == own and same == (own == coder.reference.encode(text))


def test_round_trip():
    coder = P.Coder(P.read_model())
    texts = [t for t in TEXTS if P.MARK not in t]  # the marker itself reads back as a space
    assert coder.decode([np.frombuffer(ids, "<i4").tolist() for ids, _, _ in coder.encode(texts)]) == texts
    assert all(back for _, _, back in coder.encode(texts))


def test_unsupported_models_are_refused():
    m = P.PieceModel(pieces=[("<unk>", 0.0, P.UNKNOWN)], suffix_marker=True)
    with pytest.raises(ValueError):
        P.build_tokenizer(m)


def test_whole_table(spark, sf):
    from metroscope.llm.queries import QUERIES

    sp = sentencepiece.SentencePieceProcessor(model_file=P.MODEL_PATH)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op4_sentencepiece"](spark, sf).collect()
    assert len(got) == len(texts) and all(r.parity and r.round_trip for r in got)
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(sp.encode(t)) for i, t in texts.items()}


def test_awkward_rows(docs_of, awkward):
    model = P.read_model()
    for extra in (False, True):
        out = P.encode_documents(docs_of(awkward, extra), model)
        got = out.collect()
        assert len(got) == len(awkward)
        nulls = [r for r in got if r.token_ids is None]
        assert len(nulls) == sum(t is None for _, t in awkward) and all(r.n_tokens == 0 and r.parity is None for r in nulls)
        back = sorted(((str(r.doc_id), str(r.text)) for r in P.decode_documents(out, model).collect()))
        assert back == sorted((str(i), str(t)) for i, t in awkward)
    assert P.encode_documents(docs_of([]), model).count() == 0
