import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gleanery.llm import bpe, common, lexicon, pretokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_lexicon_is_minimal_and_exact(tmp_path):
    words = {w.encode(): [i, i + 7][: 1 + i % 2] for i, w in enumerate("tap taps top tops stop stops café cafés a".split())}
    file = tmp_path / "l"
    file.write_bytes(lexicon.compile_lexicon(words))
    lex = lexicon.Lexicon(str(file))
    assert lex.n_words == len(words)
    found = lex.numbers([*words, b"", b"ta", b"tapsx", b"zzz", "é".encode()])
    assert sorted(found[: len(words)].tolist()) == list(range(len(words)))
    assert (found[len(words) :] == -1).all()
    assert [lex.ids_of(i) for i in found[: len(words)]] == list(words.values())
    # states by right language: tap/top share their tails
    tails = {frozenset(w[k:] for w in words if w.startswith(p)) for w in words for k in range(len(w) + 1) for p in [w[:k]]}
    assert len(lex.final) == len(tails)


def test_empty_lexicon(tmp_path):
    file = tmp_path / "l"
    file.write_bytes(lexicon.compile_lexicon({}))
    assert lexicon.Lexicon(str(file)).numbers([b"a", b""]).tolist() == [-1, -1]


@pytest.mark.parametrize("name, words", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_encoder_matches_library(odd_texts, name, words):
    v = pretokens.Vocabulary(public_tokenizers.path(name), words)
    texts = [t or "" for t in odd_texts] + [f"a{chr(c)}B 'S{chr(c)}{chr(c)}1" for c in range(1, 0x3000, 7)]
    ids, off = pretokens.Encoder(v).encode(texts)
    for i, t in enumerate(texts):
        assert ids[off[i] : off[i + 1]].tolist() == v.whole(t), t[:60]


@pytest.mark.parametrize("name, words", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_long_texts_in_windows_match_library(odd_texts, name, words, monkeypatch):
    v = pretokens.Vocabulary(public_tokenizers.path(name), words)
    texts = ["", " ".join(t for t in odd_texts if t and len(t) < 400), "x" * 3_000, "a b" * 900, "", "é à " * 300 + " a  b <|endoftext|> a b c", "don't do it's " * 90]
    monkeypatch.setattr(pretokens, "pieces", lambda t: common.pieces(t, 57))
    assert sum(len(g) for _, g in common.pieces(texts, 57)) > 60
    ids, off = pretokens.Encoder(v).encode(texts)
    assert len(off) == len(texts) + 1
    for i, t in enumerate(texts):
        assert ids[off[i] : off[i + 1]].tolist() == v.whole(t), t[:60]
    assert all("".join(common.windows(t, 5)) == t for t in texts)


def test_every_text_is_counted_and_segmented(spark, monkeypatch):
    texts = ["日本 日本", "😀 a", "a<|endoftext|> a", "<|endoftext|><|endoftext|>x  ", "a  <|endoftext|>\n b", "𠀀x\u3000y １２", "\U000e0041a\U00100000", "plain 日本"]
    v = pretokens.Vocabulary(PATH, False)
    want = [v.whole(t) for t in texts]
    monkeypatch.setattr(v, "whole", None)  # no text needs the library
    ids, off = pretokens.Encoder(v).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == want
    counts = {r.word: r.n for r in bpe.count_words(spark.createDataFrame([(t,) for t in texts], "text string"), "text", PATH).collect()}
    assert (counts["日本"], counts[" 日本"], counts["<|endoftext|>"]) == (1, 2, 4)


@pytest.mark.parametrize("at", range(4))
def test_all_characters_match_library(at):
    v = pretokens.Vocabulary(PATH, False)
    points = [c for c in range(0x2E80 + at * 13, 0x110000, 53) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}B '{chr(c)}{chr(c)}1 {chr(c)} " for c in points[i : i + 64]) for i in range(0, len(points), 64)]
    ids, off = pretokens.Encoder(v).encode(texts)
    assert all(ids[off[i] : off[i + 1]].tolist() == v.whole(t) for i, t in enumerate(texts))


def test_encode_decode_frame(spark, odd_texts):
    library = Tokenizer.from_file(PATH)
    rows = [(i if i % 9 else None, t, "x") for i, t in enumerate(odd_texts)] + [(3, "same", "y"), (3, "same", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.decode(bpe.encode(docs, "text", PATH, lexicon=bpe.build_lexicon(docs, "text", PATH, most=20)), "ids", PATH).collect()
    assert len(out) == len(rows)
    want = sorted((library.encode(t or "", add_special_tokens=False).ids, library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False)) for _, t, _ in rows)
    assert sorted((r.ids, r.decoded) for r in out) == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(docs, "text", PATH).collect() == []


def test_query(spark, sf):
    library = Tokenizer.from_file(PATH)
    out = {r.doc_id: r for r in bpe.op1_bpe(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(out) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        r = out[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_words_under_one_hash_stay_apart(monkeypatch):
    """With a first hash of a few bits, words meet in the table and are still told apart."""
    import numpy as np

    whole = pretokens.range_hash
    monkeypatch.setattr(pretokens, "range_hash", lambda p, a, b, base: whole(p, a, b, base) & np.uint64(7) if base == pretokens.BASE_A else whole(p, a, b, base))
    v = pretokens.Vocabulary(PATH, False)
    encoder = pretokens.Encoder(v)
    texts = [" ".join(f"word{i}x{j}" for j in range(40)) for i in range(6)]
    for _ in range(2):
        ids, off = encoder.encode(texts)
        assert all(ids[off[i] : off[i + 1]].tolist() == v.whole(t) for i, t in enumerate(texts))
