import zlib

import numpy as np
import public_tokenizers
import pytest

from shelfscope.llm import codec, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, start long, row long"
ODD = [None, "", "  ", "Hello, World!! ÉCOLE 123", "a<|endoftext|>b <|ENDOFTEXT|>", "x\x00y \x1c z\x85w\xa0v", "ΣΑΣ İstanbul",
       "日本語 テキスト", "e\u0301 \u212b ﬁ", "it's we'll I'M 'd", "\r\n\t a\u2003b", "😀 😀😀", "A" * 3000]


def test_codec_round_trip_and_independent_blocks():
    rs = np.random.RandomState(0)
    blocks = [rs.randint(0, 65536, n) for n in (1, 2, 17, 1000, 4096)] + [np.zeros(4096, int), np.full(300, 65535),
              np.tile([5, 6, 7, 8], 500), rs.zipf(1.3, 4096) % 49408]
    payloads = codec.encode(blocks)
    for got, want in zip(codec.decode(payloads, [len(b) for b in blocks]), blocks):
        assert (got == want).all()
    for p, b in list(zip(payloads, blocks))[::3]:  # each alone gives the same
        assert codec.encode([b]) == [p] and (codec.decode([p], [len(b)])[0] == b).all()
    assert len(payloads[7]) < 300  # a repeating sequence is learnt


def test_crc_of_joined_strings():
    rs = np.random.RandomState(1)
    for n in (0, 1, 4, 1000, 16384):
        a, b = rs.bytes(50), rs.bytes(n)
        assert codec.crc_join(zlib.crc32(a), zlib.crc32(b), n) == zlib.crc32(a + b)


def test_damage_is_found():
    ids = np.arange(100)
    f = codec.frame(0, ids, np.array([(0, 1, 0, 100)], codec.PIECE), codec.encode([ids])[0])
    assert codec.parse(f)[1] == 100
    for at in (0, codec.HEAD.size + 2, len(f) - 1):
        bad = bytearray(f)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            codec.parse(bytes(bad))


def test_encoder_equals_the_library():
    enc = tokens.Encoder(PATH)
    assert enc.split
    for _ in range(2):  # also from the cache
        for text, raw in zip(ODD, enc.encode(ODD)):
            assert np.frombuffer(raw, "<u2").tolist() == enc._ids(text or "") + [tokens.END], text


def _want(rows):
    from tokenizers import Tokenizer
    tok, at, out = Tokenizer.from_file(PATH), 0, []
    for doc, text in rows:
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_files_hold_every_document_in_order(spark):
    big = 2**60 + 1  # beyond a double
    rows = [(big + i if i else None, t) for i, t in enumerate(ODD)]
    rows += [(big + 500, "one two three " * 4000), (big + 501, "after")]  # spans blocks
    df = spark.createDataFrame([(d, t, "x", 7, 7) for d, t in rows], DOCS).repartition(3)
    got = [tuple(r) for r in tokens.query(df).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()]
    assert got == _want(rows)


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b", "x", 0, 0)] * 5 + [(2, "c", "x", 0, 0)], DOCS)
    got = sorted(tuple(r) for r in tokens.query(df).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == sorted(_want([(1, "a b")] * 5 + [(2, "c")]))
    assert tokens.query(spark.createDataFrame([], DOCS)).count() == 0


def test_words_of_latin_letters_skip_the_normalizer_with_equal_ids():
    rs = np.random.RandomState(3)
    letters = [c for c in map(chr, range(256)) if c.isalpha()]
    words = ["".join(rs.choice(letters, n)) for n in rs.randint(1, 14, 3000)] + letters + ["ß" * 40, "ªº", "naïve", "Œuvre", "ﬁn", "Ǆ", "x²", "don't"]
    enc = tokens.Encoder(PATH)
    asked = []
    whole = enc.tok

    class Spy:
        def encode_batch_fast(self, texts, **kw):
            asked.extend(texts[0].split(" \x00 "))
            return whole.encode_batch_fast(texts, **kw)

        def encode(self, *a, **kw):
            return whole.encode(*a, **kw)

    enc.tok = Spy()
    for text, raw in zip([*words, " ".join(words)], enc.encode([*words, " ".join(words)])):
        assert np.frombuffer(raw, "<u2").tolist() == enc._ids(text) + [tokens.END], text
    assert not [w for w in asked if w.isalpha() and max(w) < "Ā"] and "x²" in asked


def test_marks_behind_words_are_split_off_with_equal_ids():
    rs = np.random.RandomState(5)
    bits = ["word", "Word", "école", "ÉCOLE", "x1", "½", "²", "日本", "Σας", "ẖ", "H̱", "İ", "'s", "'", "’", ",", ".", "...", '."', "(", ")", "<", "|", "_", "-",
            "̸", " ", "  ", "\n", " ", "\xa0", "\x85", "á", "K", "\\1", "$", "%", "`", "~", "\t", "ß", "ÿ", "×", "µ", "<|", "\x1f"]
    texts = ["".join(bits[i] for i in rs.randint(0, len(bits) - 2 * (k % 9 != 0), rs.randint(0, 14))) for k in range(4000)]
    enc = tokens.Encoder(PATH)
    assert enc.model is not None
    for text, raw in zip(texts, enc.encode(texts)):
        assert np.frombuffer(raw, "<u2").tolist() == enc._ids(text) + [tokens.END], text
    enc = tokens.Encoder(PATH)
    enc.encode(["Alpha, alpha. alpha; (alpha) alpha!\nalpha"] * 3)
    assert set(enc.words) == {"alpha", ",", ".", ";", "!", "(alpha", ")"}  # one entry for a word, whatever mark follows


def test_words_are_learnt_anew_when_the_cache_is_full(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 3)
    enc = tokens.Encoder(PATH)
    for text in ("one two three four", "five, one", "", "six", "four two x\x00y"):
        assert np.frombuffer(enc.encode([text, text])[1], "<u2").tolist() == enc._ids(text) + [tokens.END]
    assert len(enc.words) < 8


def test_groups_of_blocks_do_not_matter(monkeypatch):
    rs = np.random.RandomState(6)
    blocks = [rs.randint(0, rs.choice([2, 300, 65536]), n) for n in (*rs.randint(1, 700, 150), 4096)]
    blocks += [np.concatenate((np.zeros(900, int), rs.randint(0, 65536, 100), np.zeros(300, int)))]  # many words at once
    sizes, payloads = [len(b) for b in blocks], codec.encode(blocks)
    monkeypatch.setattr(codec, "ENCODED", 40)
    monkeypatch.setattr(codec, "NEAR", 7)
    assert codec.encode(blocks) == payloads
    for got, want in zip(codec.decode(payloads, sizes), blocks):
        assert (got == want).all()
