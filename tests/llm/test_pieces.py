import random

import duckdb
import sentencepiece

from shelfscope.llm import pieces as p

DOCS = "doc_id long, text string, ids string, decoded int"
ODD = [None, "", " ", "   ", "\n", "a", " a", "a ", "a  b", "  lead", "tail  ", "x\n\n y\n", "日本語 ひらがな 漢字", "😀 e\u0301 \u0301", "a\tb\r\n",
       "<s> </s> <unk> <0x0A>", "\x00\x01", "aaaaaaaaaaaaaaaaaaa", "------ ======= ....... /////", "word" * 500, "é" * 300, "It's 12,345.67!",
       "   many   spaces   here   ", "▁ marks ▁▁x"]


def test_ids_equal_the_library():
    lib = sentencepiece.SentencePieceProcessor(model_file=p.model_path())
    texts = [r[0] for r in duckdb.sql("select text from '/root/testdata/sf0.001/documents.parquet' order by doc_id").fetchall()]
    rnd = random.Random(1)
    alphabet = "aeiourstln THEing.,'-0129éü\nß日"
    texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(1, 120))) for _ in range(400)]
    model = p.Pieces(p.model_path())
    for part in (ODD, texts, ODD):  # the second time from the cache
        got = model.encode(part)
        want = lib.encode([t or "" for t in part], num_threads=1)
        assert [x.tolist() for x in got] == want
    for t, ids in zip(texts, model.encode(texts)):
        assert model.decode(ids) == lib.decode(ids.tolist()) == t
    # single bytes that are no UTF-8
    assert model.decode([model.bytes_id[0xC3], model.bytes_id[0x28]]) == "\ufffd("


def test_query_and_edge_rows(spark):
    rows = [(i, t) for i, t in enumerate(ODD[:-1])] + [(0, "a"), (None, "a"), (77, "very long text " * 20000)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS)
    lib = sentencepiece.SentencePieceProcessor(model_file=p.model_path())
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_pieces, tuple(r.ids)), r.round_trip) for r in p.query(df).collect())
    want = sorted((i is None, i or 0, len(ids), tuple(ids)) for (i, t), ids in zip(rows, lib.encode([t or "" for _, t in rows])))
    assert [g[0] for g in got] == want and all(g[1] for g in got)
    assert p.query(spark.createDataFrame([], DOCS)).count() == 0
    one = p.decode_docs(spark.createDataFrame([(None,)], "ids array<int>"), p.model_path()).first()
    assert one.decoded is None


def test_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "some text", 5, "x"), (1, "some text", 5, "x")], "doc_id long, text string, made_ids int, made_check string")
    rows = p.encode_docs(df, p.model_path(), check="ok").collect()
    assert len(rows) == 2 and all((r.made_ids, r.made_check, r.ok) == (5, "x", True) and len(r.ids) for r in rows)


def test_small_generations_change_nothing(monkeypatch):
    """Units that fall out of both generations are learnt again."""
    monkeypatch.setattr(p, "CACHE_UNITS", 40)
    lib = sentencepiece.SentencePieceProcessor(model_file=p.model_path())
    model, rnd = p.Pieces(p.model_path()), random.Random(2)
    for _ in range(60):
        part = [" ".join(rnd.choice(["the", "and", f"w{rnd.randrange(300)}", "Straße,", "x" * rnd.randrange(1, 9)]) for _ in range(12))]
        assert model.encode(part)[0].tolist() == lib.encode(part[0])
        assert len(model.units) <= 40 and len(model.older) < 300
    model.rest()
    assert not model.older


def test_unigram_model_by_its_scores(tmp_path):
    """A model written by hand: the path with the greatest sum of scores, as the library finds it."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    m, rnd = pb.ModelProto(), random.Random(4)
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback = pb.TrainerSpec.UNIGRAM, True
    m.trainer_spec.unk_id, m.trainer_spec.bos_id, m.trainer_spec.eos_id, m.trainer_spec.pad_id = 0, 1, 2, -1
    m.normalizer_spec.name, m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.remove_extra_whitespaces = "identity", True, False
    kinds = pb.ModelProto.SentencePiece
    for name, kind in (("<unk>", kinds.UNKNOWN), ("<s>", kinds.CONTROL), ("</s>", kinds.CONTROL)):
        m.pieces.add(piece=name, score=0.0, type=kind)
    for b in range(256):
        m.pieces.add(piece=f"<0x{b:02X}>", score=0.0, type=kinds.BYTE)
    texts = {p.SPACE, *"abcdé", *(p.SPACE * (rnd.random() < 0.3) + "".join(rnd.choice("abcdé") for _ in range(rnd.randrange(1, 6))) for _ in range(150))}
    for t in sorted(texts):
        m.pieces.add(piece=t, score=-rnd.uniform(1, 9) * (1 + len(t) / 4), type=kinds.NORMAL)
    path = tmp_path / "unigram.model"
    path.write_bytes(m.SerializeToString())
    lib, mine = sentencepiece.SentencePieceProcessor(model_file=str(path)), p.Pieces(str(path))
    rows = ["".join(rnd.choice("abcdé  ") for _ in range(rnd.randrange(1, 60))).strip() for _ in range(400)] + ["", None, "a", "日本 a", "ab z cd"]
    assert [x.tolist() for x in mine.encode(rows)] == [lib.encode(r or "") for r in rows]
