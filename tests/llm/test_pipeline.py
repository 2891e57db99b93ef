import numpy as np
import sentencepiece

import corpus_pipeline as cp
from shelfscope.llm import decontaminate, pieces, quality, simhash

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_bite(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "decontamination", "sentencepiece"]
    before, path = docs, None
    import tempfile
    for name, stage in cp.STAGES:
        out = stage(spark, before, SF)
        path = tempfile.mkdtemp() + "/t"
        out.write.parquet(path)
        after = spark.read.parquet(path)
        if name != "sentencepiece":
            assert after.columns == docs.columns
        old, new = {r.doc_id: r for r in before.collect()}, {r.doc_id: r for r in after.collect()}
        assert set(new) <= set(old) and len(new) == after.count()
        if name == "quality":
            m = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            want = {i for i, r in old.items() if m.score(quality.features(r.text)[None, :])[0] >= 0.3}
            assert set(new) == want
        elif name == "near_duplicates":
            fps = {i: np.uint64(simhash.fingerprint(r.text)) for i, r in old.items()}
            left = set(old)
            while left:  # one, the smallest, of each component stays
                group, stack = set(), [min(left)]
                while stack:
                    a = stack.pop()
                    if a not in group:
                        group.add(a)
                        stack += [b for b in left if int(fps[a] ^ fps[b]).bit_count() <= 3]
                assert group & set(new) == {min(group)}
                left -= group
        elif name == "decontamination":
            auto = decontaminate.Automaton([(i, decontaminate.words_of(t)) for i, t in bench.items()], 10)
            assert not any(auto.scan(decontaminate.words_of(r.text))[1] for i, r in new.items() if r.text == old[i].text)
            assert all(r.n_chars == len(r.text) for i, r in new.items() if r.text != old[i].text)
            clean = {i for i, r in old.items() if not auto.scan(decontaminate.words_of(r.text))[0]}
            assert clean <= set(new) and all(new[i].text == old[i].text for i in clean)
        else:
            lib = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
            assert set(new) == set(old) and all(r.ids == lib.encode(old[i].text) and r.n_pieces == len(r.ids) for i, r in new.items())
        before = after


def test_run_equals_its_stages(spark):
    rows = cp.run(spark, SF).collect()
    assert rows and len({r.doc_id for r in rows}) == len(rows)


def test_entry_lists_every_operator(spark):
    import __spark_entry__ as entry
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(entry.oracle_sql()) <= set(names)
