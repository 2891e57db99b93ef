import random

import numpy as np
import xxhash

from shelfscope.llm import simhash as s
from shelfscope.llm.components import connected_components

DOCS = "doc_id long, text string, k string, t string, fp string, u int, root int"


def brute_components(nodes, near):
    label = {}
    for n in nodes:
        if n in label:
            continue
        stack, label[n] = [n], n
        while stack:
            a = stack.pop()
            for b in nodes:
                if b not in label and near(a, b):
                    label[b] = n
                    stack.append(b)
    return label


def test_fingerprint_by_definition():
    def slow(text, k=3):
        w = [x for x in __import__("re").split("[\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) if x]
        if not w:
            return 0
        sh = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    rnd = random.Random(2)
    texts = [None, "", " \n", "a", "A b", "a b c", "É É é\u2003x y\x1cz", "x " * 5000] + \
        [" ".join(rnd.choice(["ab", "Cd", "é", "f,"]) for _ in range(rnd.randrange(1, 60))) for _ in range(30)]
    assert [s.fingerprint(t) for t in texts] == [slow(t) for t in texts]
    assert s.fingerprint("a b c d", 4) == slow("a b c d", 4)


def test_long_texts_in_chunks(monkeypatch):
    text = " ".join(str(i % 97) for i in range(5000))
    whole = s.fingerprint(text)
    monkeypatch.setattr(s, "CHUNK", 64)
    assert s.fingerprint(text) == whole


def test_links_span_all_pairs_within_three_bits(spark):
    rnd = random.Random(4)
    fps = {rnd.getrandbits(64) for _ in range(60)}
    for base in list(fps)[:20]:  # neighbours at 1 to 5 bits, everywhere in the word
        for n in (1, 2, 3, 3, 4, 5):
            fps.add(base ^ sum(1 << b for b in rnd.sample(range(64), n)))
    dense = rnd.getrandbits(64)  # a dense cluster: many fingerprints in one bucket
    fps |= {dense ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(0, 4))) for _ in range(150)}
    fps |= {0, 7, (1 << 64) - 1, (1 << 63) | 1}
    fps = sorted(fps)
    df = spark.createDataFrame([(s._signed(f),) for f in fps], "fp long")
    links = [(r.u % 2**64, r.v % 2**64) for r in s.fingerprint_links(df).collect()]
    assert all(bin(a ^ b).count("1") for a, b in links)
    want = brute_components(fps, lambda a, b: bin(a ^ b).count("1") <= 3)
    linked = set(map(frozenset, links))
    got = brute_components(fps, lambda a, b: frozenset((a, b)) in linked)
    assert got == want


def test_groups_and_kept_rows(spark):
    a = " ".join(f"w{i}" for i in range(300))
    rows = [(9, a), (4, a), (4, a), (None, a), (2, None), (3, ""), (8, "  "), (5, "something else entirely here"), (None, "alone in a group of one")]
    df = spark.createDataFrame([(i, t, "k", "t", "fp", 1, 1) for i, t in rows], DOCS)
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.fingerprint, r.component_id) for r in s.query(df).collect())
    fa = format(s.fingerprint(a), "016x")
    want = [(((i is None), i or 0), format(s.fingerprint(t), "016x"), 4 if t == a else 2 if not (t or "").strip() else i) for i, t in rows]
    assert got == sorted(want, key=lambda x: (x[0], x[1])) and (((False, 9), fa, 4) in got)
    kept = s.keep_first(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect() if r.text) == sorted(
        [(4, a), (5, "something else entirely here"), (0, "alone in a group of one")])
    assert [r.doc_id for r in kept.collect() if not r.text] == [2]
    empty = spark.createDataFrame([], DOCS)
    assert s.query(empty).count() == 0 and s.keep_first(empty).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 60)] + [(7, 7), (None, 3), (500, 501), (501, 500)]
    df = spark.createDataFrame(links, "u long, v long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 0 for i in range(60)}, 500: 500, 501: 500}
    assert connected_components(spark.createDataFrame([], "u string, v string")).count() == 0


def test_popcount():
    assert s._popcount(np.array([0, 1, 2**64 - 1], np.uint64)).tolist() == [0, 1, 64]
