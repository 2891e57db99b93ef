import hashlib
import random
import re

import numpy as np

from shelfscope.llm import decontaminate as d

DOCS = "doc_id long, text string, n_chars long, spans string, items string, _s string, _cut int"
ITEMS = "item_id long, text string, n_words string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, window=10):
    wins = {}
    for i, t in items:
        w = words(t)
        k = min(window, len(w))
        for a in range(len(w) - k + 1 if k else 0):
            wins.setdefault(tuple(w[a:a + k]), set()).add(str(i)) if i is not None else wins.setdefault(tuple(w[a:a + k]), set())
    out = {}
    for doc, t in docs:
        w, hit, who = words(t), set(), set()
        for k in {len(x) for x in wins}:
            for a in range(len(w) - k + 1):
                if tuple(w[a:a + k]) in wins:
                    hit |= set(range(a, a + k))
                    who |= wins[tuple(w[a:a + k])]
        out[doc] = (len(w), len(hit), len(who), hashlib.sha256(",".join(sorted(who)).encode()).hexdigest(), bool(hit))
    return out


def run(spark, docs, items, **kw):
    df = spark.createDataFrame([(i, t, 3, "x", "y", "z", 1) for i, t in docs], DOCS)
    it = spark.createDataFrame([(i, t, "q") for i, t in items], ITEMS)
    return {r.doc_id: tuple(r)[1:] for r in d.query(df, it).collect()}


def test_words_follow_the_contract():
    text = "A-b\tÉcole's 12x_y\x7fz 日本語\u2003q"
    assert [w.decode() for w in d.words_of(text)] == words(text)
    assert d.words_of(None) == d.words_of("") == d.words_of(" .,") == []


def test_random_documents_match_brute_force(spark):
    rnd = random.Random(5)
    # few different words: long and overlapping matches, items that share windows
    text = lambda n: " ".join(rnd.choice("abc") if rnd.random() < .9 else rnd.choice(["D,", "É!"]) for _ in range(n))
    items = [(i, text(rnd.choice([0, 1, 3, 9, 10, 11, 25]))) for i in range(40)]
    items = [(i, t) for i, t in items if len(words(t)) not in (1, 3)] + [(100, "a a a b"), (101, None), (102, ""), (103, items[0][1])]
    docs = [(i, text(rnd.randrange(0, 300))) for i in range(60)]
    docs += [(900, None), (901, ""), (902, items[5][1]), (903, "x " + (items[6][1] or "") + " y"), (904, "zz " * 20000 + "a A a-B")]
    assert run(spark, docs, items) == brute(docs, items)


def test_single_word_items_and_empty_tables(spark):
    docs = [(1, "the cat"), (2, "dog"), (3, None)]
    assert run(spark, docs, [(7, "Cat"), (8, "cat")]) == brute(docs, [(7, "Cat"), (8, "cat")])
    assert run(spark, docs, []) == brute(docs, [])
    assert run(spark, [], [(1, "a b")]) == {}


def test_blocks_of_items_give_the_same(spark):
    rnd = random.Random(9)
    text = lambda n: " ".join(rnd.choice("abcd") for _ in range(n))
    items = [(i, text(14)) for i in range(30)]
    docs = spark.createDataFrame([(i, text(200), 3, "x", "y", "z", 1) for i in range(20)], DOCS)
    it = spark.createDataFrame([(i, t, "q") for i, t in items], ITEMS)
    one = d.scan(docs, it, window=5).orderBy("doc_id").collect()
    many = d.scan(docs, it, window=5, block_words=40).orderBy("doc_id").collect()
    assert [tuple(r) for r in one] == [tuple(r) for r in many]


def test_automata_are_built_a_block_a_task_and_cut_alike(spark):
    """Many blocks cut as one does: a cut makes neighbours of the words around it, spans of two blocks may overlap."""
    rnd = random.Random(3)
    text = lambda n: " ".join(rnd.choice("abcdefg") for _ in range(n))
    items = [(i if i else None, text(rnd.choice([0, 9, 14]))) for i in range(12)] + [(30, None), (31, "a b c d e f g a b c d e")]
    it = spark.createDataFrame([(i, t, "q") for i, t in items], ITEMS)
    assert d.automata(it, 4, block_words=30).count() > 3 and d.automata(it, 4).count() == 1
    rows = [(i, text(rnd.choice([5, 60, 200])), 3, "x", "y", "z", 1) for i in range(25)]
    rows += [(90, "x y " * 30 + "a b c d a b c d e f g a b c d e e f g a", 3, "x", "y", "z", 1), (91, None, None, "x", "y", "z", 1), (92, "", 0, "x", "y", "z", 1)]
    docs = spark.createDataFrame(rows + rows[:2], DOCS)
    one = sorted((tuple(r) for r in d.clean(docs, it, window=4, max_coverage=0.9).collect()), key=repr)
    many = sorted((tuple(r) for r in d.clean(docs, it, window=4, max_coverage=0.9, block_words=30).collect()), key=repr)
    assert one == many and any(r[1] != dict((x[0], x[1]) for x in rows)[r[0]] for r in one)
    none = d.clean(docs, it.limit(0), window=4, block_words=30)
    assert none.count() == docs.count()


def test_clean_cuts_spans_and_drops_covered_documents(spark):
    item = "one two three four five six seven eight nine ten eleven"
    keep = "alpha beta gamma " * 10
    rows = [(1, keep + item + ". omega", 9, "s", "i", "_", 1), (2, item, 9, "s", "i", "_", 1), (3, keep, 7, "s", "i", "_", 1),
            (4, None, None, "s", "i", "_", 1), (5, "", 0, "s", "i", "_", 1)]
    out = {r.doc_id: r for r in d.clean(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(1, item, "q")], ITEMS)).collect()}
    assert set(out) == {1, 3, 4, 5}
    assert out[1].text == keep + ". omega" and out[1].n_chars == len(out[1].text) and out[1]._cut == 1
    assert out[3].text == keep and out[3].n_chars == 7 and out[4].text is None and out[5].text == ""


def test_removal_is_exact():
    text = "Aé-b c,  D e"
    assert d.remove(text, [(1, 3)]) == "Aé-,  D e" and d.remove(text, [(0, 5)]) == ""
    assert (np.array(d.merge([(3, 5), (0, 1), (1, 2), (4, 9)])) == [[0, 2], [3, 9]]).all()


def test_kept_columns_may_have_any_name(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k", "s", "scan", 7)], "doc_id long, text string, _s string, _scan string, n_words int")
    bench = spark.createDataFrame([("x", "a b c d e f g h i j")], "item_id string, text string")
    r = d.scan(docs, bench, keep=("_s", "_scan", "n_words")).collect()
    assert len(r) == 1 and r[0].asDict() == {"doc_id": 1, "_s": "s", "_scan": "scan", "n_words": 11, "spans": [(0, 10)], "items": ["x"]}
