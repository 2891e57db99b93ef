import random

import duckdb

from shelfscope.llm import chat as c

CONV = "conv_id long, turn long, role string, text string, side string, n int, part string"


def rendered(role, text):
    return f"<|im_start|>{role or ''}\n{text or ''}<|im_end|>\n"


def slow(rows):
    """(pair, part, turn, role, segment, n_chars, trained), sorted."""
    pairs = {}
    for conv, turn, role, text in rows:
        pair = None if conv is None else (conv - conv % 2) // 2
        pairs.setdefault(pair, ([], []))[0 if conv is not None and conv % 2 == 0 else 1].append((turn, role, text))
    out = []
    big = 2**63 - 1
    for pair, (a, b) in pairs.items():
        differ = [t for t in set(a) | set(b) if a.count(t) != b.count(t)]
        stop = min((big if t[0] is None else t[0] for t in differ), default=None)
        shared = lambda t: stop is None or (big if t[0] is None else t[0]) < stop
        for part, side in (("prompt", [t for t in a if shared(t)]), ("chosen", [t for t in a if not shared(t)]),
                           ("rejected", [t for t in b if not shared(t)])):
            for turn, role, text in side:
                s = rendered(role, text)
                out.append((pair, part, turn, role, s, len(s), part != "prompt" and role == "assistant"))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "s", 1, "p") for r in rows], CONV)
    s = c.preference_segments(c.pair_by_id(df)).drop("seq")
    return sorted((tuple(r) for r in s.collect()), key=str)


def slow_replies(rows):
    """The query by hand: each conversation against itself with the other one's last reply; in order."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn, role, text))
    last = {k: max((t, x or "") for t, r, x in v if r == "assistant" and t is not None) for k, v in convs.items()
            if any(r == "assistant" and t is not None for t, r, x in v)}
    big, out = 2**63 - 1, {}
    for k, (end, _) in last.items():
        if k ^ 1 not in last:
            continue
        a = convs[k]
        b = [t for t in a if t[0] is not None and t[0] < end] + [(end, "assistant", last[k ^ 1][1])]
        differ = [t for t in set(a) | set(b) if a.count(t) != b.count(t)]
        stop = min((big if t[0] is None else t[0] for t in differ), default=None)
        shared = lambda t: stop is None or (big if t[0] is None else t[0]) < stop
        out[k] = [[rendered(*t[1:]) for t in sorted(side, key=lambda t: (big if t[0] is None else t[0], t[1] or "", rendered(*t[1:])))]
                  for side in ([t for t in a if shared(t)], [t for t in a if not shared(t)], [t for t in b if not shared(t)])]
    return out


def replies(spark, rows):
    df = spark.createDataFrame([(*r, "s", 1, "p") for r in rows], CONV).repartition(3)
    out = {}
    for r in sorted(c.query(df).collect(), key=lambda r: (r.seq_turn, r.role or "", r.segment, r.seq_copy)):
        assert r.n_chars == len(r.segment) and r.trained == (r.part != "prompt" and r.role == "assistant")
        assert r.seq_turn == (2**63 - 1 if r.turn is None else r.turn)
        out.setdefault(r.pair_id, [[], [], []])[["prompt", "chosen", "rejected"].index(r.part)].append(r.segment)
    return out


def test_query_pairs_share_their_prefix(spark):
    rnd = random.Random(5)
    rows = [(conv, turn, "assistant" if turn % 2 else "user", rnd.choice(["same", f"t{conv}-{turn}", None, ""]))
            for conv in range(80) for turn in range(rnd.randrange(0, 7))]
    rows += [(200, 1, "assistant", "a"), (200, 1, "assistant", "b"), (200, None, "assistant", "z"), (200, 0, "user", "hi"), (200, 0, "user", "hi"), (200, 2, "user", "end"),
             (201, 5, "assistant", "c"), (202, 0, "user", "no reply"), (203, 1, "assistant", "x"), (None, 1, "assistant", "y"), (-1, 1, "assistant", "m"), (-2, 1, "assistant", "n")]
    want = slow_replies(rows)
    assert replies(spark, rows) == want
    assert sum(bool(v[0]) for v in want.values()) > 30 and all(v[1] or v[2] or v[0] for v in want.values())
    assert want[200][0] == [rendered("user", "hi")] * 2


def test_query_on_a_hot_conversation_and_on_none(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(3000)] + [(0, 1, "assistant", "other")]
    got = replies(spark, rows)
    assert got == slow_replies(rows) and len(got[1][0]) == 2999 and replies(spark, []) == {}


def test_segments_by_definition(spark):
    rnd = random.Random(8)
    rows = []
    for conv in range(60):
        base = random.Random(conv // 2)
        for turn in range(rnd.randrange(0, 6)):
            shared = turn < 3 and base.random() < .9
            rows.append((conv, turn, "assistant" if turn % 2 else "user", f"t{turn}" if shared else f"t{conv}-{turn}"))
    rows += [(200, 0, "user", "same"), (201, 0, "user", "same"), (201, 0, "user", "same"),       # repeated on one side
             (202, 0, None, None), (203, 0, None, None), (202, None, "assistant", "x"), (203, 1, "assistant", "é" * 9),
             (204, 0, "user", "only one side"), (None, 0, "user", "no id"), (206, 1, "user", "a"), (206, 1, "system", "b"),
             (207, 1, "system", "b"), (207, 1, "user", "a"), (208, 0, "user", ""), (209, 0, "user", "")]
    assert run(spark, rows) == slow(rows)


def test_hot_conversation_rows_and_empty(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(2000)] + [(0, 0, "user", "turn 0")]
    assert run(spark, rows) == slow(rows)
    assert run(spark, []) == []
    df = c.preference_rows(c.preference_segments(c.pair_by_id(spark.createDataFrame([(*r, "s", 1, "p") for r in rows], CONV))))
    r = df.first()
    assert r.prompt == rendered("user", "turn 0") and r.chosen == "" and r.rejected == "".join(rendered(*x[2:]) for x in rows[1:2000])
    assert [m.trained for m in r.rejected_mask][:3] == [True, False, True] and sum(m.n_chars for m in r.rejected_mask) == len(r.rejected)


def test_sql_gives_the_same(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    got = sorted((tuple(r) for r in c.query(spark.read.parquet(f"{sf}/conversations.parquet")).collect()), key=str)
    assert got == sorted(con.sql(c.ORACLE).fetchall(), key=str)
