"""Operator 2, benchmark decontamination with a generalised suffix automaton.

The normalised benchmark items become one automaton over word numbers: its
states are the classes of word sequences that occur in items, and streaming a
document through it gives, at every word, the length of the longest sequence
ending there that occurs in some item.  Whether a window (10 consecutive item
words; an item of fewer words is one window) ends at a word, and which items
hold it, follows from that state.

The automata are built in tasks: items are spread by a hash over blocks of
bounded size (``BLOCK_WORDS``; one longer item is a block of its own), a block is
one task, and its automaton one row of a table in the shared folder.  The
documents stream past one block at a time without a shuffle, with that block's
automaton as the broadcast: what the driver, a worker and a broadcast hold is one
block, however large the benchmark is.  With several blocks, hits (and only
they) are written block by block, and a document's spans of all blocks are united.

A document's words become numbers through the items' vocabulary; only runs
whose neighbouring words are neighbours in some item can hold a window of two or
more words, and only those runs are streamed.  This narrowing is exact.
"""

from __future__ import annotations

import pickle
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, importable, through_table

BLOCK_WORDS = 500_000  # words of one block at most (two bytes a word at least)
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased; words are runs of digits, letters and everything beyond ASCII; null: none."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD).split() if text else []


class Automaton:
    """Generalised suffix automaton of one block of items."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        number = [(i, [self.vocab.setdefault(w, len(self.vocab)) for w in words]) for i, words in items if words]
        for _, seq in number:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        size = len(self.vocab) + 1
        self.pairs = np.unique(np.array([a * size + b for _, s in number for a, b in zip(s, s[1:])], dtype=np.int64))
        self.size = size
        # items by the state of each of their windows
        self.of_window: dict[int, set] = {}
        self.of_whole: dict[int, list[tuple[int, set]]] = {}
        for item, seq in number:
            if len(seq) < window:
                state = 0
                for c in seq:
                    state = self.next[state][c]
                entry = self.of_whole.setdefault(state, [])
                mine = next((s for n, s in entry if n == len(seq)), None)
                if mine is None:
                    entry.append((len(seq), mine := set()))
                mine.add(item)
                continue
            state, n = 0, 0
            for c in seq:
                state, n = self.step(state, n, c)
                if n >= window:
                    self.of_window.setdefault(self.at(state, window), set()).add(item)
        self.least = min([window, *(len(s) for _, s in number)]) if number else window
        # nearest state up the suffix links, itself included, that is a whole short item
        self.short = [-1] * len(self.link)
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            self.short[s] = s if s in self.of_whole else self.short[self.link[s]]

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = len(nxt)
        nxt.append({}), link.append(0), length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        new = len(nxt)
        nxt.append(dict(nxt[q])), link.append(link[q]), length.append(length[p] + 1)
        link[q] = new
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        return new

    def step(self, state: int, n: int, c: int) -> tuple[int, int]:
        """Longest suffix of the stream that is a sequence of some item."""
        nxt = self.next
        while state and c not in nxt[state]:
            state = self.link[state]
            n = self.length[state]
        to = nxt[state].get(c)
        return (to, n + 1) if to is not None else (0, 0)

    def at(self, state: int, n: int) -> int:
        """The state of the current sequence's last ``n`` words."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Spans [from, to) of words inside occurrences of windows, merged; the items with occurring windows."""
        if len(words) < self.least or not self.vocab:
            return [], set()
        get = self.vocab.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        known = ids >= 0
        follows = np.zeros(len(ids), dtype=bool)  # this word and the one before are neighbours in an item
        cand = np.flatnonzero(known[1:] & known[:-1]) + 1
        if len(cand):
            code = ids[cand - 1] * self.size + ids[cand]
            at = np.minimum(np.searchsorted(self.pairs, code), max(len(self.pairs) - 1, 0))
            follows[cand] = (self.pairs[at] == code) if len(self.pairs) else False
        heads = np.flatnonzero(known & ~follows)
        if not len(heads):
            return [], set()
        broken = np.flatnonzero(~follows)
        ends = np.append(broken, len(ids))[np.searchsorted(broken, heads, side="right")]
        long_enough = ends - heads >= self.least
        spans: list[tuple[int, int]] = []
        items: set = set()
        for a, b in zip(heads[long_enough].tolist(), ends[long_enough].tolist()):
            state = n = 0
            for i, c in enumerate(ids[a:b].tolist(), a):
                state, n = self.step(state, n, c)
                start = i + 1
                if n >= self.window:
                    start = i + 1 - self.window
                    items |= self.of_window.get(self.at(state, self.window), set())
                s = self.short[state] if state else -1
                while s > 0:
                    for k, who in self.of_whole[s]:
                        if k <= n:
                            items |= who
                            start = min(start, i + 1 - k)
                    s = self.short[self.link[s]] if self.link[s] > 0 else -1
                if start <= i:
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                    spans.append((start, i + 1))
        return spans, items


def automata(benchmark: DataFrame, window: int = 10, item: str = "item_id", text: str = "text",
             block_words: int = BLOCK_WORDS) -> DataFrame:
    """The table (block, automaton) of the benchmark's items, written to the shared folder; no items: no rows."""
    importable(benchmark.sparkSession)
    items = benchmark.select(F.col(f"`{item}`").cast("string").alias("i"), F.col(f"`{text}`").alias("t")).where("t IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = 1 if size <= 2 * block_words else -(-size // block_words)  # half full on average

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        one = Automaton([(i, words_of(t)) for i, t in zip(rows["i"], rows["t"])], window)
        return pd.DataFrame({"block": rows["block"][:1], "automaton": [pickle.dumps(one)]})

    of = F.expr(f"CAST(pmod(xxhash64(i, t), {blocks}) AS INT)")
    return through_table(items.withColumn("block", of).groupBy("block").applyInPandas(build, "block int, automaton binary"), "automata")


_LOADED: dict[int, Automaton] = {}  # a worker keeps the automaton it used last


class Block:
    """One block's automaton, shared with the workers as bytes."""

    def __init__(self, spark: SparkSession, table: DataFrame, block: int):
        self.data = spark.sparkContext.broadcast(bytes(table.where(F.col("block") == block).first()["automaton"]))
        self.number = self.data._jbroadcast.id()

    def __getstate__(self):
        return {"data": self.data, "number": self.number}

    def get(self) -> Automaton:
        if self.number not in _LOADED:
            _LOADED.clear()
            _LOADED[self.number] = pickle.loads(self.data.value)
        return _LOADED[self.number]


def _stream(block: Block | None):
    """The UDF text -> n_words, spans, items of one block."""
    @F.pandas_udf("n_words long, spans array<struct<a:long,b:long>>, items array<string>")
    def stream(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            words = words_of(t)
            spans, items = block.get().scan(words) if block else ([], set())
            out.append((len(words), [{"a": a, "b": b} for a, b in spans], sorted(x for x in items if x is not None)))
        return pd.DataFrame(out, columns=["n_words", "spans", "items"])
    return stream


def _hits(docs: DataFrame, table: DataFrame, blocks: list[int], row: str, text: str) -> DataFrame:
    """Several blocks: (row, spans, items) of the rows with a hit, blocks united.  ``docs`` is a written table with the
    row number ``row``; each block is one pass over its texts, whose hits are written."""
    spark, made = docs.sparkSession, []

    @F.pandas_udf("array<struct<a:long,b:long>>")
    def merged(spans: pd.Series) -> pd.Series:
        return pd.Series([[{"a": a, "b": b} for a, b in merge([(x["a"], x["b"]) for x in s])] for s in spans])

    for b in blocks:
        block = Block(spark, table, b)
        one = docs.select(F.col(row).alias("row"), _stream(block)(F.col(f"`{text}`")).alias("s")).where(F.size("s.spans") > 0)
        made.append(through_table(one.select("row", "s.spans", "s.items"), "block-hits"))
        block.data.destroy()
    # a row has at most one entry a block here
    return reduce(DataFrame.union, made).groupBy("row").agg(
        _as_list("spans").alias("spans"), F.array_sort(F.array_distinct(_as_list("items"))).alias("items")).withColumn("spans", merged("spans"))


def _as_list(col: str):
    return F.flatten(F.collect_list(col))


def scan(docs: DataFrame, benchmark: DataFrame, window: int = 10, key: str = "doc_id", text: str = "text",
         item: str = "item_id", item_text: str = "text", keep: tuple[str, ...] = (), block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per row of ``docs``: key, the columns ``keep``, n_words, spans
    (merged [from, to) word ranges inside windows' occurrences) and items
    (ids as strings, sorted; a null id is none).  Null or wordless texts have no words
    and no spans, null or wordless items no windows; repeated items both count.  A kept column named
    like a made one (n_words, spans, items) gives way to it.
    """
    importable(docs.sparkSession)
    names = [c for c in dict.fromkeys((key, *keep)) if c.lower() not in ("n_words", "spans", "items")]
    cols, made = [F.col(f"`{c}`") for c in names], fresh(docs, "_scan")
    table = automata(benchmark, window, item, item_text, block_words)
    blocks = sorted(r.block for r in table.select("block").collect())
    if len(blocks) < 2:
        one = Block(docs.sparkSession, table, blocks[0]) if blocks else None
        out = docs.select(*cols, _stream(one)(F.col(f"`{text}`")).alias(made))
        return out.select(*cols, *[F.col(made)[c].alias(c) for c in ("n_words", "spans", "items")])
    row = fresh(docs, "_row")
    texts = [] if text in names else [F.col(f"`{text}`")]
    docs = through_table(docs.select(*cols, *texts, F.monotonically_increasing_id().alias(row)), "numbered")
    hits = _hits(docs, table, blocks, row, text).select(F.col("row").alias(row), F.struct("spans", "items").alias(made))
    count = _stream(None)(F.col(f"`{text}`"))["n_words"].alias("n_words")
    out = docs.join(hits, row, "left")
    return out.select(*cols, count, F.coalesce(F.col(made)["spans"], F.expr("CAST(array() AS array<struct<a:bigint,b:bigint>>)")).alias("spans"),
                      F.coalesce(F.col(made)["items"], F.expr("CAST(array() AS array<string>)")).alias("items"))


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and out[-1][1] >= a:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    s = scan(docs, benchmark).withColumn("n_hit", F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, x: n + x["b"] - x["a"]))
    return s.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, min_span: int = 1, max_coverage: float = 0.5,
          text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without benchmark text: spans of at least ``min_span`` words are cut
    out of the text (with the white space and marks between their words), and
    documents with more than ``max_coverage`` of their words in such spans are
    dropped.  All columns are kept; texts without a span stay as they are.
    A column ``n_chars``, if any, follows the new text.
    """
    importable(docs.sparkSession)
    cols, schema = docs.columns, docs.schema
    table = automata(benchmark, window, block_words=block_words)
    blocks = sorted(r.block for r in table.select("block").collect())
    made = fresh(docs, "_cut")
    if len(blocks) < 2:
        cut = _cut(Block(docs.sparkSession, table, blocks[0]) if blocks else None, min_span)
        out = docs.withColumn(made, cut(F.col(f"`{text}`")))
    else:
        row = fresh(docs, "_row")
        docs = through_table(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
        new = _cut_by_blocks(docs, table, blocks, row, text, min_span).select(F.col("row").alias(row), F.struct("cut", "total", "text").alias(made))
        new_text = F.when(F.col(made).isNull(), F.col(f"`{text}`")).otherwise(F.col(made)["text"])
        whole = F.struct(F.coalesce(F.col(made)["cut"], F.lit(0)).alias("cut"), F.coalesce(F.col(made)["total"], F.lit(0)).alias("total"), new_text.alias("text"))
        out = docs.join(new, row, "left").withColumn(made, whole)
    out = out.where((F.col(made)["total"] == 0) | (F.col(made)["cut"] <= max_coverage * F.col(made)["total"]))
    new = {text: F.col(made)["text"]}
    if "n_chars" in cols:
        same = F.col(made)["text"].eqNullSafe(F.col(f"`{text}`"))
        new["n_chars"] = F.when(same, F.col("n_chars")).otherwise(F.length(F.col(made)["text"])).cast(schema["n_chars"].dataType)
    return out.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in cols])


def _cut(block: Block | None, min_span: int):
    """The UDF text -> words cut, words of the text, the text without spans."""
    @F.pandas_udf("cut long, total long, text string")
    def cut(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            total, cut_words = None, 0
            while True:  # the words around a cut become neighbours: look again
                words = words_of(t)
                total = len(words) if total is None else total
                spans = [s for s in block.get().scan(words)[0] if s[1] - s[0] >= min_span] if block else []
                if not spans:
                    break
                cut_words += sum(b - a for a, b in spans)
                t = remove(t, spans)
            out.append((cut_words, total, t))
        return pd.DataFrame(out, columns=["cut", "total", "text"])
    return cut


def _cut_by_blocks(docs: DataFrame, table: DataFrame, blocks: list[int], row: str, text: str, min_span: int) -> DataFrame:
    """``_cut`` for several blocks: (row, cut, total, text) of the rows with a span.  A cut makes neighbours of the words around
    it, so the rows of one round's cuts, and only they, are looked at again in the next."""
    @F.pandas_udf("cut long, total long, text string")
    def step(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        out = []
        for t, s in zip(texts, found):
            spans = [(x["a"], x["b"]) for x in s if x["b"] - x["a"] >= min_span]
            out.append((sum(b - a for a, b in spans), len(words_of(t)), remove(t, spans) if spans else t))
        return pd.DataFrame(out, columns=["cut", "total", "text"])

    left, rounds = docs.select(F.col(row).alias("row"), F.col(f"`{text}`").alias("text")), []
    while True:
        hits = _hits(left, table, blocks, "row", "text")
        cut = left.join(hits, "row").select("row", F.lit(len(rounds)).alias("round"), step("text", "spans").alias("s")).where("s.cut > 0")
        cut = through_table(cut.select("row", "round", "s.cut", "s.total", "s.text"), "cuts")
        if rounds and cut.isEmpty():
            break
        rounds.append(cut)
        left = cut.select("row", "text")
    return reduce(DataFrame.union, rounds).groupBy("row").agg(
        F.sum("cut").alias("cut"), F.min_by("total", "round").alias("total"), F.max_by("text", "round").alias("text"))


def remove(text: str, spans: list[tuple[int, int]]) -> str:
    """Cuts word spans out of ``text``; the words' places are found in its UTF-8 bytes."""
    raw = text.encode("utf-8", "surrogatepass")
    low = np.frombuffer(raw.translate(_WORD), np.uint8) != 32
    edge = np.diff(np.concatenate(([False], low, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at:starts[a]])
        at = int(ends[b - 1])
    out.append(raw[at:])
    return b"".join(out).decode("utf-8", "surrogatepass")
