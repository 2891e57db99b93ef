"""Operator 1, token ids in range-coded binary files.

``write_token_files`` sorts documents into files by range of doc_id, encodes
whole texts with a public tokenizer, appends the end id and writes blocks of 4096
ids as frames (see codec.py): a header, the pieces of documents that the block
holds, the range-coded ids, and checksums of all three.  A file is a run of
frames; the frames of all files lie in one Parquet table
(file_no, block_no, frame) in the shared folder, so Spark's commit protocol decides which
attempt of a task counts, any store that Spark writes to can hold them, and
each frame can be decoded alone.

``read_token_files`` decodes frames anywhere, in any split, checks them, and
puts each document's pieces together.  The only step over all files is a running
sum with one row per file.
"""

from __future__ import annotations

import json
import os
import uuid
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import codec
from .common import importable, partitions

CACHE_WORDS = 800_000        # a worker's memory of encoded words: about 200 bytes each
PART = 1 << 23               # bytes of text encoded at once, or one text
END = 2
_TAIL = r"([0-9A-Za-zÀ-ÖØ-öø-ÿ])([!-&(-/:-@\[-`{-~]+)(\s|$)"  # an apostrophe may begin 's or 't
_ODD = "<\\||[\\x00\\x1c-\\x1f]"
# how a tokenizer must cut texts so that a word of letters is one piece for its model
_CUTS = ("'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+", "Removed", True)
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that byte-level models show as themselves
_BYTES = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in _SHOWN)} | {32: 32}  # words are put apart by blanks


class Encoder:
    """Encodes whole texts with a tokenizer that drops white space.

    Words between white space are encoded alone by such a tokenizer, so each
    distinct word goes through the library once and a text's ids are its words'
    ids in a row.  Texts which hold anything that could make a difference (markup of
    special tokens, control characters that the two sides don't agree on) go
    through the library whole.
    """

    def __init__(self, path: str, end: int = END):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.end = np.array([end], dtype="<u2")
        self.mark = self._ids("\x00")
        self._forget()
        self.split = len(self.mark) == 1 and self._ids("a \x00 b") == [*self._ids("a"), *self.mark, *self._ids("b")]
        self.model, self.ends = self._plain_model(path)

    def _forget(self) -> None:
        """Word n's ids are pool[stops[n]:stops[n + 1]]."""
        self.words: dict[str, int] = {}
        self.pool, self.stops = np.zeros(0, "<u2"), np.zeros(1, np.int64)

    def _plain_model(self, path: str):
        """The tokenizer's model alone, and which ids end a word; (None, None) if it cuts or changes texts in any
        other way than into words of letters, lower-cased and as bytes."""
        from tokenizers import Tokenizer, pre_tokenizers
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, steps = spec["model"], [spec["normalizer"] or {}, spec["pre_tokenizer"] or {}]
        changes = [(x["type"], x.get("pattern"), x.get("content")) for x in steps[0].get("normalizers", [])]
        cuts = steps[1].get("pretokenizers", [])
        known = (model["type"] == "BPE" and model.get("end_of_word_suffix") and not model.get("dropout")
                 and changes == [("NFC", None, None), ("Replace", {"Regex": "\\s+"}, " "), ("Lowercase", None, None)]
                 and [x["type"] for x in cuts] == ["Split", "ByteLevel"]
                 and (cuts[0]["pattern"].get("Regex"), cuts[0]["behavior"], cuts[0]["invert"]) == _CUTS
                 and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"])
        if not known or spec["post_processor"]:
            return None, None
        plain = Tokenizer(self.tok.model)
        plain.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        ends = np.zeros(1 << 16, bool)
        ends[[i for t, i in model["vocab"].items() if t.endswith(model["end_of_word_suffix"])]] = True
        return plain, ends

    def _ids(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def _learn(self, new: list[str]) -> None:
        """Put the ids of new words into the cache."""
        learnt = [self.pool]

        def keep(part: list[str], ids: np.ndarray, stops: np.ndarray) -> None:
            self.words.update(zip(part, range(len(self.words), len(self.words) + len(part))))
            self.stops = np.concatenate((self.stops, self.stops[-1] + stops))
            learnt.append(ids)

        rest = new
        if self.model is not None:
            rest, ascii_, latin = [], [], []
            for w in new:
                (rest if not w.isalpha() else ascii_ if w.isascii() else latin if max(w) < "\u0100" else rest).append(w)
            for part in [g[i:i + 20_000] for g in (ascii_, latin) for i in range(0, len(g), 20_000)]:
                text = " ".join(part).lower()
                if not text.isascii():
                    text = text.encode().decode("latin-1").translate(_BYTES)
                ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u2")
                at = np.flatnonzero(self.ends[ids]) + 1
                if len(at) != len(part) or at[-1] != len(ids):
                    raise ValueError("the model cuts words of letters")
                keep(part, ids, at)
        for i in range(0, len(rest), 20_000):
            part = rest[i:i + 20_000]
            got = self.tok.encode_batch_fast([" \x00 ".join(part)], add_special_tokens=False)[0].ids
            ids = np.array(got, dtype="<u2")
            mark = ids == self.mark[0]
            at = np.flatnonzero(mark)
            if len(at) != len(part) - 1:
                raise ValueError("the separator is part of a word")
            keep(part, ids[~mark], np.append(at, len(ids)) - np.arange(len(part)))
        self.pool = np.concatenate(learnt)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text and the end id, as little-endian 16-bit numbers."""
        import pyarrow as pa
        ids, n = self.encode_column(pa.array(texts, pa.large_string()))
        return [x.tobytes() for x in np.split(ids, np.cumsum(n)[:-1])]

    def encode_column(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of an Arrow array's texts in a row, the end id behind each, and their number for each text.
        Arrow splits the texts and numbers their distinct words, so that Python looks at each of these once."""
        import pyarrow as pa
        import pyarrow.compute as pc
        texts = texts.fill_null("")
        odd = pc.match_substring_regex(texts, _ODD) if self.split else pa.repeat(True, len(texts))
        rest = pc.filter(texts, odd).to_pylist()
        if rest:
            texts = pc.if_else(odd, "", texts)
        # beyond Latin-1, lower-casing a text may differ from lower-casing each character
        texts = pc.if_else(pc.match_substring_regex(texts, "[^\\x00-\\xff]"), texts, pc.utf8_lower(texts))
        if self.model is not None:  # marks behind a word's last letter or digit are tokens of their own
            texts = pc.replace_substring_regex(texts, _TAIL, "\\1 \\2\\3")
        lists = pc.utf8_split_whitespace(texts)
        coded = pc.dictionary_encode(lists.flatten())
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.words) > CACHE_WORDS:
            self._forget()
        known = np.fromiter(map(self.words.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(known < 0)
        if len(new):
            learn = [words[i] for i in new.tolist()]
            self._learn(learn)
            known[new] = np.fromiter(map(self.words.__getitem__, learn), np.int64, len(new))
        # entries: the distinct words, the end, the texts that went through the library whole with their ends
        whole = [self.end, *(np.array([*self._ids(t), self.end[0]], "<u2") for t in rest)]
        pool = np.concatenate((self.pool, *whole))
        start = np.concatenate((self.stops[known], len(self.pool) + np.cumsum([0, *map(len, whole[:-1])])))
        size = np.concatenate((self.stops[known + 1] - self.stops[known], [len(x) for x in whole]))
        last = np.full(len(texts), len(words), np.int32)
        last[odd.to_numpy(zero_copy_only=False)] = np.arange(len(words) + 1, len(start))
        per_text = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(per_text + 1) - 1
        order = np.empty(len(coded) + len(texts), np.int32)
        inner = np.ones(len(order), bool)
        inner[ends] = False
        order[inner] = coded.indices.to_numpy()
        order[ends] = last
        n = size.take(order)
        stop = np.cumsum(n)
        at = np.repeat(start.take(order) - (stop - n), n)
        at += np.arange(len(at))
        return pool.take(at), np.diff(stop.take(ends), prepend=0)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, end: int) -> Encoder:
    key = f"{path}:{end}"
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, end)
    return _ENCODERS[key]


def _writer(path: str, end: int):
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        file_no, enc = TaskContext.get().partitionId(), encoder(path, end)
        ids, pieces = [], []           # of blocks not yet written
        waiting, row, start, block_no = 0, 0, 0, 0

        def flush(last: bool):
            nonlocal ids, pieces, waiting, start, block_no
            flat = np.concatenate(ids)
            whole = len(flat) if last else len(flat) // codec.BLOCK_IDS * codec.BLOCK_IDS
            blocks = [flat[i:min(i + codec.BLOCK_IDS, whole)] for i in range(0, whole, codec.BLOCK_IDS)]
            table = np.concatenate(pieces)
            ends = np.cumsum(table["n"].astype(np.int64))
            out, first = [], 0
            for k, (b, payload) in enumerate(zip(blocks, codec.encode(blocks))):
                lo, hi = k * codec.BLOCK_IDS, k * codec.BLOCK_IDS + len(b)
                stop = int(np.searchsorted(ends, hi, side="left")) + 1
                own = table[first:stop].copy()
                e = np.minimum(ends[first:stop], hi)
                own["n"] = np.diff(np.concatenate(([lo], e)))
                first = stop if ends[stop - 1] == hi else stop - 1
                out.append((file_no, block_no, codec.frame(start, b, own, payload)))
                block_no += 1
                start += len(b)
            ids = [flat[whole:].copy()]
            rest = table[first:].copy()
            if len(rest):
                rest["n"] = np.diff(np.concatenate(([whole], ends[first:])))
            pieces = [rest]
            waiting = len(flat) - whole
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int32()),
                                               pa.array([x[2] for x in out], pa.binary())], names=["file_no", "block_no", "frame"])

        for batch in batches:
            docs, texts = batch.column(0), batch.column(1)
            null = docs.is_null().to_numpy(zero_copy_only=False)
            docs = docs.fill_null(0).to_numpy(zero_copy_only=False)
            size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            i = 0
            while i < len(docs):
                j = max(i + 1, int(np.searchsorted(size, (size[i - 1] if i else 0) + PART, side="right")))
                flat, n = enc.encode_column(texts.slice(i, j - i))
                ids.append(flat)
                table = np.empty(j - i, codec.PIECE)
                table["row"], table["doc"], table["null"], table["n"] = np.arange(row, row + j - i), docs[i:j], null[i:j], n
                pieces.append(table)
                waiting += len(flat)
                row += j - i
                i = j
                if waiting >= codec.BLOCK_IDS * codec.LANES:
                    yield flush(False)
        if waiting:
            yield flush(True)
    return run


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end: int = END, key: str = "doc_id", text: str = "text") -> None:
    """Write the token files of all rows of ``docs`` under ``path``.

    Rows are in ascending key order over all files (null keys first; equal keys by
    their text's hash).  A null or empty text has the end id alone.  Repeated rows stay
    apart; an empty table writes no frames.
    """
    importable(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))
    order = [F.col("doc").asc_nulls_first(), F.xxhash64("text")]
    # the row number spreads a key that repeats over more than one file
    (rows.withColumn("n", F.monotonically_increasing_id())
     .repartitionByRange(partitions(docs.sparkSession), *order, "n").sortWithinPartitions(*order, "n").drop("n")
     .mapInArrow(_writer(tokenizer, end), "file_no int, block_no int, frame binary").write.parquet(path))


def _reader(batches):
    """Decoded frames as document pieces; every checksum is checked."""
    def work(rows):
        parsed = [codec.parse(f) for _, f in rows]
        ids = codec.decode([p[4] for p in parsed], [p[1] for p in parsed])
        cols: list[list] = [[], [], [], [], [], []]
        for (file_no, _), (start, n, crc, pieces, _), x in zip(rows, parsed, ids):
            raw = x.astype("<u4").tobytes()
            if codec.zlib.crc32(raw) != crc:
                raise ValueError("damaged token block")
            at = 0
            for row, doc, null, k in pieces.tolist():
                for c, v in zip(cols, (file_no, row, None if null else doc, start + at, k,
                                       codec.zlib.crc32(raw[4 * at:4 * (at + k)]))):
                    c.append(v)
                at += k
        cols[2] = pd.array(cols[2], dtype="Int64")  # nulls without a detour over doubles
        return pd.DataFrame(dict(zip(("file_no", "row", "doc", "start", "n", "crc"), cols)))

    held: list = []
    for pdf in batches:
        held += list(zip(pdf["file_no"].tolist(), pdf["frame"].tolist()))
        while len(held) >= codec.LANES:
            yield work(held[:codec.LANES])
            held = held[codec.LANES:]
    if held:
        yield work(held)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc, start (ids of all documents before it), n_tokens, ids_crc32."""
    importable(spark)
    frames = spark.read.schema("file_no int, block_no int, frame binary").parquet(path).select("file_no", "frame")
    # decoding advances up to LANES blocks at once: tasks of about as many (the count comes from the files' footers)
    tasks = max(spark.sparkContext.defaultParallelism, -(-frames.count() // codec.LANES))
    pieces = frames.coalesce(tasks).mapInPandas(
        _reader, "file_no int, row long, doc long, start long, n long, crc long")

    @F.pandas_udf("long")
    def join_crc(parts: pd.Series) -> pd.Series:
        def one(ps):
            crc = int(ps[0]["crc"])
            for p in ps[1:]:
                crc = codec.crc_join(crc, int(p["crc"]), 4 * int(p["n"]))
            return crc
        return pd.Series([one(ps) for ps in parts], dtype="int64")

    # a document's pieces: one for each block of 4096 ids it touches, 24 bytes each
    whole = pieces.groupBy("file_no", "row", "doc").agg(
        F.min("start").alias("at"), F.sum("n").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("start", "n", "crc"))).alias("parts"))
    whole = whole.select("file_no", "doc", "at", "n_tokens", F.when(F.size("parts") == 1, F.col("parts")[0]["crc"])
                         .otherwise(join_crc("parts")).alias("ids_crc32"))
    return whole


def query(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers
    from .common import through_table
    spark = docs.sparkSession
    path = scratch_path(spark, f"token-files-{uuid.uuid4().hex}")
    write_token_files(docs, tokenizer or public_tokenizers.path("word_bpe_49k.json"), path)
    found = through_table(read_token_files(spark, path), "token-index")
    files = found.groupBy("file_no").agg(F.sum("n_tokens").alias("n"))
    before = files.select("file_no", F.coalesce(F.sum("n").over(
        Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return found.join(before, "file_no").select(F.col("doc").alias("doc_id"), (F.col("at") + F.col("before")).alias("start"),
                                                "n_tokens", "ids_crc32")
