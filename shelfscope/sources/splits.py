"""Files larger than a task: one JSON document, or CSV rows with positions, read by many tasks.

Spark's text source cuts a file into splits at a separator: ``}`` for a JSON document (an element ends there), the line end for
CSV.  What a split's bytes mean depends on what came before it: whether it starts inside a string, how deep, after how many
rows.  So one pass over the files writes their text to the shared folder, each piece with its state relative to the start of its
split for both cases of the quote state (brackets' depth and its minimum; number of rows).  The last piece of a split is the split's
summary; summaries, one row a split, are combined in file order on the driver, which lists as many splits to plan a scan.
Then every piece knows its start, and elements or rows come out of the written table in any order and number of tasks; those
that run over the end of a piece are put together by one small aggregate.  The sources are read once.

Nothing reads a file as a whole.  A compressed file that Spark can't split is one split.  A gzip document's start is
known, so its elements come straight out of one stream over it, and its text is not written again.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

OPEN, CLOSE, QUOTE = 1, -1, 2
_KIND = np.zeros(256, np.int64)
_KIND[[ord("{"), ord("[")]], _KIND[[ord("}"), ord("]")]], _KIND[ord('"')] = OPEN, CLOSE, QUOTE


def _text(spark: SparkSession, paths: str | Sequence[str], separator: str | None = None) -> DataFrame:
    r = spark.read
    if separator is not None:
        r = r.option("lineSep", separator)
    return r.text(paths if isinstance(paths, str) else list(paths)).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: later steps see these splits, whatever the cluster's size or settings become."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """The batch's rows by split: ((path, block), values)."""
    if not batch.num_rows:
        return
    path = batch.column(1).dictionary_encode()
    at, block = path.indices.to_numpy(), batch.column(2).to_numpy()
    cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]) | (block[1:] != block[:-1])) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield (path.dictionary[int(at[a])].as_py(), int(block[a])), batch.column(0).slice(a, b - a)


def _by_split(batches, begin: Callable, step: Callable, end: Callable):
    """Streams the rows of a task split by split: begin(split) -> state, step(state, values) and end(state) -> rows to hand on."""
    now, state = None, None
    for batch in batches:
        for split, values in _runs(batch):
            if split != now:
                if now is not None:
                    yield from end(state)
                now, state = split, begin(split)
            yield from step(state, values)
    if now is not None:
        yield from end(state)


# ---------------------------------------------------------------------------
# one JSON document

def _bytes(values: pa.Array) -> np.ndarray:
    """The split's bytes again, each row followed by the separator (behind a file's last row one too many, which no element sees)."""
    v = values.cast(pa.large_binary())
    ends = np.frombuffer(v.buffers()[1], np.int64)[v.offset:v.offset + len(v) + 1]
    raw = np.frombuffer(v.buffers()[2], np.uint8) if v.buffers()[2] is not None else np.zeros(0, np.uint8)
    return np.insert(raw[ends[0]:ends[-1]], ends[1:] - ends[0], ord("}"))


def _events(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Places and kinds of brackets, the number of quotes before each, and the number of all quotes.  A row starts
    behind a ``}``, which nothing escapes, so escapes never reach over its start."""
    at = np.flatnonzero(_KIND[data])
    kind = _KIND[data[at]]
    quotes = kind == QUOTE
    maybe = np.flatnonzero(quotes & (at > 0) & (data[at - 1] == 92))
    for i in maybe.tolist():
        j = k = int(at[i])
        while k > 0 and data[k - 1] == 92:
            k -= 1
        quotes[i] = (j - k) % 2 == 0
    seen = np.cumsum(quotes)
    real = kind != QUOTE
    return at[real], kind[real], seen[real], int(seen[-1]) if len(seen) else 0


JSON_TABLE = ("path string, block long, seq long, offset long, quotes long, r array<long>, low array<long>, after array<long>, "
              "end struct<flips:boolean,delta:array<long>,low:array<long>,found:array<long>,depth:array<long>,after:array<long>>, data binary")
_FAR = 1 << 60


def _json_pieces(key: str | None):
    """Pieces of a split (one a batch): their bytes, the state at their start relative to the split's start, and the
    summary of the split up to their end; lists hold a value for a split that starts outside a string, and one inside."""
    opening = re.compile(rb"\A(?:\xef\xbb\xbf)?\s*\[" if key is None else re.escape(f'"{key}"'.encode()) + rb"\s*:\s*\[")

    def begin(split):
        return {"split": split, "seq": 0, "quotes": 0, "offset": 0, "r": [0, 0], "low": [0, 0], "found": [-1, -1], "depth": [_FAR, _FAR], "after": [_FAR, _FAR]}

    def step(s, values):
        data = _bytes(values)
        raw = data.tobytes()
        row = {"path": s["split"][0], "block": s["split"][1], "data": raw} | {
            k: list(s[k]) if isinstance(s[k], list) else s[k] for k in ("seq", "offset", "quotes", "r", "low", "after")}
        at, kind, seen, quotes = _events(data)
        opened = [m.end() - 1 for m in opening.finditer(raw)] if key is not None or s["offset"] + s["split"][1] == 0 else []
        for h in (0, 1):
            outside = (seen + s["quotes"] + h) % 2 == 0
            r = s["r"][h] + np.cumsum(np.where(outside, kind, 0))
            if not len(r):
                continue
            s["low"][h] = min(s["low"][h], int(r.min()))
            s["after"][h] = min(s["after"][h], int(r.min()))
            for p in opened:  # the array at the least depth is the document's own; deeper ones of that name lie in elements
                e = int(np.searchsorted(at, p))
                if outside[e] and int(r[e]) - 1 < s["depth"][h]:
                    s["found"][h], s["depth"][h], s["after"][h] = s["offset"] + p, int(r[e]) - 1, int(r[e:].min())
            s["r"][h] = int(r[-1])
        s["quotes"] += quotes
        s["offset"] += len(data)
        s["seq"] += 1
        row["end"] = {"flips": s["quotes"] % 2 == 1, "delta": s["r"]} | {k: list(s[k]) for k in ("low", "found", "depth", "after")}
        longs = pa.list_(pa.int64())
        schema = pa.schema([("path", pa.string()), *((k, pa.int64()) for k in ("block", "seq", "offset", "quotes")), *((k, longs) for k in ("r", "low", "after")),
                            ("end", pa.struct([("flips", pa.bool_()), *((k, longs) for k in ("delta", "low", "found", "depth", "after"))])), ("data", pa.binary())])
        yield pa.RecordBatch.from_pylist([row], schema)
    return lambda batches: _by_split(batches, begin, step, lambda s: ())


def _json_starts(rows, base: int) -> dict[tuple[str, int], tuple[int, int, bool, int]]:
    """In which state each split starts: inside a string, depth, inside the array; and the place of the array's
    start if that lies in this split, else -1."""
    out, path = {}, None
    h = depth = inside = done = None

    def finish():
        if path is not None and (inside or depth > 0):
            raise ValueError(f"the document ends inside a value: {path}")
    for r in sorted(rows, key=lambda r: (r.path, r.block)):
        if r.path != path:
            finish()
            path, h, depth, inside, done = r.path, 0, 0, False, False
        e, low, opened = r.end, depth + r.end.low[h], -1
        was = inside
        if not inside and not done and e.found[h] >= 0 and depth + e.depth[h] == base - 1:
            opened, inside, low = e.found[h], True, depth + e.after[h]
        out[r.path, r.block] = (h, depth, was, opened)
        if inside and low < base:
            inside, done = False, True
        depth += e.delta[h]
        h ^= int(e.flips)
    finish()
    return out


def _json_of(starts: dict, base: int, path, block, offset, quotes, r, low, after, raw):
    """A piece's whole elements, and the parts of those that run over one of its ends, numbered 0
    where the element begins and -1 else: an end comes before the next beginning."""
    h, depth, inside, opened = starts[path, block]
    data = np.frombuffer(raw, np.uint8)
    at, kind, seen, _ = _events(data)
    outside = (seen + quotes + h) % 2 == 0
    at, kind = at[outside], kind[outside]
    if inside:
        inside = depth + low[h] >= base
    elif 0 <= opened < offset:
        inside = depth + after[h] >= base
    start = depth + r[h]
    depths = start + np.cumsum(kind)
    first = 0
    if not inside and offset <= opened < offset + len(data):
        first, inside, start = int(np.searchsorted(at, opened - offset, side="right")), True, base
    if not inside:
        return [], []
    left = np.flatnonzero(depths[first:] < base)
    last = first + int(left[0]) if len(left) else len(at)
    a, k, d = at[first:last], kind[first:last], depths[first:last]
    opens, ends = a[(k == OPEN) & (d == base + 1)].tolist(), (a[(k == CLOSE) & (d == base)] + 1).tolist()
    parts = []
    if start > base:  # an element from before
        parts.append((-1, raw[:ends[0]] if ends else raw))
        ends = ends[1:]
    if len(opens) > len(ends):
        parts.append((0, raw[opens[-1]:]))
    return [raw[i:j] for i, j in zip(opens, ends)], parts


def _json_elements(starts: dict, base: int, pieces: bool):
    """Whole elements of each piece, or (``pieces``) the parts of those that run over one of its ends."""
    def run(batches):
        for b in batches:
            for path, block, seq, offset, quotes, r, low, after, raw in zip(*(c.to_pylist() for c in b.columns)):
                whole, parts = _json_of(starts, base, path, block, offset, quotes, r, low, after, raw)
                got = parts if pieces else [(0, x) for x in whole]
                if got:
                    n = len(got)
                    yield pa.RecordBatch.from_arrays([pa.array([path] * n), pa.array([block] * n, pa.int64()), pa.array([seq] * n, pa.int64()),
                                                      pa.array([p for p, _ in got], pa.int32()), pa.array([x for _, x in got], pa.binary())],
                                                     names=["path", "block", "seq", "part", "element"])
    return run


_ONE_SPLIT = r"\.(gz|deflate)$"


def _json_streamed(key: str | None, base: int):
    """The elements of documents of one split each, in one pass: pieces as ``_json_pieces`` gives them, each looked at when it comes."""
    pieces = _json_pieces(key)

    def elements(path, got):
        return pa.RecordBatch.from_arrays([pa.array([path] * len(got)), pa.array(got, pa.binary())], names=["path", "element"])

    def run(batches):
        path, row, part = None, None, []

        def finish():
            if path is None:
                return
            _json_starts([Row(path=path, block=0, end=Row(**row["end"]))], base)  # one that ends inside a value fails
            if part:
                yield elements(path, [b"".join(part)])
        for b in pieces(batches):
            now = b.to_pylist()[0]
            if now["path"] != path:
                yield from finish()
                path, part = now["path"], []
            row, end = now, now["end"]
            opened = end["found"][0] if end["depth"][0] == base - 1 else -1
            whole, parts = _json_of({(path, 0): (0, 0, False, opened)}, base, *(row[k] for k in ("path", "block", "offset", "quotes", "r", "low", "after", "data")))
            for begins, text in parts:  # an end comes before the next beginning
                if begins == 0 and part:
                    whole.append(b"".join(part))
                    part = []
                part.append(text)
            if whole:
                yield elements(path, whole)
        yield from finish()
    return run


def json_elements(spark: SparkSession, paths: str | Sequence[str], key: str | None) -> DataFrame:
    """The objects and arrays in the array under the top-level ``key`` of each document (``key`` None: the document is the
    array), one row each: path and element (JSON text).  A document is one file of any size and layout; one without the key, and
    an empty one, give no rows; elements that are plain values are left out; of a repeated key the first array
    counts.  A document that ends inside a value fails.  The pass over the text runs when this is called; gzip documents, a split
    each, are streamed through once whenever the rows are read."""
    if key is not None and re.search(r'["\\}]', key):
        raise ValueError("keys with quotes, backslashes or closing braces are not supported")
    base = 1 if key is None else 2
    source = _text(spark, paths, "}")
    kinds = {bool(re.search(_ONE_SPLIT, f.lower())) for f in source.inputFiles()}
    plain, zipped = source, source
    if len(kinds) == 2:
        plain, zipped = (source.where(F.lower("path").rlike(_ONE_SPLIT) == x) for x in (False, True))
    streamed = (zipped.mapInArrow(_json_streamed(key, base), "path string, element binary")
                .select("path", F.col("element").cast("string").alias("element")))
    if kinds == {True}:
        return streamed
    table = _written(plain.mapInArrow(_json_pieces(key), JSON_TABLE), "json-pieces")
    starts = _json_starts(table.groupBy("path", "block").agg(F.max_by("end", "seq").alias("end")).collect(), base)
    rows = table.select("path", "block", "seq", "offset", "quotes", "r", "low", "after", "data")
    schema = "path string, block long, seq long, part int, element binary"
    text = F.col("element").cast("string").alias("element")
    parts = rows.mapInArrow(_json_elements(starts, base, True), schema)
    # two parts a piece at most: an element's parts follow each other in file order
    in_file = Window.partitionBy("path").orderBy("block", "seq", "part")
    parts = (parts.select("path", "block", "seq", "part", text, F.sum(F.col("part") + 1).over(in_file).alias("nth"))
             .groupBy("path", "nth").agg(F.sort_array(F.collect_list(F.struct("block", "seq", "element"))).alias("parts")))
    out = (rows.mapInArrow(_json_elements(starts, base, False), schema).select("path", text)
           .union(parts.select("path", F.array_join(F.transform("parts", lambda p: p["element"]), ""))))
    return out.union(streamed) if True in kinds else out


# ---------------------------------------------------------------------------
# CSV rows with positions

def quoted_after(line: str, quoted: bool, sep: str = ",", quote: str = '"', escape: str = "\\") -> bool:
    """Whether a quoted field is open at the end of ``line``, given whether one is at its start.  A quote opens a field
    only as its first character; the first one that is not escaped ends it, and the field runs to the next separator
    (``escape`` equal to ``quote``: doubled quotes are part of the field)."""
    i = 0
    while True:
        if quoted:
            j = i
            while True:
                q = line.find(quote, j)
                if q < 0:
                    return True
                if escape == quote:
                    if line.startswith(quote, q + 1):
                        j = q + 2
                        continue
                    break
                k = q
                while k > i and line[k - 1] == escape:
                    k -= 1
                if (q - k) % 2 == 0:
                    break
                j = q + 1
            i, quoted = q + 1, False
        elif line.startswith(quote, i):
            i, quoted = i + 1, True
            continue
        i = line.find(sep, i)
        if i < 0:
            return False
        i += 1


CSV_TABLE = "path string, block long, nth long, rows array<long>, before array<boolean>, after array<boolean>, line string"


def _csv_lines(options: dict):
    """Every line with the number of rows begun up to it since its split's start and whether a quoted field is open
    before and after it, for a split that starts outside a quoted field, and inside one."""
    quote = options.get("quote", '"')

    def begin(split):
        return {"split": split, "nth": 0, "quoted": [False, True], "rows": [0, 0]}

    def pairs(a, b, kind):
        return pa.FixedSizeListArray.from_arrays(pa.array(np.stack([a, b], axis=1).ravel()), 2).cast(pa.list_(kind))

    def step(s, values):
        n = len(values)
        full = pc.greater(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
        special = np.flatnonzero(pc.match_substring(values, quote).to_numpy(zero_copy_only=False)).tolist()
        lines = [values[i].as_py() for i in special]
        before, after, rows = np.zeros((2, n), bool), np.zeros((2, n), bool), np.zeros((2, n), np.int64)
        for h in (0, 1):
            at, q = 0, s["quoted"][h]
            for i, line in zip(special, lines):  # the state holds up to the next line with a quote
                before[h, at:i + 1] = q
                after[h, at:i] = q
                q = quoted_after(line, q, **options)
                after[h, i], at = q, i + 1
            before[h, at:], after[h, at:], s["quoted"][h] = q, q, q
            rows[h] = s["rows"][h] + np.cumsum(full & ~before[h])
            s["rows"][h] = int(rows[h, -1])
        path, block = s["split"]
        yield pa.RecordBatch.from_arrays([pa.array([path], pa.string()).take(pa.array(np.zeros(n, np.int64))), pa.array(np.full(n, block)), pa.array(s["nth"] + np.arange(n)),
                                          pairs(*rows, pa.int64()), pairs(*before, pa.bool_()), pairs(*after, pa.bool_()), values.cast(pa.string())],
                                         names=["path", "block", "nth", "rows", "before", "after", "line"])
        s["nth"] += n
    return lambda batches: _by_split(batches, begin, step, lambda s: ())


class CsvFiles:
    """CSV files cut into splits: the first rows of each, its number of rows, and all rows with 1-based positions.

    Rows are lines, or several where a quoted field goes over line ends (joined by a line feed); blank lines are no
    rows, as in Spark's reader.  Building it runs the pass over the text and reads back one row a split and ``heads`` rows a file.
    ``options``: sep, quote, escape, with Spark's defaults."""

    def __init__(self, spark: SparkSession, paths: str | Sequence[str], heads: int = 1, **options):
        self.spark, self.options = spark, options
        table = _written(_text(spark, paths).mapInArrow(_csv_lines(options), CSV_TABLE), "csv-lines")
        splits = table.groupBy("path", "block").agg(F.max_by(F.struct("rows", "after"), "nth").alias("end"),
                                                    F.max(F.array_contains("after", True)).alias("opens")).collect()
        starts, quoted, path = [], False, None
        self.rows: dict[str, int] = {}
        for r in sorted(splits, key=lambda r: (r.path, r.block)):
            if r.path != path:
                path, quoted, self.rows[r.path] = r.path, False, 0
            starts.append((path, r.block, int(quoted), self.rows[path]))
            self.rows[path] += r.end["rows"][int(quoted)]
            quoted = r.end["after"][int(quoted)]
        # one row a split
        starts = F.broadcast(spark.createDataFrame(starts, "path string, block long, h int, base long"))
        of = lambda c: F.col(c)[F.col("h")]
        lines = (table.join(starts, ["path", "block"]).select(
            "path", (F.col("base") + of("rows")).alias("pos"), "block", "nth", "line", of("before").alias("before"), of("after").alias("after")))
        self.lines = lines.where("NOT before AND NOT after AND line <> ''").select("path", "pos", "line")
        if any(r.opens for r in splits):  # some row may have several lines
            several = (lines.where("before OR after").groupBy("path", "pos")
                       .agg(F.sort_array(F.collect_list(F.struct("block", "nth", "line"))).alias("parts")))
            self.lines = self.lines.union(several.select("path", "pos", F.array_join(F.transform("parts", lambda p: p["line"]), "\n")))
        first: dict[str, dict[int, str]] = {p: {} for p in self.rows}
        # a file's first rows begin in its first split unless that holds fewer; the positions tell
        for r in self.lines.where(F.col("pos") <= heads).collect():
            first[r.path][r.pos] = r.line
        self.head = {p: tuple(v[k] for k in sorted(v)) for p, v in first.items()}

    def layouts(self) -> dict[tuple[str, ...], list[str]]:
        """First rows -> the files that have them."""
        out: dict[tuple[str, ...], list[str]] = {}
        for path, head in self.head.items():
            out.setdefault(head, []).append(path)
        return {k: sorted(v) for k, v in sorted(out.items())}

    def read(self, files: Sequence[str], schema: str, skip: int = 0, footer: int = 0) -> DataFrame:
        """The fields of all rows of ``files`` but the first ``skip`` and the last ``footer`` of each, with file_name, path and pos."""
        about = [(f, unquote(f).rsplit("/", 1)[-1], self.rows[f]) for f in files]  # one row a file
        about = self.spark.createDataFrame(about, "path string, file_name string, n_rows long")
        rows = self.lines.join(F.broadcast(about), "path").where((F.col("pos") > skip) & (F.col("pos") <= F.col("n_rows") - footer))
        return rows.select("file_name", "path", "pos", F.from_csv("line", schema, self.options).alias("r")).select("r.*", "file_name", "path", "pos")


def first_lines(spark: SparkSession, paths: str | Sequence[str]) -> dict[str, list[str]]:
    """The first line that is not blank of every file -> the files that have it.  Files come from the listing; of each, one
    short job reads the beginning of the first split and stops, several at a time.  Files without such a line are left out."""
    listed = sorted(spark.read.text(paths if isinstance(paths, str) else list(paths)).inputFiles())

    def head(path: str):
        got = spark.read.text(unquote(path)).where("value <> '' AND _metadata.file_block_start = 0").take(1)
        return got[0].value if got else None

    out: dict[str, list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for path, line in zip(listed, pool.map(head, listed)):
            if line is not None:
                out.setdefault(line, []).append(path)
    return dict(sorted(out.items()))
