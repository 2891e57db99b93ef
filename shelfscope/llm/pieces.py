"""Operator 5, SentencePiece encoding and decoding by a batched numpy Viterbi.

Texts fall into units at spaces (the model's pieces hold a space mark in front
only) and at characters that no piece holds, such as line ends.  Distinct
units are encoded once, in batches: units of equal length advance together,
character by character; a unit is first cut between characters that stand side
by side in no piece, since no piece can reach across, so units share their parts.  Rolling hashes of all substrings probe the sorted hashes of
the pieces of that length (hits are compared in full); at every position the candidates are
scored and the best one is stored as a backpointer.

The model at hand is a BPE model, whose pieces are the outcome of merges in the
order of their scores.  A segmentation is that outcome exactly if each two
neighbouring pieces could not have merged across their border before they
became whole, which depends on the two pieces alone.  So the score of a candidate is
its feasibility after the best piece that ends where it begins: one candidate is
feasible at each position, and the path through the backpointers gives the ids of the
sentencepiece library.  For a unigram model the score is the sum of the pieces' scores.
Unknown characters become byte pieces.  Units that begin with two or more spaces, whose merges
tie, go through the library.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, give_back, importable

SPACE = "▁"
CACHE_UNITS = 150_000  # units and parts of units in a generation, about 200 bytes each; a worker remembers two generations
MEMO = 1 << 20         # pairs of pieces whose feasibility a worker remembers, 9 bytes each
BATCH = 8192           # units that advance together
PART = 1 << 20         # characters cut into units at once
_P, _SALT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_NONE, _START = -9, -2
_CUT = 0xE000  # a private character; units that hold it are not cut


class Pieces:
    """A model's pieces and the tables of their merges."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kinds = pb.ModelProto.SentencePiece
        if model.trainer_spec.model_type not in (pb.TrainerSpec.BPE, pb.TrainerSpec.UNIGRAM):
            raise ValueError("BPE and unigram models only")
        if model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces or \
                not model.normalizer_spec.add_dummy_prefix or not model.trainer_spec.byte_fallback:
            raise ValueError("models with identity normalisation, a space mark in front and byte pieces only")
        self.bpe = model.trainer_spec.model_type == pb.TrainerSpec.BPE
        self.size = len(model.pieces)
        self.text = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.score = np.array([p.score for p in model.pieces] + [0.0])
        self.bytes_id = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.raw = [b"" if p.type == kinds.CONTROL else bytes([int(p.piece[3:5], 16)]) if p.type == kinds.BYTE
                    else p.piece.replace(SPACE, " ").encode() for p in model.pieces]
        if any(SPACE in p.lstrip(SPACE) for p in self.text):
            raise ValueError("pieces with a space inside")
        self.cut = re.compile(r" *[^ \n]+|\n| +" if not any("\n" in p for p in self.text) else r" *[^ ]+| +")
        self.longest = max(map(len, self.text))
        self._merges()
        self._hashes()
        self._borders()
        self.units: dict[str, bytes] = {}  # ids of units and of their parts
        self.older: dict[str, bytes] = {}  # the generation before: what is met again moves up, the rest goes
        self.memo_pair, self.memo_ok = np.full(MEMO, -1, np.int64), np.zeros(MEMO, bool)

    def _merges(self) -> None:
        merged = sorted((p for p in self.text if len(p) > 1), key=lambda p: -self.score[self.text[p]])
        self.rank = np.full(self.size + 1, -1, np.int64)  # single characters come first
        for r, p in enumerate(merged):
            self.rank[self.text[p]] = r
        pairs = {}
        for p in merged:
            for i in range(1, len(p)):
                a, b = self.text.get(p[:i]), self.text.get(p[i:])
                if a is not None and b is not None:
                    pairs[a * (self.size + 1) + b] = self.text[p]
        self.left = np.arange(self.size + 1)
        self.right = np.arange(self.size + 1)
        reachable = set()
        rank, width = self.rank.tolist(), self.size + 1
        for p in self.text:
            parts = [self.text.get(c, -1) for c in p]
            if -1 in parts:
                continue
            last = None
            while len(parts) > 1:
                best = min(((rank[m], i, m) for i, (a, b) in enumerate(zip(parts, parts[1:]))
                            if (m := pairs.get(a * width + b)) is not None), default=None)
                if best is None:
                    break
                _, i, m = best
                last = (parts[i], parts[i + 1])
                parts[i:i + 2] = [m]
            if parts == [self.text[p]]:
                reachable.add(p)
                if last:
                    self.left[parts[0]], self.right[parts[0]] = last
        self.usable = {p: i for p, i in self.text.items() if p in reachable or not self.bpe}
        keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_keys, self.pair_rank = keys, self.rank[[pairs[k] for k in keys.tolist()]]

    def _hashes(self) -> None:
        """All pieces in one table sorted by hash (which the length is mixed into); their characters lie at the right of a row."""
        own = sorted((p, i) for p, i in self.usable.items())
        self.sizes = np.array(sorted({len(p) for p, _ in own}))
        self.power = np.array([pow(int(_P), k, 1 << 64) for k in range(self.longest + 1)], np.uint64)
        self.salt = np.arange(self.longest + 1, dtype=np.uint64) * _SALT
        texts = np.zeros((len(own), self.longest), np.uint32)
        hashes = np.zeros(len(own), np.uint64)
        for r, (p, _) in enumerate(own):
            texts[r, self.longest - len(p):] = np.frombuffer(p.encode("utf-32-le"), np.uint32)
        for k in range(self.longest):
            hashes = hashes * _P + texts[:, k]
        hashes ^= self.salt[[len(p) for p, _ in own]]
        order = np.argsort(hashes)
        self.keys, self.ids, self.texts = hashes[order], np.array([i for _, i in own])[order], texts[order]
        self.single = np.unique(np.array([ord(p) for p, _ in own if len(p) == 1], np.uint32))

    def _borders(self) -> None:
        """The pairs of characters that stand side by side in some piece."""
        shown = [p.replace(SPACE, " ") for p in self.usable]
        pairs = np.array(sorted({(ord(a) << 32) | ord(b) for p in shown for a, b in zip(p, p[1:])}), dtype=np.int64)
        self.side_by_side = pairs
        self.common = np.zeros((512, 512), bool)  # the same for Latin letters, as a table
        a, b = pairs >> 32, pairs & 0xFFFFFFFF
        low = (a < 512) & (b < 512)
        self.common[a[low], b[low]] = True

    def _parts(self, units: list[str]) -> list[list[str]]:
        """Every unit (without line ends) cut where no piece reaches across."""
        codes = np.frombuffer("\n".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        a, b = codes[:-1], codes[1:]
        keep = self.common[np.minimum(a, 511), np.minimum(b, 511)] & (a < 512) & (b < 512)
        rare = np.flatnonzero((a >= 512) | (b >= 512))
        keep[rare] = np.isin((a[rare] << 32) | b[rare], self.side_by_side)
        keep |= (a == 10) | (b == 10)
        marked = np.insert(codes, np.flatnonzero(~keep) + 1, _CUT).astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")
        return [x.split(chr(_CUT)) for x in marked.split("\n")]

    def _found(self, key: np.ndarray) -> np.ndarray:
        """Rank of the piece that two pieces merge into, or a rank beyond all."""
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_rank[at], 1 << 40)

    def feasible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``stays_two``, looked up by pair first; a pair overwrites the one that had its place."""
        pair = a * (self.size + 1) + b
        place = ((pair.view(np.uint64) * _P) >> np.uint64(44)).astype(np.int64) & (MEMO - 1)
        ok = self.memo_ok[place]
        miss = np.flatnonzero(self.memo_pair[place] != pair)
        if len(miss):
            ok[miss] = self.stays_two(a[miss], b[miss])
            self.memo_pair[place[miss]], self.memo_ok[place[miss]] = pair[miss], ok[miss]
        return ok

    def stays_two(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether two neighbouring pieces stay two: undoes the later one's last
        merge, again and again, and looks whether the border would have merged before."""
        width = self.size + 1
        ok = self._found(a * width + b) == 1 << 40
        idx = np.flatnonzero(ok)
        a, b = a[idx], b[idx]
        while len(idx):
            ra, rb = self.rank[a], self.rank[b]
            go = (ra >= 0) | (rb >= 0)
            idx, a, b, ra, rb = idx[go], a[go], b[go], ra[go], rb[go]
            if not len(idx):
                break
            first = ra > rb  # of equal ranks, the left one merged first
            limit = np.where(first, ra, rb + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
            good = self._found(a * width + b) >= limit
            ok[idx[~good]] = False
            idx, a, b = idx[good], a[good], b[good]
        return ok

    def _viterbi(self, units: list[str]) -> list[bytes]:
        """Units of one length -> their ids as little-endian 16-bit numbers."""
        n, count = len(units[0]), len(units)
        codes = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).reshape(count, n)
        h = np.zeros((count, n + 1), np.uint64)
        for k in range(n):
            h[:, k + 1] = h[:, k] * _P + codes[:, k]
        last = np.full((count, n + 1), _NONE, np.int64)
        back = np.zeros((count, n + 1), np.int64)
        best = np.full((count, n + 1), -np.inf)
        last[:, 0], best[:, 0] = _START, 0.0
        wide = np.concatenate((np.zeros((count, self.longest), np.uint32), codes), axis=1)
        column = np.arange(self.longest)
        for j in range(1, n + 1):
            size = self.sizes[self.sizes <= j]
            sub = (h[:, j, None] - h[:, j - size] * self.power[size]) ^ self.salt[size]  # every substring that ends here
            at = np.minimum(np.searchsorted(self.keys, sub), len(self.keys) - 1)
            rows, k = np.nonzero((self.keys[at] == sub) & (last[:, j - size] != _NONE))
            if len(rows):
                at, size = at[rows, k], size[k]
                same = ((wide[rows, j:j + self.longest] == self.texts[at]) | (column < self.longest - size[:, None])).all(axis=1)
                rows, at, size = rows[same], at[same], size[same]  # shorter pieces first; what is written last stays
                piece, i = self.ids[at], j - size
                if self.bpe:
                    ok = np.ones(len(rows), bool)
                    inner = np.flatnonzero(i)
                    ok[inner] = self.feasible(last[rows[inner], i[inner]], piece[inner])
                    rows, piece, size = rows[ok], piece[ok], size[ok]
                    score = np.zeros(len(rows))
                else:
                    score = best[rows, i] + self.score[piece]
                    up = np.argsort(score, kind="stable")  # the maximum is written last, of equal ones the longest piece
                    rows, piece, size, score = rows[up], piece[up], size[up], score[up]
                last[rows, j], back[rows, j], best[rows, j] = piece, size, score
            lost = last[:, j] == _NONE
            if lost.any():  # an unknown character, if nothing else ends here
                known = np.isin(codes[:, j - 1], self.single)
                lost &= ~known
                last[lost, j], back[lost, j] = self.size, 1
                best[lost, j] = best[lost, j - 1] - (0 if self.bpe else 1e6)
        if (last[:, n] == _NONE).any():
            raise ValueError("no segmentation")
        # walk all paths back at once; a step holds the rows that are not yet at their start
        at, rows, steps = np.full(count, n), np.arange(count), []
        while len(rows):
            steps.append((rows, last[rows, at[rows]], at[rows] - 1))
            at[rows] -= back[rows, at[rows]]
            rows = rows[at[rows] > 0]
        rows, found, ends = (np.concatenate(x[::-1]) for x in zip(*steps))
        order = np.argsort(rows, kind="stable")  # by unit; within a unit first things first
        rows, found, ends = rows[order], found[order], ends[order]
        cuts = np.searchsorted(rows, np.arange(count + 1)) * 2
        raw = found.astype("<u2").tobytes()
        out = [raw[i:j] for i, j in zip(cuts.tolist(), cuts[1:].tolist())]
        unknown = found == self.size
        for r in np.unique(rows[unknown]).tolist():  # unknown characters become their bytes
            mine = slice(cuts[r] // 2, cuts[r + 1] // 2)
            ids: list[int] = []
            for piece, end in zip(found[mine].tolist(), ends[mine].tolist()):
                ids += [piece] if piece < self.size else [self.bytes_id[x] for x in units[r][end].encode("utf-8", "surrogatepass")]
            out[r] = np.array(ids, dtype="<u2").tobytes()
        return out

    def _learn(self, new: set[str]) -> None:
        plain, whole = [], []
        for u in new:
            if u.startswith("  ") and self.bpe:
                self.units[u] = np.array(self.library.encode(u[1:], num_threads=1), dtype="<u2").tobytes()
            elif "\n" in u or SPACE in u or chr(_CUT) in u:
                whole.append((u, [u]))
            else:
                plain.append(u)
        if plain:
            whole += zip(plain, self._parts(plain))
        by: dict[int, list[str]] = {}
        for x in self._unknown(set(chain.from_iterable(p for _, p in whole))):
            by.setdefault(len(x), []).append(x)
        for same in by.values():
            # long parts in smaller batches: a batch holds a bounded number of characters
            step = max(1, min(BATCH, (1 << 20) // len(same[0])))
            for i in range(0, len(same), step):
                part = same[i:i + step]
                self.units.update(zip(part, self._viterbi([x.replace(" ", SPACE) for x in part])))
        get = self.units.__getitem__
        self.units.update((u, b"".join(map(get, p))) for u, p in whole if len(p) > 1)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each whole text; null or empty: none."""
        cut, out = [], []
        for t in texts:
            cut.append(self.cut.findall(" " + t) if t else [])
        self._learn(self._unknown(set().union(*cut)))
        get = self.units.__getitem__
        for units in cut:
            out.append(np.frombuffer(b"".join(map(get, units)), "<u2").astype(np.int32))
        if len(self.units) > CACHE_UNITS:
            self.units, self.older = {}, self.units
        return out

    def _unknown(self, units: set[str]) -> set[str]:
        """Those of ``units`` that neither generation knows; what the older one knows moves up."""
        new = units.difference(self.units)
        again = {u for u in new if u in self.older}
        self.units.update((u, self.older[u]) for u in again)
        return new.difference(again)

    def rest(self) -> None:
        """Between tasks: one generation is kept, the rest of the memory goes back."""
        self.older = {}
        give_back()

    def decode(self, ids) -> str:
        """The text of ids: the mark in front goes; bytes that are no UTF-8 become the replacement character."""
        raw = b"".join(map(self.raw.__getitem__, np.asarray(ids, dtype=np.int64).tolist()))
        return raw.removeprefix(b" ").decode("utf-8", "replace")


_MODELS: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    return _MODELS[path]


def model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _encoded(path: str, column: str, check: bool, made: list[str]):
    """Arrow batches with the ids of a text column behind them (and, on demand,
    whether the ids decode to the text); small batches, whatever the input's are."""
    def run(batches):
        import pyarrow as pa
        p = pieces(path)
        for batch in batches:
            at = batch.schema.get_field_index(column)
            i, sizes = 0, batch.column(at).is_null().to_numpy(zero_copy_only=False)
            sizes = np.where(sizes, 0, np.diff(np.frombuffer(batch.column(at).buffers()[1], np.int32)[batch.column(at).offset:][:len(batch) + 1])) \
                if pa.types.is_string(batch.schema.field(at).type) else np.full(len(batch), 4096)
            while i < batch.num_rows:
                j, size = i, 0
                while j < batch.num_rows and (size < PART or j == i):
                    size += int(sizes[j])
                    j += 1
                part = batch.slice(i, j - i)
                texts = part.column(at).to_pylist()
                ids = p.encode(texts)
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                columns = [*part.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*ids, np.zeros(0, np.int32)])))]
                if check:
                    columns.append(pa.array([p.decode(x) == (t or "") for x, t in zip(ids, texts)]))
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, *made])
                i = j
        p.rest()
    return run


def encode_docs(docs: DataFrame, path: str, text: str = "text", name: str = "ids", check: str | None = None) -> DataFrame:
    """Adds the ids (array<int>) of each whole text; null and empty texts have none.
    Columns are kept, whatever their names; one named ``name`` (or ``check``) is replaced.  ``check`` names a column that tells
    whether the ids decode to the text (a null text counts as an empty one).  Each row has its ids, repeated
    rows the same; texts of any length are encoded whole; an empty table gives no rows.  Of equal scores the
    longest last piece stays, as in the library (a BPE model has one feasible piece and no ties)."""
    importable(docs.sparkSession)
    keep = [c for c in docs.columns if c.lower() not in (name.lower(), (check or name).lower())]
    if len({c.lower() for c in [*keep, text]}) > len(keep):
        raise ValueError("the text column would be replaced")
    rows = docs.select(*[F.col(f"`{c}`") for c in keep])
    made = [fresh(rows, "made_ids"), *[fresh(rows, "made_check")] * bool(check)]
    schema = T.StructType([*rows.schema.fields, T.StructField(made[0], T.ArrayType(T.IntegerType())),
                           *[T.StructField(x, T.BooleanType()) for x in made[1:]]])
    out = rows.mapInArrow(_encoded(path, text, bool(check), made), schema)
    return out.toDF(*keep, name, *[check] * bool(check))


def decode_docs(rows: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Adds the text of ids (null ids: null)."""
    importable(rows.sparkSession)

    @F.pandas_udf("string")
    def run(all_ids: pd.Series) -> pd.Series:
        p = pieces(path)
        return pd.Series([None if x is None else p.decode(x) for x in all_ids], dtype=object)

    return rows.withColumn(name, run(F.col(f"`{ids}`")))


def query(docs: DataFrame) -> DataFrame:
    rows = encode_docs(docs.select("doc_id", "text"), model_path(), check="round_trip")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "round_trip")
