"""Adaptive context-mixing range coder for token ids.

Ids are coded in blocks which share nothing: every block starts from the same
empty model, so any block can be decoded alone.  Within a block, each id is
coded with a mixture of three predictions:

* order 2: the id that last followed the last two ids,
* order 1: the id that last followed the last id,
* order 0: the frequencies of the block's ids so far, in buckets that are single
  ids at the low (frequent) end and double in width every 32 buckets.

Orders 2 and 1 get the share of the range that their hit rates in the block so
far deserve; the rest goes to order 0, which gives every id a chance.

Blocks are coded in lockstep: numpy advances the same position of up to
``LANES`` blocks at once.  The coder has a 63-bit range and 16-bit words; carries
are resolved when a block ends.  Only integer arithmetic is used, so every
machine decodes the same.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK_IDS = 4096
LANES = 4096
ENCODED, NEAR = 2048, 128           # lanes encoded at once, and in bulk
MAGIC = b"SSTB\x01\x00\x00\x00"
HEAD = struct.Struct("<8sQIIIII")   # magic, ids before in the file, ids, pieces, crc of ids, crc of pieces, crc of payload
PIECE = np.dtype([("row", "<i8"), ("doc", "<i8"), ("null", "u1"), ("n", "<u4")])

STEP = 8                            # a bucket is found among every so many first
SLOTS = 1024                        # entries of each prediction table
REBUILD = {16, 32, 64, 128}         # the order-0 table follows the counts after so many ids, and then every 256
ONE, TOP = 15, 16                   # bits of the shares of the orders, and of the order-0 table
START2, START1, LEAST, MOST, RATE = 8192, 4096, 64, 31000, 5
_U, _U32 = np.uint64, np.uint32
_FULL, _FLOOR, _BELOW = _U((1 << 63) - 1), _U(1 << 47), _U((1 << 47) - 1)
_WORD, _KEEP, _ALL = _U(16), _U(47), _U(ONE + TOP)


def _buckets():
    """id -> bucket; each bucket's first id and width in bits."""
    first, bits = list(range(64)), [0] * 64
    for octave in range(6, 16):
        width = octave - 5
        for i in range(32):
            first.append((1 << octave) + (i << width))
            bits.append(width)
    first, bits = np.array(first, np.int64), np.array(bits, np.int64)
    return np.repeat(np.arange(len(first)), 1 << bits), first, bits


BUCKET, FIRST, WIDTH = _buckets()
WIDTH_U, FIRST_16 = np.append(WIDTH, 0).astype(np.uint64), np.append(FIRST, 0).astype(np.uint16)  # and of no bucket
BUCKET_16, WIDTH_8 = BUCKET.astype(np.uint16), np.append(WIDTH, 0).astype(np.uint8)
N_BUCKETS = len(FIRST)
ROW = N_BUCKETS + 1


def _slots(last1: np.ndarray, last2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of orders 1 and 2 after these ids."""
    return (last1 * 40503) >> 4 & (SLOTS - 1), ((last1 * 28657) ^ (last2 * 40499)) >> 5 & (SLOTS - 1)


def _rebuild(counts: np.ndarray, cum: np.ndarray) -> None:
    """Shares of 2**TOP, at least 1 for every bucket."""
    total = np.cumsum(counts, axis=1, dtype=np.uint32)
    total *= np.uint32(12)
    total += np.arange(1, ROW, dtype=np.uint32)
    scale = (np.float64((1 << TOP) - N_BUCKETS) * (1 << 8) / total[:, -1:]).astype(np.uint32)  # 8 bits of fraction
    cum[:, 0] = 0
    cum[:, 1:] = ((total * scale) >> np.uint32(8)) + np.arange(1, ROW, dtype=np.uint32)
    cum[:, -1] = 1 << TOP


def _lanes_at(sizes: np.ndarray) -> list[int]:
    """For each position, how many lanes (longest first) reach it."""
    return np.searchsorted(-sizes, -np.arange(int(sizes[0])), side="left").tolist()


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Blocks of 1 to BLOCK_IDS ids below 65536 -> payloads."""
    out: list[bytes] = []
    for part in range(parts := -(-len(blocks) // ENCODED)):
        out += _encode(blocks[len(blocks) * part // parts:len(blocks) * (part + 1) // parts])
    return out


def _follows(ids: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Where an id equals the one that the row's last equal slot held (0 before there was one)."""
    rows, steps = ids.shape
    slots = np.sort(slots.astype(np.uint32) << _U32(12) | np.arange(steps, dtype=np.uint32), axis=1)
    at = (slots & _U32(BLOCK_IDS - 1)) + np.arange(rows)[:, None] * steps
    slots >>= _U32(12)
    x = ids.take(at)
    hit = np.empty((rows, steps), bool)
    hit[:, 0] = x[:, 0] == 0
    hit[:, 1:] = x[:, 1:] == x[:, :-1] * (slots[:, 1:] == slots[:, :-1])
    out = np.empty(rows * steps, bool)
    out[at] = hit
    return out.reshape(rows, steps)


def _hits(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where orders 2 and 1 are right; rows are blocks.  All ids are known, so nothing waits for the id before."""
    last1, last2 = np.zeros((2, *ids.shape), np.int32)
    last1[:, 1:] = ids[:, :-1]
    last2[:, 2:] = ids[:, :-2]
    slot1, slot2 = _slots(last1, last2)
    return _follows(ids, slot2), _follows(ids, slot1)


def _rates(hit: np.ndarray, start: int, held: np.ndarray | None) -> np.ndarray:
    """The rate before each position; it stays where ``held``."""
    goal = hit * np.int16(MOST - LEAST) + np.int16(LEAST)
    moves = None if held is None else held.view(np.int8).astype(np.int16) - np.int16(1)
    out = np.empty((len(hit) + 1, hit.shape[1]), np.int16)
    out[0] = start
    step, rate = np.empty(hit.shape[1], np.int16), np.int16(RATE)
    for t in range(len(hit)):
        np.subtract(goal[t], out[t], out=step)
        np.right_shift(step, rate, out=step)
        if moves is not None:
            np.bitwise_and(step, moves[t], out=step)
        np.add(out[t], step, out=out[t + 1])
    return out[:-1]


def _shares(ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray, rate2: np.ndarray, rate1: np.ndarray):
    """Each id's begin and width in the range, and the bits and place within its bucket; columns are blocks."""
    steps, lanes = ids.shape
    begin, width = (np.empty((steps, lanes), np.uint32) for _ in range(2))
    miss = ~(hit2 | hit1)
    bucket = np.where(miss, BUCKET_16.take(ids), np.uint16(N_BUCKETS))
    bits, place = WIDTH_8.take(bucket), (ids - FIRST_16.take(bucket)) * miss
    counts, cum = np.zeros((lanes, N_BUCKETS), np.int32), np.empty((lanes, ROW), np.int32)
    shares = np.zeros(lanes * ROW + 1, np.uint32)
    lane = np.arange(lanes) * ROW
    turns = [0, *(t for t in range(1, steps) if t in REBUILD or not t % 256), steps]
    for a, b in zip(turns, turns[1:]):
        _rebuild(counts, cum)
        shares[:-1] = cum.ravel()
        at = bucket[a:b] + lane
        base, span = shares.take(at), shares[1:].take(at)
        span -= base
        counts += np.bincount(at.ravel(), minlength=lanes * ROW).reshape(lanes, ROW)[:, :-1]
        w2 = rate2[a:b].astype(np.uint32)
        w1 = ((_U32(1 << ONE) - w2) * rate1[a:b].astype(np.uint32)) >> _U32(ONE)
        before = w2 + w1
        left = _U32(1 << ONE) - before
        h2, h1 = hit2[a:b], hit1[a:b]
        begin[a:b] = np.where(miss[a:b], (before << _U32(TOP)) + left * base, (w2 * h1) << _U32(TOP))
        width[a:b] = np.where(miss[a:b], left * span, np.where(h2, w2, w1) << _U32(TOP))
    return begin, width, bits, place


def _encode(blocks: list[np.ndarray]) -> list[bytes]:
    order = np.argsort([-len(b) for b in blocks], kind="stable")
    sizes = np.array([len(blocks[i]) for i in order], dtype=np.int64)
    lanes, steps = len(blocks), int(sizes[0])
    rows = np.zeros((lanes, steps), np.uint16)
    for lane, i in enumerate(order):
        rows[lane, :len(blocks[i])] = blocks[i]
    ids = np.ascontiguousarray(rows.T)
    hit2, hit1 = (np.empty((steps, lanes), bool) for _ in range(2))
    for i in range(0, lanes, NEAR):  # groups of lanes whose tables stay in the processor's cache
        two, one = _hits(rows[i:i + NEAR])
        hit2[:, i:i + NEAR], hit1[:, i:i + NEAR] = two.T, (one > two).T
    del rows
    rate2, rate1 = _rates(hit2, START2, None), _rates(hit1, START1, hit2)
    begin, width = (np.empty((steps, lanes), np.uint32) for _ in range(2))
    bits, place = np.empty((steps, lanes), np.uint8), np.empty((steps, lanes), np.uint16)
    for i in range(0, lanes, NEAR):
        own = (slice(None), slice(i, i + NEAR))
        begin[own], width[own], bits[own], place[own] = _shares(ids[own], hit2[own], hit1[own], rate2[own], rate1[own])
    del ids, hit2, hit1, rate2, rate1
    words = np.empty((3 * steps + 8) * lanes, np.uint32)  # the lanes' first words, their second, ...: lanes advance much alike
    pos = np.arange(lanes)
    low, rng = np.zeros(lanes, np.uint64), np.full(lanes, _FULL)
    reach = _lanes_at(sizes)
    for a in range(0, steps, 16):
        some = [x[a:a + 16].astype(np.uint64) for x in (begin, width, bits, place)]
        for cum, freq, shift, off, n in zip(*some, reach[a:a + 16]):
            lo, rg, p = low[:n], rng[:n], pos[:n]
            cum, freq, shift, off = cum[:n], freq[:n], shift[:n], off[:n]
            rg >>= _ALL
            cum *= rg
            lo += cum
            rg *= freq
            rg >>= shift
            off *= rg
            lo += off
            # a word is written for every lane, and stays where one is due
            words[p] = (lo >> _KEEP).astype(np.uint32)
            due = (rg < _FLOOR).astype(np.uint64)
            p += due.view(np.int64) * lanes
            keep = due - _U(1)
            keep |= _BELOW
            lo &= keep
            due <<= _U(4)
            lo <<= due
            rg <<= due
            small = np.flatnonzero(rg < _FLOOR)
            while len(small):
                value = lo.take(small)
                q = pos.take(small)
                words[q] = value >> _KEEP
                pos[small] = q + lanes
                lo[small] = (value & _BELOW) << _WORD
                r = rg.take(small) << _WORD
                rg[small] = r
                small = small[r < _FLOOR]
    out: list = [b""] * lanes
    most = pos // lanes
    words = words.reshape(-1, lanes)[:most.max()]
    for lane, i in enumerate(order):
        if not lane % NEAR:
            near = np.ascontiguousarray(words[:, lane:lane + NEAR].T)
        end = int(low[lane])
        w = np.concatenate((near[lane % NEAR, :most[lane]], [end >> 47, (end >> 31) & 0xFFFF, (end >> 15) & 0xFFFF,
                                                          (end << 1) & 0xFFFF])).astype(np.int64)
        while (over := np.flatnonzero(w[1:] >> 16)).size:  # carries go into the word before
            carry = w[over + 1] >> 16
            w[over + 1] &= 0xFFFF
            w[over] += carry
        out[i] = w.astype("<u2").tobytes()
    return out


def decode(payloads: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for i in range(0, len(payloads), LANES):
        out += _decode(payloads[i:i + LANES], sizes[i:i + LANES])
    return out


def _decode(payloads: list[bytes], n_ids: list[int]) -> list[np.ndarray]:
    order = np.argsort([-n for n in n_ids], kind="stable")
    sizes = np.array([n_ids[i] for i in order], dtype=np.int64)
    lanes, steps = len(payloads), int(sizes[0])
    words = np.zeros((max(map(len, payloads)) // 2 + 4, lanes), "<u2")  # the lanes' first words, their second, ...
    for i in range(0, lanes, NEAR):
        parts = [np.frombuffer(payloads[k], "<u2") for k in order[i:i + NEAR]]
        near = np.zeros((len(parts), max(map(len, parts))), "<u2")
        for k, x in enumerate(parts):
            near[k, :len(x)] = x
        words[:near.shape[1], i:i + NEAR] = near.T
    code = np.zeros(lanes, np.uint64)  # 63 bits are in the coder, the last one waits
    for x in words[:4]:
        code = code << _WORD | x
    words = words.reshape(-1)
    pos = np.arange(lanes) + 4 * lanes
    rng = np.full(lanes, _FULL)
    lane = np.arange(lanes)
    slots, rows = lane * SLOTS, lane * N_BUCKETS
    one, two = (np.zeros(lanes * SLOTS, np.uint16) for _ in range(2))
    rate2, rate1 = np.full(lanes, START2, np.int32), np.full(lanes, START1, np.int32)
    last1, last2 = (np.zeros(lanes, np.int32) for _ in range(2))
    # of the order-0 table, 2**TOP is 0 here, the begin of the next row; every STEP-th entry also lies in a row of its own
    counts, cum = np.zeros((lanes, N_BUCKETS), np.int32), np.zeros(lanes * N_BUCKETS + 1, np.uint16)
    coarse = np.empty((N_BUCKETS // STEP - 1, lanes), np.uint16)
    seen = np.empty((256, lanes), np.uint16)  # buckets since the table was built; N_BUCKETS: another order was right
    built = 0
    ids = np.zeros((steps, lanes), np.uint16)
    for t, n in enumerate(_lanes_at(sizes)):
        if t in REBUILD or not t % 256:
            for i in range(0, n, NEAR):
                j = min(i + NEAR, n)
                if t:
                    own = seen[:t - built, i:j] + np.arange(j - i, dtype=np.int32) * ROW
                    counts[i:j] += np.bincount(own.ravel(), minlength=(j - i) * ROW).reshape(j - i, ROW)[:, :-1]
                table = np.empty((j - i, ROW), np.int32)
                _rebuild(counts[i:j], table)
                table = table[:, :-1].astype(np.uint16)
                cum[i * N_BUCKETS:j * N_BUCKETS] = table.ravel()
                coarse[:, i:j] = table[:, STEP::STEP].T
            built = t
        cd, rg, p = code[:n], rng[:n], pos[:n]
        s1, s2 = (s + slots[:n] for s in _slots(last1[:n], last2[:n]))
        c1, c2 = one.take(s1), two.take(s2)
        w2, r1 = rate2[:n], rate1[:n]
        w1 = ((1 << ONE) - w2) * r1
        w1 >>= ONE
        rg >>= _ALL
        twice = rg << _U(1)
        value = (cd // twice).astype(np.int32)
        share = value >> TOP
        before = w2 + w1
        hit2, miss = share < w2, share >= before
        # order 0 for every lane: where another order is right, its outcome is dropped
        left = (1 << ONE) - before
        before <<= TOP
        value -= before
        inner = (value.view(np.uint32) // left.view(np.uint32)).astype(np.uint16)
        at = np.add.reduce((coarse[:, :n] <= inner).view(np.uint8), axis=0, dtype=np.uint8) * np.int64(STEP)
        at += rows[:n]
        step = STEP // 2
        while step:
            at += (cum[step:].take(at) <= inner) * step
            step //= 2
        base = cum.take(at)
        span = cum[1:].take(at) - base
        at -= rows[:n]
        b = np.where(miss, at, N_BUCKETS)
        seen[t - built, :n] = b
        before += left * base
        begin = np.where(miss, before, np.where(hit2, 0, w2 << TOP))
        width = np.where(miss, left * span, np.where(hit2, w2, w1) << TOP)
        twice *= begin.astype(np.uint64)
        cd -= twice
        rg *= width.astype(np.uint64)
        rg >>= WIDTH_U.take(b)
        np.left_shift(rg, _U(1), out=twice)
        below = cd // twice
        twice *= below
        cd -= twice
        x = np.where(miss, FIRST_16.take(b) + below.astype(np.uint16), np.where(hit2, c2, c1))
        # the next word is read for every lane, and goes in where one is due
        due = (rg < _FLOOR).astype(np.uint64)
        word = words.take(p) * due
        p += due.view(np.int64) * lanes
        due <<= _U(4)
        cd <<= due
        cd |= word
        rg <<= due
        small = np.flatnonzero(rg < _FLOOR)
        while len(small):
            q = pos.take(small)
            cd[small] = cd.take(small) << _WORD | words.take(q)
            pos[small] = q + lanes
            r = rg.take(small) << _WORD
            rg[small] = r
            small = small[r < _FLOOR]
        one[s1] = x
        two[s2] = x
        hit1 = ~(hit2 | miss)
        move = hit1 * np.int32(MOST - LEAST)
        move += LEAST
        move -= r1
        move >>= RATE
        move *= ~hit2
        r1 += move
        move = hit2 * np.int32(MOST - LEAST)
        move += LEAST
        move -= w2
        move >>= RATE
        w2 += move
        last2[:n] = last1[:n]
        last1[:n] = x
        ids[t, :n] = x
    out: list = [None] * lanes
    for lane, i in enumerate(order):
        if not lane % NEAR:
            near = ids[:, lane:lane + NEAR].T.astype(np.int32)
        out[i] = near[lane % NEAR, :sizes[lane]]
    return out


# ---- frames: a block with its header, document pieces and checksums ----

def crc_of(ids: np.ndarray, crc: int = 0) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes(), crc)


def frame(start: int, ids: np.ndarray, pieces: np.ndarray, payload: bytes) -> bytes:
    p = pieces.astype(PIECE).tobytes()
    return HEAD.pack(MAGIC, start, len(ids), len(pieces), crc_of(ids), zlib.crc32(p), zlib.crc32(payload)) + p + payload


def parse(data: bytes):
    """(ids before, ids, crc of ids, pieces, payload); raises on a damaged header, piece table or payload."""
    magic, start, n, k, crc, crc_p, crc_b = HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a token block")
    at = HEAD.size + k * PIECE.itemsize
    table, payload = data[HEAD.size:at], data[at:]
    if zlib.crc32(table) != crc_p or zlib.crc32(payload) != crc_b:
        raise ValueError("damaged token block")
    return start, n, crc, np.frombuffer(table, PIECE), payload


_POLY = 0xEDB88320


def _times(a: int, b: int) -> int:
    """a * b modulo the CRC-32 polynomial, bits reflected."""
    p, m = 0, 1 << 31
    while m:
        if a & m:
            p ^= b
        m >>= 1
        b = (b >> 1) ^ _POLY if b & 1 else b >> 1
    return p


_POWERS: dict[int, int] = {}


def crc_join(first: int, second: int, n_bytes: int) -> int:
    """The crc32 of two strings joined, from theirs and the second's length."""
    if n_bytes not in _POWERS:
        x, base, n = 1 << 31, 1 << 23, n_bytes  # one; x^8, a byte's shift
        while n:
            if n & 1:
                x = _times(x, base)
            base = _times(base, base)
            n >>= 1
        if len(_POWERS) > 10_000:
            _POWERS.clear()
        _POWERS[n_bytes] = x
    return _times(_POWERS[n_bytes], first) ^ second
