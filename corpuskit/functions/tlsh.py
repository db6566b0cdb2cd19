"""Trend locality-sensitive hash (TLSH) of 256 buckets with a three-byte checksum, from the published algorithm; the hexadecimal form of version 4, ``T1`` and 138 digits."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Pearson's table.
_T = np.array(
    [
        int(x)
        for x in """
    1 87 49 12 176 178 102 166 121 193 6 84 249 230 44 163 14 197 213 181 161 85 218 80 64 239 24 226 236 142 38 200
    110 177 104 103 141 253 255 50 77 101 81 18 45 96 31 222 25 107 190 70 86 237 240 34 72 242 20 214 244 227 149 235
    97 234 57 22 60 250 82 175 208 5 127 199 111 62 135 248 174 169 211 58 66 154 106 195 245 171 17 187 182 179 0 243
    132 56 148 75 128 133 158 100 130 126 91 13 153 246 216 219 119 68 223 78 83 88 201 99 122 11 92 32 136 114 52 10
    138 30 48 183 156 35 61 26 143 74 251 94 129 162 63 152 170 7 115 167 241 206 3 150 55 59 151 220 90 53 23 131
    125 173 15 238 79 95 89 16 105 137 225 224 217 160 37 123 118 73 2 157 46 116 9 145 134 228 207 212 202 215 69 229
    27 188 67 124 168 252 42 4 29 108 21 247 19 205 39 203 233 40 186 147 198 192 155 33 164 191 98 204 165 180 117 76
    140 36 210 172 41 54 159 8 185 232 113 196 231 47 146 120 51 65 28 144 254 221 93 189 194 139 112 43 71 109 184 209
    """.split()
    ],
    np.uint8,
)
_LIST = _T.tolist()
BUCKETS, LEAST_BYTES = 256, 50
#: Bytes counted at once; cells of the table of texts that go along in step; texts from which on that is faster than byte by byte.
AT_ONCE, MOST_CELLS, FEW = 1 << 20, 1 << 23, 24
#: (salt, how far back the two other bytes of each triple lie)
_TRIPLES = ((2, 1, 2), (3, 1, 3), (5, 2, 3), (7, 2, 4), (11, 1, 4), (13, 3, 4))


def _length_code(n: int) -> int:
    if n <= 656:
        code = math.log(n) / 0.4054651
    elif n <= 3199:
        code = math.log(n) / 0.26236426 - 8.72777
    else:
        code = math.log(n) / 0.095310180 - 62.5472
    return int(code) & 255


def _checksums(texts: list[np.ndarray]) -> np.ndarray:
    """Of each text three bytes, each folded over all windows; the first's salt is 0, another's is the one before it at that window.

    All texts of a group go along in step, the longest first: one place of all of them at a time. A place that few texts have goes byte by byte.
    """
    out = np.zeros((len(texts), 3), np.uint8)
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    at = 0
    while at < len(order):
        end, widest = at + 1, len(texts[order[at]])
        while end < len(order) and (end - at + 1) * widest <= MOST_CELLS:
            end += 1
        own = [texts[k] for k in order[at:end]]
        sizes = np.array([len(w) for w in own])
        # Where at least FEW texts go on.
        common = int(sizes[FEW - 1]) if len(own) >= FEW else 0
        cells = np.zeros((common, len(own)), np.uint8)
        for k, w in enumerate(own):
            cells[: min(common, len(w)), k] = w[:common]
        values = np.zeros((3, len(own)), np.uint8)
        active = np.searchsorted(-sizes, -np.arange(common), side="left")  # texts with more than so many bytes
        first = _T[0]
        for p in range(4, common):
            n = active[p]
            last, before = cells[p, :n], cells[p - 1, :n]
            salt = first
            for v in values:
                salt = v[:n] = _T[_T[_T[salt ^ last] ^ before] ^ v[:n]]
                salt = _T[salt]
        for k, w in enumerate(own):
            if len(w) > common:
                values[:, k] = _folded(w, max(4, common), values[:, k].tolist())
        out[order[at:end]] = values.T
        at = end
    return out


def _folded(w: np.ndarray, start: int, values: list[int]) -> list[int]:
    """The three bytes of one text, from place ``start`` on."""
    last, before = w[start:], w[start - 1 : -1]
    out = []
    salts = np.zeros(len(last), np.uint8)
    for value in values:
        step = _T[_T[_T[salts] ^ last] ^ before]
        folded = bytearray(len(step))
        for k, x in enumerate(step.tobytes()):
            value = folded[k] = _LIST[x ^ value]
        salts = np.frombuffer(bytes(folded), np.uint8)
        out.append(value)
    return out


def _body(w: np.ndarray) -> tuple[bytes, int] | None:
    """The buckets' codes and the quartiles' ratios."""
    size = len(w) - 4
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, size, AT_ONCE):
        n = min(AT_ONCE, size - at)
        x, a, b = (w[at + 4 - d : at + 4 - d + n] for d in (0, 1, 2))
        c, d = (w[at + 4 - d : at + 4 - d + n] for d in (3, 4))
        back = {1: a, 2: b, 3: c, 4: d}
        for salt, j, k in _TRIPLES:
            counts += np.bincount(_T[_T[_T[_T[salt] ^ x] ^ back[j]] ^ back[k]], minlength=BUCKETS)
    if (counts > 0).sum() <= BUCKETS // 2:
        return None
    q1, q2, q3 = (int(x) for x in np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]])
    if not q3:
        return None
    levels = (counts > q1).astype(int) + (counts > q2) + (counts > q3)
    code = (levels.reshape(-1, 4) << np.array([0, 2, 4, 6])).sum(axis=1)
    return bytes(int(x) for x in code[::-1]), (q1 * 100 // q3 % 16) | (q2 * 100 // q3 % 16) << 4


def hashes(datas: Sequence[bytes | np.ndarray]) -> list[str | None]:
    """Of each the hash, or None where they are too short or too uniform."""
    texts = [np.frombuffer(d, np.uint8) for d in datas]
    bodies = [_body(w) if len(w) >= LEAST_BYTES else None for w in texts]
    good = [k for k, b in enumerate(bodies) if b]
    out: list[str | None] = [None] * len(datas)
    swapped = lambda b: (b & 15) << 4 | b >> 4
    for k, sums in zip(good, _checksums([texts[k] for k in good]).tolist()):
        code, ratios = bodies[k]
        head = [swapped(c) for c in sums] + [swapped(_length_code(len(datas[k]))), swapped(ratios)]
        out[k] = "T1" + (bytes(head) + code).hex().upper()
    return out


def tlsh(data: bytes) -> str | None:
    """The hash, or None for data that are too short or too uniform."""
    return hashes([data])[0]


def _views(texts: pa.Array) -> list[np.ndarray]:
    """The bytes of each, without a copy; none for null."""
    rows = texts.cast(pa.large_binary())
    _, bounds, data = rows.buffers()
    if not len(rows) or data is None:
        return [np.empty(0, np.uint8)] * len(rows)
    ends = np.frombuffer(bounds, np.int64)[rows.offset : rows.offset + len(rows) + 1].tolist()
    whole = np.frombuffer(data, np.uint8)
    return [whole[a:b] if there else whole[:0] for a, b, there in zip(ends, ends[1:], rows.is_valid().to_pylist())]


@F.arrow_udf(StringType())
def tlsh_hash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """``tlsh:`` and the hash of each text's UTF-8 bytes, or null. Texts are read where the Arrow batch has them, so a worker holds the batch and the tables of ``hashes``, whose size doesn't follow it."""
    for texts in batches:
        yield pa.array([f"tlsh:{h}" if h else None for h in hashes(_views(texts))], pa.string())
