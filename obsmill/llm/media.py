"""Media columns: baseline JPEG, its DC-only luminance thumbnails, and their hashes.

``read`` parses markers, Huffman-decodes the scan and reconstructs the luminance thumbnail of one sample an
8 x 8 block from the DC coefficients, for any baseline image (subsampling, restart intervals, AC coefficients).
Restart segments are decoded in lockstep, a numpy operation for all of them at once. ``write`` stores samples
as an image whose blocks are flat, so that its thumbnail is the samples: a lossless store of bytes.

Defined results: null text is the empty text, one block of padding. Texts over 341 tiles of 576 bytes take
several images, one after the other. Equal texts give equal values. Repeated rows and ids are each stored; an
empty table gives no rows. A file that isn't baseline JPEG raises ValueError.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from obsmill.llm import textnum

SIDE = 24  # blocks a row and restart segment; a tile is SIDE x SIDE samples
TILE = SIDE * SIDE
MOST_TILES = 341  # a JPEG has 65,535 lines at the most
STEP = 8  # the quantiser of DC coefficients: one step is one grey level
#: Our DC table: the categories with codes of three and of four bits. The AC table has only the end of block, one bit.
DC_LENGTHS = {4: 3, 5: 3, 6: 3, 0: 4, 1: 4, 2: 4, 3: 4, 7: 4, 8: 4}
_NEXT = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]")


def _codes(counts: list[int]) -> list[tuple[int, int]]:
    """(code, length) of each symbol of a table given by its counts a length."""
    out, code = [], 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            out.append((code, length))
            code += 1
        code <<= 1
    return out


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _table_body(kind: int, lengths: dict[int, int]) -> bytes:
    counts = [sum(n == k for n in lengths.values()) for k in range(1, 17)]
    return bytes([kind, *counts, *sorted(lengths, key=lambda s: (lengths[s], s))])


def header(tiles: int) -> bytes:
    return b"".join((
        b"\xff\xd8",
        _segment(0xDB, bytes([0, STEP, *[1] * 63])),
        _segment(0xC0, struct.pack(">BHHB3B", 8, tiles * SIDE * 8, SIDE * 8, 1, 1, 0x11, 0)),
        _segment(0xC4, _table_body(0x00, DC_LENGTHS) + _table_body(0x10, {0: 1})),
        _segment(0xDD, struct.pack(">H", SIDE)),
        _segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0])),
    ))


@lru_cache
def _words() -> tuple[np.ndarray, np.ndarray]:
    """For each difference + 255: the bits of a block (DC code, DC bits, end of block) and their number."""
    symbols = sorted(DC_LENGTHS, key=lambda s: (DC_LENGTHS[s], s))
    codes = dict(zip(symbols, _codes([sum(n == k for n in DC_LENGTHS.values()) for k in range(1, 17)]), strict=True))
    word, size = np.zeros(511, np.uint32), np.zeros(511, np.int64)
    for d in range(-255, 256):
        category = abs(d).bit_length()
        code, length = codes[category]
        word[d + 255] = ((code << category) | (d if d >= 0 else d + (1 << category) - 1)) << 1
        size[d + 255] = length + category + 1
    return word, size


def write(payloads: list[np.ndarray]) -> list[bytes]:
    """A JPEG stream for each array of bytes; their lengths are positive multiples of TILE."""
    tiles = [[min(MOST_TILES, len(p) // TILE - k) for k in range(0, len(p) // TILE, MOST_TILES)] for p in payloads]
    rows = np.concatenate(payloads).reshape(-1, SIDE).astype(np.int16) - 128
    word, size = _words()
    diff = np.diff(rows, axis=1, prepend=np.int16(0)) + 255
    words, sizes = word[diff], size[diff]
    ends = np.cumsum(sizes, axis=1)
    n_bytes = (ends[:, -1] + 7) >> 3
    first = np.cumsum(n_bytes) - n_bytes
    raw = np.zeros(int(n_bytes.sum()) + 3, np.uint8)
    for j in range(SIDE):  # a column of blocks at a time: their bytes don't overlap
        bit = ends[:, j] - sizes[:, j]
        at = first + (bit >> 3)
        shifted = words[:, j] << (24 - (bit & 7) - sizes[:, j]).astype(np.uint32)
        for k in range(3):
            raw[at + k] |= (shifted >> np.uint32(16 - 8 * k)).astype(np.uint8)
    last = first + n_bytes - 1
    raw[last] |= ((1 << (8 * n_bytes - ends[:, -1])) - 1).astype(np.uint8)
    raw = raw[:-3]
    full = raw == 255
    frame_rows = np.array([t * SIDE for own in tiles for t in own])
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(frame_rows) - frame_rows, frame_rows)
    closing = np.zeros(len(rows), bool)
    closing[np.cumsum(frame_rows) - 1] = True
    place = np.arange(len(raw)) + np.cumsum(full) - full + 2 * np.repeat(np.arange(len(rows)), n_bytes)
    out = np.zeros(len(raw) + int(full.sum()) + 2 * len(rows), np.uint8)
    out[place] = raw
    mark = place[last] + full[last] + 1
    out[mark] = 255
    out[mark + 1] = np.where(closing, 0xD9, 0xD0 + nth % 8)
    cuts = mark[closing] + 2
    done, begin, frame = [], 0, 0
    for own in tiles:
        parts = []
        for t in own:
            parts += [header(t), out[begin : cuts[frame]].tobytes()]
            begin, frame = cuts[frame], frame + 1
        done.append(b"".join(parts))
    return done


@dataclass
class Frame:
    width: int = 0
    height: int = 0
    quantisers: dict[int, int] = field(default_factory=dict)  # of DC, by table
    parts: list[tuple[int, int, int, int]] = field(default_factory=list)  # of each component: id, H, V, quantiser
    tables: dict[int, bytes] = field(default_factory=dict)  # kind and place: counts and symbols
    chosen: dict[int, tuple[int, int]] = field(default_factory=dict)  # component: DC and AC table
    interval: int = 0
    scan: bytes = b""

    def layout(self) -> tuple[list[tuple[int, int, int]], int, int]:
        """(component, DC table, AC table) of each block of an MCU; MCUs across and down."""
        h, v = max(p[1] for p in self.parts), max(p[2] for p in self.parts)
        if len(self.parts) == 1:
            h = v = 1
        blocks = [(i, *self.chosen[p[0]]) for i, p in enumerate(self.parts) for _ in range(1 if len(self.parts) == 1 else p[1] * p[2])]
        return blocks, -(-self.width // (8 * h)), -(-self.height // (8 * v))

    def signature(self) -> tuple:
        blocks, _, _ = self.layout()
        return tuple(blocks), tuple(sorted(self.tables.items()))


def parse(data: bytes) -> list[Frame]:
    """The images of a stream of baseline JPEG files."""
    frames, at = [], 0
    while at < len(data):
        if data[at : at + 2] != b"\xff\xd8":
            raise ValueError("no start of image")
        at += 2
        f = Frame()
        while True:
            if at + 4 > len(data) or data[at] != 0xFF:
                raise ValueError("no marker where one is due")
            marker = data[at + 1]
            if marker == 0xFF:
                at += 1
                continue
            size = struct.unpack_from(">H", data, at + 2)[0]
            body = data[at + 4 : at + 2 + size]
            at += 2 + size
            if marker == 0xDB:
                while body:
                    wide = body[0] >> 4
                    f.quantisers[body[0] & 15] = int.from_bytes(body[1 : 2 + wide], "big")
                    body = body[65 + 64 * wide :]
            elif marker == 0xC0:
                _, f.height, f.width, n = struct.unpack_from(">BHHB", body)
                f.parts = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
            elif marker == 0xC4:
                while body:
                    n = 17 + sum(body[1:17])
                    f.tables[body[0]] = body[1:n]
                    body = body[n:]
            elif marker == 0xDD:
                f.interval = struct.unpack(">H", body)[0]
            elif marker == 0xDA:
                f.chosen = {body[1 + 2 * i]: (body[2 + 2 * i] >> 4, 16 + (body[2 + 2 * i] & 15)) for i in range(body[0])}
                if not f.parts or set(f.chosen) != {p[0] for p in f.parts}:
                    raise ValueError("not one interleaved baseline scan")
                found = _NEXT.search(data, at)
                end = found.start() if found else len(data)
                f.scan, at = data[at:end], end + 2
                break
            elif 0xC1 <= marker <= 0xCF and marker != 0xC8 and marker != 0xCC:
                raise ValueError("not a baseline image")
        frames.append(f)
    return frames


@lru_cache(maxsize=64)
def _lookup(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For 16 bits ahead: the length of the code they begin with and its symbol."""
    size, symbol = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
    for (code, length), s in zip(_codes(list(table[:16])), table[16:], strict=True):
        lo = code << (16 - length)
        size[lo : lo + (1 << (16 - length))], symbol[lo : lo + (1 << (16 - length))] = length, s
    return size, symbol


def _lockstep(frames: list[Frame]) -> list[np.ndarray]:
    """DC coefficients of frames of one signature, in the order of their blocks."""
    blocks = frames[0].layout()[0]
    data = np.frombuffer(b"".join(f.scan for f in frames) + b"\0" * 8, np.uint8)
    heads = np.cumsum([0, *[len(f.scan) for f in frames[:-1]]])
    after = np.flatnonzero(data[:-1] == 255)
    follow = data[after + 1]
    keep = np.ones(len(data), bool)
    keep[after[follow == 0] + 1] = False
    restart = after[(follow >= 0xD0) & (follow <= 0xD7)]
    keep[restart] = keep[restart + 1] = False
    place = np.cumsum(keep) - keep
    begins = np.sort(np.concatenate([heads, restart + 2]))
    owner = np.searchsorted(heads, begins, side="right") - 1
    mcus = np.array([f.layout()[1] * f.layout()[2] for f in frames])
    interval = np.array([f.interval or n for f, n in zip(frames, mcus, strict=True)])
    nth = np.arange(len(begins)) - np.searchsorted(begins, heads)[owner]
    due = np.minimum(interval[owner], mcus[owner] - nth * interval[owner])
    d = data[keep].astype(np.uint32)
    ahead = (d[:-3] << 24) | (d[1:-2] << 16) | (d[2:-1] << 8) | d[3:]
    ahead = np.concatenate([ahead, np.zeros(512, np.uint32)]).astype(np.int64)
    pos = place[begins] * 8
    most = int(due.max())
    out = np.zeros((len(begins), most * len(blocks)), np.int16)
    base = np.zeros((len(begins), max(b[0] for b in blocks) + 1), np.int64)

    def peek(at: np.ndarray) -> np.ndarray:
        return (ahead[at >> 3] >> (16 - (at & 7))) & 0xFFFF

    tables = {k: _lookup(t) for k, t in frames[0].tables.items()}
    for m in range(most):
        rows = slice(None) if (due > m).all() else np.flatnonzero(due > m)
        at = pos[rows]
        for b, (part, dc, ac) in enumerate(blocks):
            size, symbol = tables[dc]
            bits = peek(at)
            category = symbol[bits]
            at = at + size[bits]
            value = peek(at) >> (16 - category)
            at += category
            half = np.int64(1) << np.maximum(category - 1, 0)
            base[rows, part] += np.where((category > 0) & (value < half), value - 2 * half + 1, value)
            out[rows, m * len(blocks) + b] = base[rows, part]
            size, symbol = tables[ac]
            bits = peek(at)
            run = symbol[bits]
            at += size[bits]
            if run.any():
                k = np.ones(len(at), np.int64)
                live = np.flatnonzero(run)
                run = run[live]
                while len(live):
                    at[live] += run & 15
                    k[live] += (run >> 4) + 1
                    live = live[k[live] < 64]
                    bits = peek(at[live])
                    run = symbol[bits]
                    at[live] += size[bits]
                    live, run = live[run != 0], run[run != 0]
        pos[rows] = at
    cuts = np.searchsorted(owner, np.arange(len(frames) + 1))
    return [np.concatenate([out[i, : due[i] * len(blocks)] for i in range(a, b)]) if (due[a:b] < most).any() else out[a:b].reshape(-1) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def thumbnails(frames: list[Frame]) -> list[np.ndarray]:
    """Luminance samples (the first component), one for each 8 x 8 block, of each frame."""
    out: list[np.ndarray] = [np.zeros(0)] * len(frames)
    groups: dict[tuple, list[int]] = {}
    for i, f in enumerate(frames):
        groups.setdefault(f.signature(), []).append(i)
    for own in groups.values():
        for i, dc in zip(own, _lockstep([frames[i] for i in own]), strict=True):
            f = frames[i]
            blocks, across, down = f.layout()
            _, h, v, q = f.parts[0]
            if len(f.parts) == 1:
                h = v = 1
            mine = dc.reshape(down * across, len(blocks))[:, : h * v].reshape(down, across, v, h).transpose(0, 2, 1, 3).reshape(down * v, across * h)
            mine = mine[: -(-f.height // 8), : -(-f.width // 8)]
            out[i] = np.clip((mine.astype(np.int32) * f.quantisers[q] + 4) // 8 + 128, 0, 255).astype(np.uint8)
    return out


def thumbnail_hash(thumb: np.ndarray) -> str:
    """64 bits: which cells of an 8 x 8 grid are brighter than the whole."""
    rows, columns = (np.linspace(0, n, 9).astype(int) for n in thumb.shape)
    total = np.zeros((thumb.shape[0] + 1, thumb.shape[1] + 1), np.int64)
    total[1:, 1:] = thumb.astype(np.int64).cumsum(0).cumsum(1)
    corner = total[np.ix_(rows, columns)]
    sums = corner[1:, 1:] - corner[:-1, 1:] - corner[1:, :-1] + corner[:-1, :-1]
    area = np.maximum(1, np.diff(rows)[:, None] * np.diff(columns)[None, :])
    bits = sums * thumb.size > corner[-1, -1] * area
    return np.packbits(bits.reshape(-1)).tobytes().hex()


def describe(files: list[bytes]) -> list[tuple[int, int, np.ndarray, str]]:
    """Width, total height, stacked thumbnail and its hash of each stream of images of one width."""
    parsed = [parse(x) for x in files]
    thumbs = iter(thumbnails([f for own in parsed for f in own]))
    out = []
    for own in parsed:
        thumb = np.concatenate([next(thumbs) for _ in own])
        out.append((own[0].width, sum(f.height for f in own), thumb, thumbnail_hash(thumb)))
    return out


def padded(text: str | None) -> tuple[int, np.ndarray]:
    raw = textnum.encode(text)
    size = max(1, -(-len(raw) // TILE)) * TILE
    return len(raw), np.frombuffer(raw + b"\xff" * (size - len(raw)), np.uint8)


def stored(text: Column) -> Column:
    """The JPEG stream that holds a text's bytes."""

    @F.pandas_udf("binary")
    def column(texts: pd.Series) -> pd.Series:
        return pd.Series(write([padded(t)[1] for t in texts.tolist()]), dtype=object)

    return column(text)


def media_columns(text: Column) -> Column:
    """Store a text's bytes, read the stored file back, and describe both."""

    @F.pandas_udf("n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
    def column(texts: pd.Series) -> pd.DataFrame:
        rows, every = [], texts.tolist()
        for lo, hi in textnum.blocks([t or "" for t in every], 1 << 20):
            sizes, payloads = zip(*map(padded, every[lo:hi]), strict=True)
            files = write(list(payloads))
            for n, file, (width, height, thumb, mark) in zip(sizes, files, describe(files), strict=True):
                back = thumb.tobytes()
                rows.append((n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(file), hashlib.sha256(file).hexdigest(), f"{width}x{height}:{mark}"))
        return pd.DataFrame(rows, columns=["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return column(text)
