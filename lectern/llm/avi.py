"""AVI with motion-JPEG: a lossless writer for bytes, a reader that follows the RIFF index, and shot detection.

A frame is a grey baseline JPEG of 24 x 24 pixels, nine blocks of 64 coefficients with quantiser 1. Byte b is the coefficient
whose eight magnitude bits are b (b for 128 to 255, b - 255 below), so each coefficient has the symbol (run 0, size 8). The
frame's Huffman tables give that symbol the one-bit code 0: a block is 64 times "0" and eight bits, 72 bytes, and a restart
marker after each block resets the DC prediction. Reading needs no more than the general baseline rules; frames with this header
are decoded in bulk, others bit by bit.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from lectern.llm.common import map_rows, table

UNIT = 576
SIDE, BLOCKS = 24, 9
FPS = 25
BINS = 16
#: Frames that are decoded at a time.
PIECE = 512
#: Order of coefficients in a JPEG block (zigzag), by rule: along anti-diagonals, turning each time.
ZIGZAG = np.array(sorted(range(64), key=lambda k: (k // 8 + k % 8, k // 8 if (k // 8 + k % 8) % 2 else k % 8)))


def segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def one_code_table(kind: int, symbol: int) -> bytes:
    return bytes([kind << 4, 1, *[0] * 15, symbol])


HEAD = b"".join([
    b"\xff\xd8",
    segment(0xDB, bytes([0, *[1] * 64])),
    segment(0xC0, struct.pack(">BHHB", 8, SIDE, SIDE, 1) + bytes([1, 0x11, 0])),
    segment(0xC4, one_code_table(0, 8)),
    segment(0xC4, one_code_table(1, 8)),
    segment(0xDD, struct.pack(">H", 1)),
    segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0])),
])
TAIL = b"\xff\xd9"


def spread(payload: np.ndarray) -> np.ndarray:
    """(n, 8) bytes to (n, 9): each byte behind a 0 bit."""
    b = payload.astype(np.uint16)
    out = np.zeros((len(b), 9), np.uint16)
    for k in range(8):
        out[:, k] |= b[:, k] >> (k + 1)
        out[:, k + 1] |= (b[:, k] << (7 - k)) & 0xFF
    return out.astype(np.uint8)


def gather(coded: np.ndarray) -> np.ndarray:
    """The reverse of :func:`spread`."""
    c = coded.astype(np.uint16)
    return np.stack([(c[:, k] << (k + 1) | c[:, k + 1] >> (7 - k)) & 0xFF for k in range(8)], axis=1).astype(np.uint8)


def padded(raw: bytes) -> bytes:
    return raw + b"\xff" * (max(1, -(-len(raw) // UNIT)) * UNIT - len(raw))


def encode_frames(payload: bytes) -> list[bytes]:
    coded = spread(np.frombuffer(payload, np.uint8).reshape(-1, 8)).reshape(-1, 72)
    blocks = coded.tobytes()
    full = (coded == 0xFF).any(axis=1).tolist()
    marks = [b"\xff" + bytes([0xD0 + k % 8]) for k in range(BLOCKS - 1)] + [TAIL]
    out = []
    for f in range(len(payload) // UNIT):
        parts = [HEAD]
        for k in range(BLOCKS):
            i = f * BLOCKS + k
            block = blocks[72 * i : 72 * i + 72]
            parts += [block.replace(b"\xff", b"\xff\0") if full[i] else block, marks[k]]
        out.append(b"".join(parts))
    return out


def chunk(tag: bytes, body: bytes) -> bytes:
    return tag + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)


def mux(frames: list[bytes], fps: int = FPS, side: int = SIDE) -> bytes:
    """An AVI file of one video stream with an idx1 index. One RIFF list holds up to 4 GB, more than a Spark string does."""
    most = max((len(f) for f in frames), default=0)
    main = struct.pack("<14I", 1_000_000 // fps, most * fps, 0, 0x10, len(frames), 0, 1, most, side, side, 0, 0, 0, 0)
    stream = b"vidsMJPG" + struct.pack("<IHHIIIIIIII4H", 0, 0, 0, 0, 1, fps, 0, len(frames), most, 0xFFFFFFFF, 0, 0, 0, side, side)
    bitmap = struct.pack("<IiiHH4sIiiII", 40, side, side, 1, 24, b"MJPG", side * side * 3, 0, 0, 0, 0)
    header = chunk(b"LIST", b"hdrl" + chunk(b"avih", main) + chunk(b"LIST", b"strl" + chunk(b"strh", stream) + chunk(b"strf", bitmap)))
    movi, index, at = [b"movi"], [], 4
    for f in frames:
        movi.append(chunk(b"00dc", f))
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        at += len(movi[-1])
    return chunk(b"RIFF", b"AVI " + header + chunk(b"LIST", b"".join(movi)) + chunk(b"idx1", b"".join(index)))


def chunks(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(tag, body start, body end) of the RIFF chunks in data[at:end]; a cut chunk ends with the data."""
    while at + 8 <= end:
        tag, n = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        yield tag, at + 8, min(end, at + 8 + n)
        at += 8 + n + n % 2


def frame_chunks(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """Chunks of a movi list, those in its record lists too."""
    for tag, s, e in chunks(data, at, end):
        if tag == b"LIST" and data[s : s + 4] == b"rec ":
            yield from chunks(data, s + 4, e)
        else:
            yield tag, s, e


def is_frame(tag: bytes) -> bool:
    return tag[2:] in (b"dc", b"db")


def standard_index(body: bytes) -> Iterator[tuple[int, int]]:
    """(start, length) of the frames in an OpenDML index chunk; offsets are to the frames' bytes."""
    longs, _, kind, n, tag, base = struct.unpack_from("<HBBI4sQ", body)
    if kind == 1 and longs == 2 and is_frame(tag):
        for offset, size in struct.iter_unpack("<II", body[24 : 24 + (min(8 * n, len(body) - 24) // 8) * 8]):
            yield base + offset, size & 0x7FFFFFFF


def demux(data: bytes) -> tuple[int, int, list[bytes]]:
    """(rate, scale, frames) of the first video stream, in index order.

    Files of several RIFF lists have OpenDML indexes, others one at the end. Without either, frames are taken in file order.
    """
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("no AVI file")
    rate, scale, movis, index, standard = FPS, 1, [], None, []
    for riff, start, stop in chunks(data, 0, len(data)):
        if riff != b"RIFF" or data[start : start + 4] not in (b"AVI ", b"AVIX"):
            continue
        for tag, s, e in chunks(data, start + 4, stop):
            if tag == b"LIST" and data[s : s + 4] == b"hdrl":
                for t, a, b in chunks(data, s + 4, e):
                    if t == b"LIST" and data[a : a + 4] == b"strl":
                        for u, p, _ in chunks(data, a + 4, b):
                            if u == b"strh" and data[p : p + 4] == b"vids":
                                scale, rate = struct.unpack_from("<II", data, p + 20)
            elif tag == b"LIST" and data[s : s + 4] == b"movi":
                movis.append((s, e))
                for t, a, b in chunks(data, s + 4, e):
                    if t[:2] == b"ix":
                        standard += standard_index(data[a:b])
            elif tag == b"idx1":
                index = (s, e)
    if not movis:
        return rate, scale, []
    if standard:
        return rate, scale, [data[o : o + n] for o, n in standard]
    if index is None or len(movis) > 1:
        return rate, scale, [data[s:e] for m, stop in movis for t, s, e in frame_chunks(data, m + 4, stop) if is_frame(t)]
    movi = movis[0][0]
    entries = [x for x in struct.iter_unpack("<4sIII", data[index[0] : index[0] + (index[1] - index[0]) // 16 * 16]) if is_frame(x[0])]
    # offsets count from the movi list or, in some files, from the file's start
    base = movi if entries and data[movi + entries[0][2] : movi + entries[0][2] + 4] == entries[0][0] else 0
    return rate, scale, [data[base + o + 8 : base + o + 8 + n] for _, _, o, n in entries]


#: The Huffman tables that motion-JPEG frames without any of their own are coded with (ITU-T T.81, annex K.3): how many
#: codes there are of each length, then their symbols. First for luma, then for chroma.
DEFAULT_DC = [
    (bytes.fromhex("00010501010101010100000000000000"), bytes(range(12))),
    (bytes.fromhex("00030101010101010101010000000000"), bytes(range(12))),
]
DEFAULT_AC = [
    (
        bytes.fromhex("0002010303020403050504040000017d"),
        bytes.fromhex(
            "01020300041105122131410613516107227114328191a1082342b1c11552d1f02433627282090a161718191a25262728292a3435363738393a"
            "434445464748494a535455565758595a636465666768696a737475767778797a838485868788898a92939495969798999aa2a3a4a5a6a7a8a9aa"
            "b2b3b4b5b6b7b8b9bac2c3c4c5c6c7c8c9cad2d3d4d5d6d7d8d9dae1e2e3e4e5e6e7e8e9eaf1f2f3f4f5f6f7f8f9fa"
        ),
    ),
    (
        bytes.fromhex("00020102040403040705040400010277"),
        bytes.fromhex(
            "0001020311040521310612415107617113223281081442"
            "91a1b1c109233352f0156272d10a162434e125f11718191a262728292a35363738393a434445464748494a535455565758595a636465666768696a"
            "737475767778797a82838485868788898a92939495969798999aa2a3a4a5a6a7a8a9aab2b3b4b5b6b7b8b9bac2c3c4c5c6c7c8c9cad2d3d4d5d6d7d8d9da"
            "e2e3e4e5e6e7e8e9eaf2f3f4f5f6f7f8f9fa"
        ),
    ),
]


@lru_cache(64)
def huffman(counts: bytes, symbols: bytes) -> list[int]:
    """For every 16 bits, length << 8 | symbol of the code they begin with; 0 where there is none."""
    table, code, k = [0] * 65536, 0, 0
    for bits, n in enumerate(counts, 1):
        for _ in range(n):
            low, width = code << (16 - bits), 1 << (16 - bits)
            table[low : low + width] = [bits << 8 | symbols[k]] * width
            code, k = code + 1, k + 1
        code <<= 1
    return table


def parse_jpeg(frame: bytes) -> dict:
    """Tables, size, components and entropy-coded data of a baseline JPEG, grey or in colour."""
    dc = {k: huffman(*t) for k, t in enumerate(DEFAULT_DC)}
    ac = {k: huffman(*t) for k, t in enumerate(DEFAULT_AC)}
    out, at = {"dc": dc, "ac": ac, "q": {}, "restart": 0}, 2
    if frame[:2] != b"\xff\xd8":
        raise ValueError("no JPEG")
    while True:
        while frame[at + 1] == 0xFF:  # fill bytes
            at += 1
        if frame[at] != 0xFF:
            raise ValueError("no marker where one is due")
        marker, n = frame[at + 1], struct.unpack_from(">H", frame, at + 2)[0]
        body = frame[at + 4 : at + 2 + n]
        at += 2 + n
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                out["q"][body[0] & 15] = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else np.uint8).astype(np.int32)
                body = body[65 + 64 * wide :]
        elif marker in (0xC0, 0xC1):
            bits, out["height"], out["width"], parts = struct.unpack_from(">BHHB", body)
            if bits != 8 or parts not in (1, 3):
                raise ValueError("only grey and three-component frames of 8 bits are read")
            out["parts"] = [(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(parts)]
        elif 0xC2 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            raise ValueError("no baseline frame")
        elif marker == 0xC4:
            while body:
                total = sum(body[1:17])
                out["ac" if body[0] >> 4 else "dc"][body[0] & 15] = huffman(body[1:17], body[17 : 17 + total])
                body = body[17 + total :]
        elif marker == 0xDD:
            out["restart"] = struct.unpack(">H", body)[0]
        elif marker == 0xDA:
            tables = {body[1 + 2 * k]: body[2 + 2 * k] for k in range(body[0])}
            if body[0] != len(out["parts"]):
                raise ValueError("only frames of one scan are read")
            out["tables"] = [(tables[i] >> 4, tables[i] & 15) for i, _, _, _ in out["parts"]]
            out["data"] = frame[at : frame.rindex(b"\xff\xd9") if b"\xff\xd9" in frame[at:] else len(frame)]
            return out


def coefficients(jpeg: dict) -> list[np.ndarray]:
    """Quantised coefficients (block rows, block columns, 64) of each component, in zigzag order, by the general baseline rules."""
    parts = jpeg["parts"] if len(jpeg["parts"]) > 1 else [(jpeg["parts"][0][0], 1, 1, jpeg["parts"][0][3])]
    wide, high = max(p[1] for p in parts), max(p[2] for p in parts)
    columns, rows = -(-jpeg["width"] // (8 * wide)), -(-jpeg["height"] // (8 * high))
    out = [np.zeros((rows * v, columns * h, 64), np.int32) for _, h, v, _ in parts]
    plan = [(k, jpeg["dc"][td], jpeg["ac"][ta], y, x) for k, ((_, h, v, _), (td, ta)) in enumerate(zip(parts, jpeg["tables"], strict=True)) for y in range(v) for x in range(h)]
    every = jpeg["restart"] or columns * rows
    stretches = re.split(b"\xff[\xd0-\xd7]", jpeg["data"])
    for unit in range(columns * rows):
        if unit % every == 0:
            raw = np.frombuffer(stretches[unit // every].replace(b"\xff\0", b"\xff") + bytes(8), np.uint8).astype(np.int64)
            bits = (raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]).tolist()  # 32 bits from every byte on
            at, last = 0, [0] * len(parts)
        row, column = divmod(unit, columns)
        for k, dc, ac, y, x in plan:
            block = out[k][row * parts[k][2] + y, column * parts[k][1] + x]
            i = 0
            while i < 64:
                code = (dc if i == 0 else ac)[bits[at >> 3] >> (16 - (at & 7)) & 0xFFFF]
                if not code:
                    raise ValueError("bad code")
                at += code >> 8
                run, size = (0, code & 255) if i == 0 else divmod(code & 255, 16)
                if not size and i:
                    if run < 15:
                        break
                    i += 16
                    continue
                v = 0
                if size:
                    v = bits[at >> 3] >> (32 - (at & 7) - size) & ((1 << size) - 1)
                    at += size
                    if not v >> (size - 1):
                        v += 1 - (1 << size)
                i += run
                if i == 0:
                    v = last[k] = last[k] + v
                block[i] = v
                i += 1
    return out


def planes(jpeg: dict) -> list[np.ndarray]:
    """Samples of each component (luma, then blue and red difference), in its own resolution, cut to the frame's size."""
    wide, high = max(p[1] for p in jpeg["parts"]), max(p[2] for p in jpeg["parts"])
    out = []
    for (_, h, v, q), c in zip(jpeg["parts"], coefficients(jpeg), strict=True):
        blocks = samples(c.reshape(-1, 64) * jpeg["q"][q]).reshape(*c.shape[:2], 8, 8)
        whole = blocks.transpose(0, 2, 1, 3).reshape(8 * c.shape[0], 8 * c.shape[1])
        out.append(whole[: -(-jpeg["height"] * v // high), : -(-jpeg["width"] * h // wide)])
    return out


def decode_frames(frames: list[bytes]) -> np.ndarray:
    """Quantised coefficients (frames, blocks, 64) in zigzag order of frames that :func:`encode_frames` made."""
    if not frames:
        return np.zeros((0, BLOCKS, 64), np.int32)
    coded = bytearray()
    for f in frames:
        body = f[len(HEAD) : -2].replace(b"\xff\0", b"\xff")
        if not f.startswith(HEAD) or len(body) != 74 * BLOCKS - 2:
            raise ValueError("bad frame")
        coded += body + b"\0\0"
    blocks = np.frombuffer(bytes(coded), np.uint8).reshape(-1, 74)[:, :72]
    return unmap(gather(np.ascontiguousarray(blocks).reshape(-1, 9))).reshape(len(frames), BLOCKS, 64)


def unmap(stored: np.ndarray) -> np.ndarray:
    v = stored.astype(np.int32)
    return np.where(v >= 128, v, v - 255)


def stored_bytes(coefs: np.ndarray) -> bytes:
    return np.where(coefs > 0, coefs, coefs + 255).astype(np.uint8).tobytes()


@lru_cache
def inverse_dct() -> np.ndarray:
    """(zigzag coefficient, pixel) weights of the 8 x 8 inverse cosine transform."""
    x = np.arange(8)
    c = np.cos((2 * x[None, :] + 1) * x[:, None] * np.pi / 16) * np.where(x == 0, np.sqrt(1 / 8), np.sqrt(1 / 4))[:, None]
    return np.einsum("ux,vy->uvxy", c, c).reshape(64, 64)[ZIGZAG]


def samples(coefs: np.ndarray) -> np.ndarray:
    """Samples 0 to 255 (blocks, 64) of dequantised coefficients in zigzag order."""
    return np.clip(coefs.astype(float) @ inverse_dct() + (128 + 1e-6), 0, 255)  # whole values stay whole under rounding


def histograms(coefs: np.ndarray) -> np.ndarray:
    """(frames, BINS) shares of brightness in frames (frames, blocks, 64) with quantiser 1."""
    n = len(coefs)
    level = samples(coefs.reshape(-1, 64)).astype(np.int32) * BINS // 256
    flat = level.reshape(n, -1) + BINS * np.arange(n)[:, None]
    return np.bincount(flat.ravel(), minlength=n * BINS).reshape(n, BINS) / (coefs.shape[1] * 64)


def histograms_of(frames: list[bytes]) -> np.ndarray:
    """(frames, 3 * BINS) shares of brightness and of the two colour differences, which are in the middle in a grey frame.

    The writer's own frames are decoded in bulk, others bit by bit. An empty frame repeats the one before it.
    """
    out = np.zeros((len(frames), 3, BINS))
    out[:, 1:, BINS // 2] = 1
    own = [k for k, f in enumerate(frames) if f.startswith(HEAD)]
    for at in range(0, len(own), PIECE):
        some = own[at : at + PIECE]
        out[some, 0] = histograms(decode_frames([frames[k] for k in some]))
    for k, f in enumerate(frames):
        if f.startswith(HEAD):
            continue
        if not f and k:
            out[k] = out[k - 1]
            continue
        for c, plane in enumerate(planes(parse_jpeg(f))):
            out[k, c] = np.bincount(plane.astype(np.int32).ravel() * BINS // 256, minlength=BINS) / plane.size
    return out.reshape(len(frames), 3 * BINS)


def shots(hist: np.ndarray, reach: int = 8, times: float = 2.5, least: float = 0.25) -> list[tuple[int, int]]:
    """(first frame, end) of each shot: a cut is where the histograms' distance, in the channel where it is greatest, stands out from
    those before and behind it."""
    n = len(hist)
    if n < 2:
        return [(0, n)] if n else []
    d = np.abs(np.diff(hist, axis=0)).reshape(n - 1, -1, BINS).sum(axis=2).max(axis=1) / 2
    total = np.concatenate([[0], np.cumsum(d)])
    squares = np.concatenate([[0], np.cumsum(d * d)])
    i = np.arange(len(d))
    lo, hi = np.maximum(0, i - reach), np.minimum(len(d), i + reach + 1)
    size = np.maximum(1, hi - lo - 1)
    mean = (total[hi] - total[lo] - d) / size
    deviation = np.sqrt(np.maximum(0, (squares[hi] - squares[lo] - d * d) / size - mean * mean))
    cuts = np.flatnonzero(d > np.maximum(least, mean + times * deviation)) + 1
    edges = [0, *cuts.tolist(), n]
    return list(zip(edges, edges[1:], strict=False))


def clips(media: DataFrame, key: str, column: str) -> DataFrame:
    """Timed clip rows (key, clip, start_frame, end_frame, start_s, end_s, brightness) of AVI files in a binary column.

    Frames are baseline JPEG, grey or in colour, with the tables they bring or the default ones. A null or empty file has no clips;
    one that is no AVI, or whose frames can't be read, has one row with null times. Repeated rows give their clips each; an empty
    table gives no rows. Other columns are not read.
    """

    def make():
        def rows(cols: list[list]) -> Iterator[tuple]:
            for i, data in zip(*cols, strict=True):
                if not data:
                    continue
                try:
                    rate, scale, frames = demux(data)
                    hist = histograms_of(frames)
                except (ValueError, KeyError, IndexError, struct.error):
                    yield i, 0, None, None, None, None, None
                    continue
                step = scale / max(1, rate)
                for k, (a, b) in enumerate(shots(hist)):
                    yield i, k, a, b, a * step, b * step, float(hist[a:b, :BINS].mean(axis=0) @ np.arange(BINS)) / (BINS - 1)

        return rows

    kind = media.schema[key].dataType.simpleString()
    return map_rows(media.select(key, column), f"`{key}` {kind}, clip int, start_frame int, end_frame int, start_s double, end_s double, brightness double", make)


def store(texts: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, n_bytes, media binary): each text, padded to frames, as an AVI file.

    Null counts as empty: one frame of padding. A text of any length is one file. Repeated rows and null keys give a row each; an
    empty table gives no rows. Other columns are not read.
    """

    def make():
        def rows(cols: list[list]) -> Iterator[tuple]:
            for i, text in zip(*cols, strict=True):
                raw = (text or "").encode()
                yield i, len(raw), mux(encode_frames(padded(raw)))

        return rows

    return map_rows(texts.select(key, column), f"`{key}` {texts.schema[key].dataType.simpleString()}, n_bytes long, media binary", make)


def op9_avi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as an AVI file and read back: digests of both, and its shots. Edge cases are those of :func:`store`."""

    def make():
        def rows(cols: list[list]) -> Iterator[tuple]:
            for i, text in zip(*cols, strict=True):
                raw = (text or "").encode()
                media = mux(encode_frames(padded(raw)))
                _, _, frames = demux(media)
                back, hist = bytearray(), [np.zeros((0, BINS))]
                for at in range(0, len(frames), PIECE):
                    coefs = decode_frames(frames[at : at + PIECE])
                    back += stored_bytes(coefs)
                    hist.append(histograms(coefs))
                found = shots(np.concatenate(hist))
                feature = f"frames={len(frames)};shots={len(found)};" + ",".join(f"{a / FPS:.2f}-{b / FPS:.2f}" for a, b in found)
                yield i, len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature

        return rows

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return map_rows(docs, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string", make)
