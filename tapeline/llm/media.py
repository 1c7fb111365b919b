"""ISO media containers: box walk, sample tables, keyframe byte ranges; and a lossless writer of 8-bit samples."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, table, text_or_empty

SAMPLE_BYTES = 64
SYNC_EVERY = 16
RATE = 8000

#: Fixed values of ISO/IEC 14496-12: boxes that hold only other boxes.
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"mvex", b"moof", b"traf"}

#: Boxes inside more containers than this are not opened; the standard's lie in 6 at most.
NESTED = 32


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind) + body


def full_box(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags), *parts)


UNITY = struct.pack(">9i", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def padded(data: bytes) -> bytes:
    return data + bytes((-len(data)) % SAMPLE_BYTES or (0 if data else SAMPLE_BYTES))


def write_media(payload: bytes) -> bytes:
    """A one-track file of raw 8-bit samples: `ftyp`, `mdat`, `moov`. The payload's length is a positive multiple of 64.

    A sample of the table is a frame of 64 bytes; every 16th is a sync sample (`stss`).
    """
    frames = len(payload) // SAMPLE_BYTES
    head = box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2")
    mdat = struct.pack(">I4sQ", 1, b"mdat", 16 + len(payload))
    start = len(head) + len(mdat)
    span = struct.pack(">II", frames * SAMPLE_BYTES >> 32, frames * SAMPLE_BYTES & 0xFFFFFFFF)
    times = bytes(16) + struct.pack(">I", RATE) + span
    entry = box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(8), struct.pack(">HHHHI", 1, 8, 0, 0, RATE << 16))
    sync = np.arange(1, frames + 1, SYNC_EVERY, dtype=">u4")
    stbl = box(
        b"stbl",
        full_box(b"stsd", struct.pack(">I", 1), entry),
        full_box(b"stts", struct.pack(">III", 1, frames, SAMPLE_BYTES)),
        full_box(b"stss", struct.pack(">I", len(sync)), sync.tobytes()),
        full_box(b"stsc", struct.pack(">IIII", 1, 1, frames, 1)),
        full_box(b"stsz", struct.pack(">II", SAMPLE_BYTES, frames)),
        full_box(b"co64", struct.pack(">IQ", 1, start)),
    )
    minf = box(b"minf", full_box(b"smhd", bytes(4)), box(b"dinf", full_box(b"dref", struct.pack(">I", 1), full_box(b"url ", flags=1))), stbl)
    hdlr = full_box(b"hdlr", bytes(4), b"soun", bytes(12), b"sound\0")
    mdia = box(b"mdia", full_box(b"mdhd", times, struct.pack(">HH", 0x55C4, 0), version=1), hdlr, minf)
    tkhd = full_box(b"tkhd", bytes(16), struct.pack(">II", 1, 0), span, bytes(8), struct.pack(">HHHH", 0, 0, 0x100, 0), UNITY, bytes(8), version=1, flags=3)
    mvhd = full_box(b"mvhd", times, struct.pack(">IH", 0x10000, 0x100), bytes(10), UNITY, bytes(24), struct.pack(">I", 2), version=1)
    return b"".join((head, mdat, payload, box(b"moov", mvhd, box(b"trak", tkhd, mdia))))


def walk(data: bytes) -> Iterator[tuple[tuple[bytes, ...], int, int, int]]:
    """(path, start, body, end) of every box, containers before what they hold. A box that overruns its parent, or is too short, ends the walk of that parent."""
    open_: list[tuple[int, int, tuple[bytes, ...]]] = [(0, len(data), ())]
    while open_:
        at, end, path = open_.pop()
        while at + 8 <= end:
            size, kind = struct.unpack_from(">I4s", data, at)
            body = at + 8
            if size == 1 and at + 16 <= end:
                size, body = struct.unpack_from(">Q", data, at + 8)[0], at + 16
            stop = end if size == 0 else at + size
            if stop > end or stop < body:
                break
            yield (*path, kind), at, body, stop
            if kind in CONTAINERS and len(path) < NESTED:
                open_.append((stop, end, path))
                at, end, path = body, stop, (*path, kind)
            else:
                at = stop


def _numbers(data: bytes, span: tuple[int, int], at: int, n: int, kind: str = ">u4") -> np.ndarray:
    """n numbers from byte `at` of a box; the box must hold them."""
    if n < 0 or span[0] + at + n * np.dtype(kind).itemsize > span[1]:
        raise ValueError("the table overruns its box")
    return np.frombuffer(data, kind, n, span[0] + at).astype(np.int64)


def read_media(data: bytes | None) -> list[dict]:
    """One dict per track: codec, timescale, duration, n_samples, sample_bytes, keyframes (list of byte ranges) and chunk_ranges.

    Only boxes and tables are read; the payload is neither read nor decoded. The samples of movie fragments follow those
    of the track's own tables. Null, empty or broken input has no tracks; a track is left out if its tables are missing,
    contradict each other, tell of more than their boxes hold or of bytes outside the file. All tracks and runs together have at
    most as many samples as the file has bytes, so memory grows with the file; what goes beyond that is broken.
    """
    if not data:
        return []
    tracks: list[dict] = []
    extends: dict[int, tuple[int, int]] = {}
    runs: dict[int, list] = {}
    moof, head, room = 0, None, [len(data)]
    for path, start, a, b in walk(data):
        kind = path[-1]
        try:
            if kind == b"trak":
                tracks.append({})
            elif kind == b"moof":
                moof = start
            elif kind == b"trex":  # track, description, then the defaults of duration, size and flags
                t = _numbers(data, (a, b), 4, 5)
                extends[int(t[0])] = tuple(t[2:].tolist())
            elif kind == b"tfhd":
                head = _fragment_head(data, (a, b), moof, extends)
            elif kind == b"trun" and head:
                runs.setdefault(head["track"], []).append(_run(data, (a, b), head, room))
            elif tracks and b"trak" in path:
                tracks[-1][kind] = (a, b)
        except (struct.error, ValueError, IndexError, KeyError):
            return []
    return [found for t in tracks if (found := _track(data, t, room, runs))]


def _take(room: list[int], n: int) -> None:
    """Samples are taken from the room that the file's bytes leave."""
    room[0] -= n
    if room[0] < 0:
        raise ValueError("more samples than bytes")


#: Fixed values of ISO/IEC 14496-12: flags of tfhd and trun that tell which fields are there, and of a sample that is no sync sample.
BASE, DESCRIPTION, DURATION, SIZE, FLAGS = 0x1, 0x2, 0x8, 0x10, 0x20
RUN_OFFSET, RUN_FIRST = 0x1, 0x4
RUN_DURATION, RUN_SIZE, RUN_FLAGS, RUN_COMPOSITION = 0x100, 0x200, 0x400, 0x800
NOT_SYNC = 0x10000


def _fragment_head(data: bytes, span: tuple[int, int], moof: int, extends: dict) -> dict:
    """A track fragment's track, base place and defaults."""
    flags, track = _numbers(data, span, 0, 2).tolist()
    flags &= 0xFFFFFF
    at, base = 8, moof
    if flags & BASE:
        base, at = int(_numbers(data, span, at, 1, ">u8")[0]), at + 8
    at += 4 if flags & DESCRIPTION else 0
    values = list(extends.get(track, (0, 0, 0)))
    for k, flag in enumerate((DURATION, SIZE, FLAGS)):
        if flags & flag:
            values[k], at = int(_numbers(data, span, at, 1)[0]), at + 4
    return {"track": track, "base": base, "next": base, "defaults": values}


def _run(data: bytes, span: tuple[int, int], head: dict, room: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(starts, ends, sync, duration) of a fragment's run of samples; without an offset it follows the one before it."""
    flags, n = _numbers(data, span, 0, 2).tolist()
    _take(room, n)
    flags &= 0xFFFFFF
    at, place = 8, head["next"]
    if flags & RUN_OFFSET:
        place, at = head["base"] + int(_numbers(data, span, at, 1).astype(np.int32)[0]), at + 4
    first = None
    if flags & RUN_FIRST:
        first, at = int(_numbers(data, span, at, 1)[0]), at + 4
    fields = [f for f in (RUN_DURATION, RUN_SIZE, RUN_FLAGS, RUN_COMPOSITION) if flags & f]
    table = _numbers(data, span, at, n * len(fields)).reshape(n, len(fields)) if fields else None
    column = lambda f, k: table[:, fields.index(f)] if f in fields else np.full(n, head["defaults"][k], np.int64)
    duration, size, flag = column(RUN_DURATION, 0), column(RUN_SIZE, 1), column(RUN_FLAGS, 2)
    if first is not None and n:
        flag = np.concatenate(([first], flag[1:]))
    ends = place + np.cumsum(size)
    head["next"] = int(ends[-1]) if n else place
    return ends - size, ends, np.flatnonzero(flag & NOT_SYNC == 0), int(duration.sum())


def _track(data: bytes, t: dict, room: list[int], runs: dict) -> dict | None:
    try:
        a = t[b"mdhd"][0]
        scale, duration = struct.unpack_from(">IQ", data, a + 20) if data[a] == 1 else struct.unpack_from(">II", data, a + 12)
        codec = data[t[b"stsd"][0] + 12 : t[b"stsd"][0] + 16].decode("latin-1")
        at, ends, sync = _samples(data, t, room)
        if b"tkhd" in t:
            a = t[b"tkhd"][0]
            more = runs.pop(struct.unpack_from(">I", data, a + (20 if data[a] == 1 else 12))[0], [])  # a track of the same number again has none
            before = np.cumsum([len(at), *[len(r[0]) for r in more]])
            sync = np.concatenate((sync, *[r[2] + n for r, n in zip(more, before)]))
            at, ends = np.concatenate((at, *[r[0] for r in more])), np.concatenate((ends, *[r[1] for r in more]))
            duration += sum(r[3] for r in more)
        n = len(at)
        if n and (at.min() < 0 or ends.max() > len(data)) or len(sync) and (sync.min() < 0 or sync.max() >= n):
            return None
        lead = np.append(True, at[1:] != ends[:-1]) if n else np.zeros(0, bool)
        stop = np.append(lead[1:], True) if n else lead
        return {
            "codec": codec, "timescale": scale, "duration": duration, "n_samples": n, "sample_bytes": int((ends - at).sum()),
            "keyframes": np.stack((at[sync], ends[sync]), 1).tolist() if len(sync) else [],
            "chunk_ranges": np.stack((at[lead], ends[stop]), 1).tolist() if n else [],
        }
    except (KeyError, struct.error, ValueError, IndexError):
        return None


def _samples(data: bytes, t: dict, room: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, sync samples from 0) by a track's own tables; what they tell together must fit the file."""
    fixed, n = _numbers(data, t[b"stsz"], 4, 2).tolist()
    _take(room, n)
    if fixed * n > len(data):
        raise ValueError("more bytes than the file has")
    sizes = np.full(n, fixed, np.int64) if fixed else _numbers(data, t[b"stsz"], 12, n)
    runs = _numbers(data, t[b"stsc"], 8, 3 * int(_numbers(data, t[b"stsc"], 4, 1)[0])).reshape(-1, 3)
    wide = b"co64" in t
    table = t[b"co64" if wide else b"stco"]
    count = int(_numbers(data, table, 4, 1)[0])
    chunks = _numbers(data, table, 8, count, ">u8" if wide else ">u4")
    per = np.minimum(np.repeat(runs[:, 1], np.diff(np.append(runs[:, 0] - 1, count))), n)
    upto = np.cumsum(per)
    if len(per) != count or n and (not count or upto[-1] < n):
        raise ValueError("samples without a chunk")
    per = np.diff(np.minimum(np.append(0, upto), n))
    chunk_of = np.repeat(np.arange(count), per)
    cum = np.cumsum(sizes) - sizes
    first = np.minimum(np.searchsorted(chunk_of, np.arange(count)), max(n - 1, 0))
    at = chunks[chunk_of] + cum - cum[first[chunk_of]] if n else np.zeros(0, np.int64)
    sync = _numbers(data, t[b"stss"], 8, int(_numbers(data, t[b"stss"], 4, 1)[0])) - 1 if b"stss" in t else np.arange(n)
    return at, at + sizes, sync


TRACK = "codec string, timescale long, duration long, n_samples long, sample_bytes long, keyframes array<struct<start:long,stop:long>>, chunk_ranges array<struct<start:long,stop:long>>"
TRACKS = pa.list_(
    pa.struct([("codec", pa.string()), ("timescale", pa.int64()), ("duration", pa.int64()), ("n_samples", pa.int64()), ("sample_bytes", pa.int64())]
    + [(k, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))) for k in ("keyframes", "chunk_ranges")])
)


def _as_rows(tracks: list[dict]) -> list[dict]:
    span = lambda xs: [{"start": a, "stop": b} for a, b in xs]
    return [t | {k: span(t[k]) for k in ("keyframes", "chunk_ranges")} for t in tracks]


def media_tracks(df: DataFrame, column: str = "media", out: str = "tracks") -> DataFrame:
    """Adds `out`: array of tracks (codec, timescale, duration, samples, keyframe and chunk byte ranges) of a binary column of ISO media.

    Null, empty and broken containers give an empty array. A column already named `out` is replaced; all rows stay,
    repeated or not. A batch holds about BATCH_BYTES or one row, and a row's tables take a few times its own size.
    """
    keep = [c for c in df.columns if c != out]
    df = df.select(*keep)
    schema = df.schema.simpleString()[7:-1] + f",{out}:array<struct<{TRACK.replace(' string', ':string').replace(' long', ':long').replace(' array', ':array').replace(', ', ',')}>>"
    small_batches(df.sparkSession)

    def run(batches):
        for batch in batches:
            found = [_as_rows(read_media(x.as_py())) for x in batch.column(batch.schema.get_field_index(column))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, TRACKS)], [*batch.schema.names, out])

    return df.mapInArrow(run, schema)


def store_texts(docs: DataFrame) -> DataFrame:
    """Each row's text as a media file: doc_id, n_bytes, media (binary). Null texts are stored as empty ones; rows stay as they are, repeated or not."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            raw = [(x.as_py() or "").encode() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array([write_media(padded(x)) for x in raw], pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def stored_payload(media: bytes, track: dict) -> bytes:
    return b"".join(media[a:b] for a, b in track["chunk_ranges"])


def op2_media_columns(spark, sf_dir):
    """Writer, reader and digests in one pass over each batch, so that the media bytes never leave the worker."""
    docs = table(spark, sf_dir, "documents").select("doc_id", text_or_empty().alias("text"))
    small_batches(spark)
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "codec", "duration_s", "n_keyframes"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.int64()]

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = text.as_py().encode()
                media = write_media(padded(raw))
                track = read_media(media)[0]
                payload = stored_payload(media, track)
                ranges = np.array(track["keyframes"], "<i8").tobytes()
                feature = f"{track['codec'].strip()}/{track['timescale']}Hz/{track['duration']}t/{track['n_samples']}s/{len(track['keyframes'])}k/{zlib.crc32(ranges):08x}"
                out.append((doc_id, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-SAMPLE_BYTES:]), len(media), hashlib.sha256(media).hexdigest(), feature, track["codec"].strip(), track["duration"] / track["timescale"], len(track["keyframes"])))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * len(names), kinds)], names)

    return docs.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, codec string, duration_s double, n_keyframes long")
