"""Forged counts of samples: what a file tells of can't take more memory than a multiple of the file."""

import struct
import tracemalloc

from tapeline.llm import media


def fragments(n, each):
    run = media.full_box(b"trun", struct.pack(">I", each))
    traf = media.box(b"traf", media.full_box(b"tfhd", struct.pack(">II", 1, 0), flags=0x10), *[run] * n)
    return media.write_media(b"x" * 64) + media.box(b"moof", traf)


def tracks(n, each):
    stbl = media.box(
        b"stbl", media.full_box(b"stsd", struct.pack(">I", 1), media.box(b"raw ", bytes(28))), media.full_box(b"stsc", struct.pack(">IIII", 1, 1, each, 1)),
        media.full_box(b"stsz", struct.pack(">II", 1, each)), media.full_box(b"co64", struct.pack(">IQ", 1, 0)),
    )
    trak = media.box(b"trak", media.box(b"mdia", media.full_box(b"mdhd", struct.pack(">IIII", 0, 0, 8000, each)), media.box(b"minf", stbl)))
    return media.box(b"moov", *[trak] * n)


def peak(data):
    tracemalloc.start()
    found = media.read_media(data)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    return found, most


def test_runs_share_the_room_of_the_file():
    data = fragments(1500, 24_000)
    found, most = peak(data)
    assert found == [] and most < 200 * len(data) + 10_000_000
    assert peak(fragments(20, 3))[0][0]["n_samples"] == 61  # the stored one and twenty runs of three


def test_tracks_share_the_room_of_the_file():
    data = tracks(100, 15_000)
    found, most = peak(data)
    assert len(found) <= 2 and most < 400 * len(data) + 10_000_000
    assert len(peak(tracks(3, 50))[0]) == 3
