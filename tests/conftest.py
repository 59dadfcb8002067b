import os
import struct
import sys
import zlib

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tagmill.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def png(pixels: list[list[tuple[int, int, int]]]) -> bytes:
    """A PNG file from rows of (red, green, blue)."""

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    height, width = len(pixels), len(pixels[0])
    raw = b"".join(b"\0" + b"".join(bytes(p) for p in row) for row in pixels)
    header = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    padding = chunk(b"tEXt", b"Comment\0" + b"x" * 100)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + padding + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
