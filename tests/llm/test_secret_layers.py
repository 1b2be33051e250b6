"""Nested layers of any size, wrapped runs, and hostile texts."""

import base64
import bz2
import gzip
import lzma
import random
import time
import urllib.parse
import zlib

import pytest
import zstandard

from farelake.llm import secrets

SECRET = "token=A1b2C3d4E5f6G7"
PACK = {
    "base64": base64.b64encode, "wrapped": base64.encodebytes, "gzip": gzip.compress, "zlib": zlib.compress,
    "zstd": lambda b: zstandard.compress(b), "bzip2": bz2.compress, "xz": lzma.compress,
    "url": lambda b: urllib.parse.quote_from_bytes(b, safe="").encode(),
}


def filler(rng, size):
    """Prose without long runs, and some that does not compress well."""
    words = [f"{rng.choice('abcdefgh')}{rng.randint(0, 99999)} " for _ in range(max(1, size // 7))]
    return "".join(words)[:size].encode()


def found(text):
    return [x[0] for x in secrets.find_secrets(text)]


@pytest.mark.parametrize("size", [1_000, 64_000, 100_000, 1_000_000])
def test_nested_layers_of_any_size(size):
    rng = random.Random(size)
    for _ in range(6 if size < 500_000 else 2):
        data = filler(rng, size) + SECRET.encode() + b" " + filler(rng, size // 3)
        steps = [rng.choice(list(PACK)) for _ in range(rng.randint(1, 3))]
        for step in steps:
            data = PACK[step](data)
            if rng.random() < 0.5 and step in ("base64", "wrapped", "url"):
                data = b"see: " + data + b" end."
        text = b"some words " + base64.b64encode(data) + b" more"
        assert "assign" in found(text), steps


def test_a_run_longer_than_a_piece():
    rng = random.Random(1)
    inner = base64.b64encode(filler(rng, 9_000_000) + SECRET.encode() + b" ")
    text = base64.b64encode(zlib.compress(filler(rng, 3_000_000) + inner + b" tail"))
    assert "assign" in found(text)


@pytest.mark.parametrize("width", [4, 5, 12, 15, 16, 60, 64, 76])
@pytest.mark.parametrize("indent", ["", "    ", "\t"])
def test_wrapped_lines_of_any_length(width, indent):
    run = base64.b64encode(f"some plain words, {SECRET} and more".encode()).decode()
    lines = [run[i:i + width] for i in range(0, len(run), width)]
    for end in ("\n", "\r\n"):
        text = f"data: |{end}{indent}" + f"{end}{indent}".join(lines) + f"{end}next: 1{end}"
        assert "assign" in found(text.encode())


@pytest.mark.parametrize("text", [
    base64.b64encode(f"Write {SECRET} now".encode("utf-16-le")).decode(), base64.b64encode(f"Write {SECRET}".encode("utf-16")).decode(),
    "token&equals;A1b2C3d4E5f6", "password&colon;&quot;A1b2C3d4E5f6&quot;", '{"a": "{\\"token\\": \\"A1b2C3d4E5f6\\"}"}'])
def test_other_forms(text):
    assert found(text.encode()) == ["assign"]


def test_hostile_texts_take_little_time():
    for raw in (b"x " * 500_000, b"x " * 8_000_000, b"\x78\x9c" * 300_000, b"BZh9" * 200_000, b"A" * 4_000_000, b"%78%20" * 200_000):
        text = base64.b64encode(gzip.compress(raw))
        start = time.process_time()
        secrets.find_secrets(text)
        assert time.process_time() - start < 12, raw[:8]
    text = base64.b64encode(gzip.compress(b"x " * 500_000))
    start = time.process_time()
    assert secrets.find_secrets(text) == []
    assert time.process_time() - start < 2


def test_the_first_look_misses_nothing():
    import pyarrow as pa
    run = base64.b64encode(f"words, {SECRET} and more".encode()).decode()
    texts = ["plain words.\nAnd more.", run, "\n".join(run[i:i + 8] for i in range(0, len(run), 8)),
             "k: |\r\n  " + "\r\n  ".join(run[i:i + 4] for i in range(0, len(run), 4)), "a&equals;b", "", None]
    flags = [flag for _, flag in secrets._texts(pa.array(texts, pa.string()))]
    assert flags == [False, True, True, True, True, False, False]
