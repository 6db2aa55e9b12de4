"""Secrets in base64 that is wrapped over lines."""

import base64
import bz2
import gzip
import lzma
import random
import re

import pytest

from opsloom.llm import secrets

SECRET = 'password = "Abcdefgh1234"'


def folded(data, width, brk="\n"):
    return brk.join(re.findall(f".{{1,{width}}}", base64.b64encode(data).decode()))


def payload(size):
    draw = random.Random(2)
    words = [f"w{draw.randrange(10**9)}" for _ in range(size)]
    words[size // 2] = SECRET
    return " ".join(words).encode()


@pytest.mark.parametrize("width", [16, 60, 64, 76])
@pytest.mark.parametrize("brk", ["\n", "\r\n", "\n    ", "\n> "])
@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_wrapped_payloads(width, brk, pack):
    for size in (30, 31, 32, 33):
        block = folded(pack(payload(size)), width, brk)
        for before, after in [("see:\n", "\nend"), ("see ", " end"), ("a word\n", "\n-----END"), ("", "")]:
            text = before + block + after
            every = secrets.all_spans(text)[1]
            assert [k for k, _, _ in every] == ["assign"]
            assert len(before) <= every[0][1] < every[0][2] <= len(before) + len(block)


def test_a_secret_over_a_line_border():
    for lead in range(30, 64):
        block = folded(b"x" * lead + b" " + SECRET.encode() + b" tail of the text", 64)
        text = f"look:\n{block}\n"
        assert "assign" in {k for k, _, _ in secrets.all_spans(text)[1]}, lead


def test_the_shortest_secret():
    text = base64.b64encode(b"token:12345678").decode()
    assert len(text.rstrip("=")) == 19
    assert secrets.all_spans(f"x {text} y")[1] == [("assign", 2, 21)]


@pytest.mark.parametrize("pack", [gzip.compress, bz2.compress, lzma.compress])
def test_large_layers_are_scanned_in_windows(pack):
    line = b"an ordinary line of a log\n"
    for at in (0, 3000, 15_000):
        inner = base64.b64encode(SECRET.encode())
        for secret in (SECRET.encode(), inner, b"password" + b" " * 100_000 + b"= Abcdefgh1234"):
            content = line * at + secret + b"\n" + line * (15_000 - at)
            text = f"x {base64.b64encode(pack(content)).decode()} y"
            plain, every, complete = secrets.scan_text(text, window=1 << 17)
            assert (plain, every, complete) == ([], [("assign", 2, len(text) - 2)], True)


def test_what_was_not_scanned_is_said(spark):
    bomb = base64.b64encode(gzip.compress(b"a line \n" * 50_000)).decode()
    assert secrets.scan_text(f"x {bomb} y", window=1 << 17) == ([], [], True)
    assert secrets.scan_text(f"x {bomb} y", total=2 << 16) == ([], [], False)
    word = base64.b64encode(gzip.compress(b"z" * 500_000)).decode()
    assert secrets.scan_text(f"x {word} y", window=1 << 17) == ([], [], False)
    docs = spark.createDataFrame([(1, f"x {bomb} y"), (2, "x")], "doc_id long, text string")
    rows = {r["doc_id"]: r["complete"] for r in secrets.scan_secrets(docs, most=1 << 17).collect()}
    assert rows == {1: False, 2: True}


def test_all_members_of_a_packed_layer():
    for pack in (gzip.compress, bz2.compress, lzma.compress):
        text = base64.b64encode(pack(b"first ") + pack(SECRET.encode())).decode()
        assert [s[0] for s in secrets.all_spans(text)[1]] == ["assign"]
