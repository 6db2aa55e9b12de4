"""Secrets in base64 layers that are not clean text, and behind JSON escapes."""

import base64
import json
import re

import pytest

from opsloom.llm import secrets

SECRET = "token:Abcdefgh1234"


def kinds(text):
    return [k for k, _, _ in secrets.all_spans(text)[1]]


@pytest.mark.parametrize("data", [
    SECRET.encode() + b"\0", b"\x01\x02" + SECRET.encode() + b"\xff\xfe\x80",
    f"clé déjà {SECRET} façon".encode("latin-1"), f"see {SECRET} end".encode("utf-16"),
    f"see {SECRET} end".encode("utf-16-le"), f"see {SECRET} end".encode("utf-16-be"),
    b"\0" * 7 + f"see {SECRET} end".encode("utf-16-be"),
])
def test_binary_layers(data):
    for lead in range(4):
        block = base64.b64encode(b"\x90" * lead + data).decode()
        every = secrets.all_spans(f"look {block} end")[1]
        assert [k for k, _, _ in every] == ["assign"]
        assert 5 <= every[0][1] < every[0][2] <= 5 + len(block)


def test_the_span_covers_the_digits_of_the_secret():
    data = b"\xff" * 30 + SECRET.encode() + b"\xff" * 30
    block = base64.b64encode(data).decode()
    [(_, start, end)] = secrets.all_spans(block)[1]
    assert (start, end) == (30 * 4 // 3, (30 + len(SECRET)) * 4 // 3)


def test_nested_in_binary():
    inner = base64.b64encode(b"\x00\x01" + SECRET.encode()).decode()
    outer = base64.b64encode(b"\xfe\xff" + inner.encode() + b"\x00").decode()
    assert kinds(f"x {outer} y") == ["assign"]


def test_json_escapes():
    block = "\n".join(re.findall(".{1,24}", base64.b64encode(f"{SECRET} and some more text".encode()).decode()))
    assert kinds(json.dumps({"data": block})) == ["assign"]
    assert kinds(r'{"password": "\/Abcdefgh"}') == ["assign"]
    assert kinds(json.dumps(json.dumps({"data": block}))) == ["assign"]


def test_clean_texts_with_backslashes_have_no_spans():
    assert kinds(r"C:\new\table\report and \"quoted\" words \\ end") == []
