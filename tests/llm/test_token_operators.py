"""Token counts, piece encoding and packing against the tokenizer libraries."""

import hashlib
import zlib

import llm_data
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from opsloom.llm import packing, pieces, queries, token_counts

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def read(path):
    with open(path, "rb") as file:
        return file.read()


def library_ids(path, texts):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def texts():
    return [t or "" for t in llm_data.awkward()] + llm_data.noise(4000, seed=2) + [
        "-" * 3001 + "x", " " * 2000 + "b", "ab" * 3000, "x'", "'", "it's we'll I'd he'sx 'S",
    ]


@pytest.mark.parametrize("states", [200_000, 2_000])
def test_transducer_counts_like_the_library(texts, states):
    counter = token_counts.TokenCounter(read(BYTES), states)
    want = [len(ids) for ids in library_ids(BYTES, texts)]
    assert counter.counts(pa.array(texts)).tolist() == want


def test_chunk_maps_compose_over_blocks(monkeypatch):
    monkeypatch.setattr(token_counts, "SLICE_BYTES", 700)
    counter = token_counts.TokenCounter(read(BYTES), 500)
    texts = ["a" * 5000, "thing " * 900, "ab" * 2000 + " c", "é" * 999]
    assert counter.counts(pa.array(texts)).tolist() == [len(i) for i in library_ids(BYTES, texts)]


def test_pieces_like_the_library(texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    model = pieces.PieceModel(read(PIECES), 500)
    for text, (ids, numbers, decoded) in zip(texts, model.encode(texts)):
        want = library.encode(text)
        assert ids.tolist() == want
        assert numbers.decode() == ",".join(map(str, want))
        assert decoded.decode() == library.decode(want)


def test_word_ids_like_the_library(texts):
    words = packing.WordIds(read(WORDS), 500)
    every = texts + ["a" + chr(i) + "a1" + chr(i) + "1!" + chr(i) + "!'" + chr(i) + "s" for i in range(256)]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in words.encode(every)]
    assert got == library_ids(WORDS, every)


def test_count_tokens_on_awkward_rows(spark):
    texts = llm_data.awkward()
    rows = llm_data.by_id(token_counts.count_tokens(llm_data.documents(spark, texts), BYTES))
    want = [len(ids) for ids in library_ids(BYTES, [t or "" for t in texts])]
    assert len(rows) == len(texts) + 1
    for i, text in enumerate(texts):
        assert rows[i]["n_bytes"] == len((text or "").encode())
        assert rows[i]["n_tokens"] == want[i]
        assert rows[i]["over_limit"] == (want[i] > 512)


def test_piece_frames_agree(spark):
    docs = llm_data.documents(spark, llm_data.awkward())
    full = llm_data.by_id(pieces.encode_pieces(docs, PIECES))
    digests = llm_data.by_id(pieces.piece_digests(docs, PIECES))
    for key, row in full.items():
        ids = ",".join(map(str, row["ids"])).encode()
        assert digests[key]["n_tokens"] == len(row["ids"])
        assert digests[key]["ids_sha256"] == hashlib.sha256(ids).hexdigest()
        assert digests[key]["decoded_sha256"] == hashlib.sha256(row["decoded"].encode()).hexdigest()


def check_packing(rows, wanted, window):
    """Every id lies in exactly one piece, and sequences are full and without gaps."""
    found, sequences = {}, {}
    for row in rows:
        found.setdefault(row["doc_id"], []).append(row)
        sequences.setdefault(row["sequence_id"], []).append(row)
    assert set(found) == set(wanted)
    for key, own in found.items():
        own.sort(key=lambda r: r["start"])
        at = 0
        for row in own:
            assert row["start"] == at and row["doc_tokens"] == len(wanted[key])
            piece = np.array(wanted[key][at:at + row["length"]], dtype="<u4").tobytes()
            assert row["crc"] == zlib.crc32(piece)
            at += row["length"]
        assert at == len(wanted[key])
    assert sorted(sequences) == list(range(len(sequences)))
    for number, own in sequences.items():
        own.sort(key=lambda r: r["offset"])
        at = 0
        for row in own:
            assert row["offset"] == at
            at += row["length"]
        if number < len(sequences) - 1:
            assert at == window and own[0]["padded"] == window
        else:
            assert at <= own[0]["padded"] <= window


@pytest.mark.parametrize("window", [64, 4096])
def test_packing_round_trip(spark, window, monkeypatch):
    from pyspark.sql import functions as F

    texts = llm_data.awkward()
    docs = llm_data.documents(spark, texts)
    rows = packing.pack_documents(docs, WORDS, window=window).withColumn("crc", F.crc32("ids")).collect()
    ids = library_ids(WORDS, [*[t or "" for t in texts], "no id"])
    keys = [*range(len(texts)), None]
    check_packing(rows, {k: i + [2] for k, i in zip(keys, ids)}, window)


def test_empty_tables(spark):
    docs = llm_data.documents(spark, []).where("false")
    assert token_counts.count_tokens(docs, BYTES).collect() == []
    assert pieces.piece_digests(docs, PIECES).collect() == []
    assert packing.pack_documents(docs, WORDS).collect() == []


def test_queries_over_the_whole_table(spark):
    docs = spark.read.parquet(f"{llm_data.SMALL}/documents.parquet").collect()
    texts = [d["text"] for d in docs]
    named = queries.queries()
    counts = llm_data.by_id(named["op4_token_counts"](spark, llm_data.SMALL))
    assert [counts[d["doc_id"]]["n_tokens"] for d in docs] == [len(i) for i in library_ids(BYTES, texts)]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    coded = llm_data.by_id(named["op10_piece_encoding"](spark, llm_data.SMALL))
    for doc in docs:
        ids = library.encode(doc["text"])
        row = coded[doc["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    packed = named["op6_packed_sequences"](spark, llm_data.SMALL)
    rows = [r.asDict() | {"crc": r["ids_crc32"]} for r in packed.collect()]
    ids = library_ids(WORDS, texts)
    check_packing(rows, {d["doc_id"]: i + [2] for d, i in zip(docs, ids)}, 4096)
