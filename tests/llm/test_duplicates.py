"""SimHash groups and repeated passages against brute force."""

import hashlib
import random

import llm_data
import numpy as np
import pyarrow as pa
import pytest
import xxhash

from opsloom.llm import passages, queries, simhash

WHITE = b" \t\n\v\f\r"


def fingerprint(text: str | None) -> int:
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = [w for w in "".join(chr(b) if b not in WHITE else "\n" for b in lower).split("\n") if w]
    words = [w.encode("latin-1") for w in words]
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints: dict) -> dict:
    """Smallest id reachable over fingerprints at most two bits apart, by comparing all pairs."""
    keys = list(prints)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if bin(prints[a] ^ prints[b]).count("1") <= 2:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {k: find(k) for k in keys}


def test_fingerprints_match_the_definition():
    texts = llm_data.awkward()[:6] + llm_data.noise(300, seed=5) + ["A b\tC\x0bd", "É A", "one two", "one two three"]
    got = simhash.simhashes(pa.array(texts)).view(np.uint64).tolist()
    assert got == [fingerprint(t) for t in texts]


def near_texts(count: int) -> list[str]:
    draw = random.Random(11)
    base = [" ".join(f"w{draw.randrange(500)}" for _ in range(200)) for _ in range(4)]
    out = []
    for _ in range(count):
        words = draw.choice(base).split()
        for _ in range(draw.randint(0, 2)):
            words[draw.randrange(len(words))] = f"w{draw.randrange(500)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("crowd", [64, 2])
def test_groups_match_all_pairs(spark, crowd):
    texts = llm_data.awkward()[:40] + near_texts(150)
    rows = llm_data.by_id(simhash.near_duplicates(llm_data.documents(spark, texts), crowd=crowd))
    prints = {i: fingerprint(t) for i, t in enumerate(texts)}
    want = groups(prints)
    assert {k: rows[k]["component_id"] for k in prints} == want
    assert {k: rows[k]["fingerprint"] for k in prints} == {k: f"{v:016x}" for k, v in prints.items()}
    assert len(set(want.values())) < len(texts)
    assert len(rows) == len(texts) + 1


@pytest.mark.parametrize("crowd", [64, 1])
def test_links_of_chains_and_crowds(spark, crowd):
    """Chains of one and two flipped bits, and a crowd around one value, in either segment."""
    draw = random.Random(4)
    values = {0, (1 << 64) - 1}
    for _ in range(12):
        value = draw.getrandbits(64)
        for _ in range(6):
            values.add(value)
            for _ in range(draw.randint(1, 3)):
                value ^= 1 << draw.randrange(64)
    centre = draw.getrandbits(64)
    values |= {centre ^ 1 << a ^ 1 << b for a in range(0, 64, 7) for b in range(3, 64, 9) if a != b}
    signed = [v - (1 << 64) if v >> 63 else v for v in sorted(values)]
    frame = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    got = {tuple(r) for r in simhash.components(simhash.links(frame, crowd)).collect()}
    want = groups({v: v & (1 << 64) - 1 for v in signed})
    assert {n: r for n, r in got} == {n: r for n, r in want.items() if list(want.values()).count(r) > 1}


def test_repeated_rows_and_empty_table(spark):
    docs = llm_data.documents(spark, ["one two three four"] * 2)
    twice = docs.unionByName(docs)
    rows = simhash.near_duplicates(twice).where("doc_id is not null").collect()
    assert len(rows) == 4 and {r["component_id"] for r in rows} == {0}
    assert simhash.near_duplicates(docs.where("false")).collect() == []


def brute(rows, length=100):
    """Bytes covered by a string of ``length`` bytes that starts earlier too, window by window."""
    seen, out = set(), {}
    for key, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            window = data[at:at + length]
            if window in seen:
                gone[at:at + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[key] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def passage_rows():
    draw = random.Random(3)
    known = ["".join(draw.choice("abcd efgh\0é") for _ in range(draw.randint(60, 260))) for _ in range(12)]
    rows = []
    for i in range(200):
        parts = []
        for _ in range(draw.randint(0, 5)):
            text = draw.choice(known)
            a, b = draw.randint(0, 30), draw.randint(0, 30)
            own = "".join(draw.choice("xyz\0") for _ in range(draw.randint(0, 40)))
            parts.append(draw.choice([text, text[a:], text[:len(text) - b], own]))
        rows.append("".join(parts))
    return rows + [
        "a" * 1000, "ab" * 300, "a" * 99, "a" * 100, "", None, "é" * 200, "x" * 50 + "a" * 120,
        "\0" * 150, "q" + "\0" * 130 + known[0], "z" * 99, "z" * 99,
    ]


@pytest.mark.parametrize("crowd", [passages.CROWD, 2])
def test_passages_match_every_window(spark, crowd):
    texts = passage_rows()
    got = llm_data.by_id(passages.remove_repeats(llm_data.documents(spark, texts), crowd=crowd))
    want = brute(list(enumerate(texts)))
    assert len(got) == len(texts) + 1
    for key, row in want.items():
        own = got[key]
        assert (own["n_bytes"], own["n_removed"], own["n_spans"], own["kept_sha256"]) == row
        assert hashlib.sha256(own["kept"]).hexdigest() == own["kept_sha256"]


def test_passages_in_small_batches(spark):
    """Groups of one gram that reach over many batches."""
    texts = passage_rows() * 2
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "5")
    try:
        rows = passages.remove_repeats(llm_data.documents(spark, texts)).collect()
    finally:
        spark.conf.set(setting, before)
    want = brute(list(enumerate(texts)))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}
    assert {k: got[k] for k in want} == want


def test_repeated_rows_whose_grams_stand_elsewhere(spark):
    draw = random.Random(12)
    word = lambda n: "".join(draw.choice("abcdefghij ") for _ in range(n))
    shared = [word(70), word(130), word(99)]
    texts = [word(300) + shared[i % 3] + word(300) for i in range(12)]
    rows = [*enumerate(texts)]
    nameless = [word(200) + texts[1] + word(9), word(200) + texts[0][:90] + word(50)]
    want = brute([*rows, *enumerate(nameless, 100)])
    assert want[0][1] == 0 and want[4][1] > 0 and want[100][1] > 600 and want[101][1] == 0
    again = rows + rows[:5] * 3 + [rows[4]] * 40 + [(None, text) for text in nameless * 3]
    place = {text: key for key, text in [*rows, *enumerate(nameless, 100)]}
    for table in (again, again[::-1]):
        frame = spark.createDataFrame(table, "doc_id long, text string").repartition(4)
        found = passages.remove_repeats(frame, carry=("text",)).collect()
        assert len(found) == len(table)
        for r in found:
            assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[place[r["text"]]]


def test_passages_of_rows_that_share_an_id(spark):
    """Repeated rows are one document; other texts of one id are documents of their own."""
    long = " ".join(map(str, range(1000, 1060)))
    rows = [(1, long), (1, long), (1, "other " * 5), (2, long)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in passages.remove_repeats(frame).collect())
    assert got == [(1, 30, 0), (1, len(long), 0), (1, len(long), 0), (2, len(long), len(long))]


def test_queries_over_the_whole_table(spark):
    docs = spark.read.parquet(f"{llm_data.SMALL}/documents.parquet").orderBy("doc_id").collect()
    named = queries.queries()
    rows = llm_data.by_id(named["op5_simhash_groups"](spark, llm_data.SMALL))
    want = groups({d["doc_id"]: fingerprint(d["text"]) for d in docs})
    assert {k: r["component_id"] for k, r in rows.items()} == want
    cut = llm_data.by_id(named["op7_repeated_passages"](spark, llm_data.SMALL))
    want = brute([(d["doc_id"], d["text"]) for d in docs])
    got = {k: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for k, r in cut.items()}
    assert got == want and any(w[1] for w in want.values())
