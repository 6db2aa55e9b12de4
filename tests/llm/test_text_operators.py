"""Toxicity, line quality and secrets on small cases and whole tables."""

import base64
import bz2
import collections
import gzip
import hashlib
import re
import urllib.parse
import zlib

import llm_data
import numpy as np
import pytest

from opsloom.llm import line_quality, queries, secrets, toxicity

# --- toxicity ----------------------------------------------------------------------------

INSULTS = ["moron", "scum", "trash"]


def labelled(count=240):
    """Insults mostly beside one group's name, so the name alone looks toxic without swaps."""
    rows = []
    for i in range(count):
        filler = f"note{i % 17} about weather{i % 13} and trains{i % 11}."
        if i % 3 == 0:
            rows.append((f"The muslims are {INSULTS[i % 3]} {INSULTS[(i // 3) % 3]}. {filler}", 1))
        else:
            rows.append((f"The {'christians' if i % 3 == 1 else 'teachers'} met today. {filler}", 0))
    return rows


def model_of(rows, penalty):
    swaps = toxicity.swapped_terms(toxicity.GROUP_TERMS)
    pairs = [p for t, _ in rows for p in toxicity.counterfactuals(t, swaps)]
    return toxicity.fit([toxicity.bag(t) for t, _ in rows], [y for _, y in rows], pairs, penalty)


def score(model, text):
    return model.score(toxicity.WORD.findall(text.lower()), {})


def test_counterfactuals_swap_group_terms_by_sentence():
    swaps = toxicity.swapped_terms([("women", "men")])
    [(before, after)] = toxicity.counterfactuals("Rain today. Women work here. Sun later.", swaps)
    assert before.tolist() == toxicity.bag("women work here").tolist()
    assert after.tolist() == toxicity.bag("men work here").tolist()
    assert toxicity.counterfactuals("Nobody is named.", swaps) == []


def test_penalty_lowers_scores_of_neutral_mentions():
    rows = labelled()
    plain, fair = model_of(rows, 0.0), model_of(rows, 20.0)
    neutral, insult = "The muslims met in town", "You are moron scum trash"
    assert score(fair, neutral) < score(plain, neutral)
    gap = lambda m: abs(score(m, neutral) - score(m, "The christians met in town"))
    assert gap(fair) < 0.5 * gap(plain)
    assert score(fair, insult) >= 0.3


def test_fit_without_both_classes_is_the_rate():
    none = toxicity.fit([], [], [])
    assert none.weights == {} and score(none, "anything") < 0.3
    clean = toxicity.fit([toxicity.bag("a b")] * 5, [0] * 5, [])
    assert score(clean, "a b") < 0.3


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = llm_data.by_id(queries.queries()["op3_toxicity"](spark, folder))
    docs = spark.read.parquet(f"{folder}/documents.parquet").count()
    assert len(rows) == docs
    for key, row in rows.items():
        assert row["held_out"] == (zlib.crc32(str(key).encode()) % 4 == 2)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.3)
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    unseen = [(rows[r["doc_id"]]["predicted"], r["toxic"]) for r in labels if rows[r["doc_id"]]["held_out"]]
    caught = [p for p, t in unseen if t == 1]
    clean = [p for p, t in unseen if t == 0]
    assert np.mean(caught) >= 0.6 and np.mean(clean) <= 0.02


def test_toxicity_on_awkward_rows(spark):
    texts = llm_data.awkward()
    docs = llm_data.documents(spark, texts)
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(20)] + [(None, 1), (3, None), (3, 1), (10_000, 1)],
        "doc_id long, toxic int",
    )
    model = toxicity.fit_toxicity(docs, labels)
    rows = toxicity.score_toxicity(docs, model).collect()
    assert len(rows) == len(texts) + 1 and all(0 <= r["score"] <= 1 for r in rows)
    empty = toxicity.fit_toxicity(docs, labels.where("false"))
    assert {r["predicted"] for r in toxicity.score_toxicity(docs, empty).collect()} == {0}
    assert toxicity.score_toxicity(docs.where("false"), model).collect() == []


# --- line quality ------------------------------------------------------------------------

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    text = text or ""
    words = SPACE.findall(text)
    lines, seen = 0, set()
    for line in text.split("\n"):
        if SPACE.search(line):
            lines += line in seen
            seen.add(line)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    inside = {j for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in range(i, i + 3)}
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(inside), failed)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


@pytest.mark.parametrize("line, fault", [
    ("A plain sentence about the weather.", None),
    ("A line that goes on and on. And never closes its second sentence at the end", None),
    ("", None),
    ("Home | About | Contact | Help", "navigation"),
    ("Please accept cookies to go on", "boilerplate"),
    ("BUY THIS NOW OR LOSE IT!! HURRY UP!!", "shouted"),
    ("word%% other## more** and$$ so&& on%%", "symbols"),
    ("one two three four five six seven eight nine ten eleven twelve", "punctuation"),
])
def test_line_rules(line, fault):
    assert line_quality.line_fault(line) == fault


def test_cleaning_keeps_good_lines_and_rejects_losers():
    good = [f"Line{i} tells{i} of{i} one{i} thing{i} and{i} then{i} ends{i}." for i in range(12)]
    lines, words, repeats = line_quality.cleaned("\n".join([*good, "Home | News | Help", good[0]]))
    assert lines == good and words == 96 and repeats == 1
    bad = [f"A{i} | B{i} | C{i} | D{i} | E{i}" for i in range(30)]
    rules = line_quality.LineRules()
    assert line_quality.judged("\n".join([*good, bad[0]]).encode(), rules)[6] is True
    assert line_quality.judged("\n".join([*good, *bad]).encode(), rules)[6] is False


def test_base_counts_on_awkward_rows(spark):
    texts = llm_data.awkward() + ["a b c d a b c\na b c d\na b c d \x1c x\x85y z"] + ["same line\n" * 40]
    rows = llm_data.by_id(line_quality.clean_lines(llm_data.documents(spark, texts)))
    for i, text in enumerate(texts):
        assert tuple(rows[i][c] for c in COUNTS) == base_counts(text), text
        assert not (rows[i]["base_failed"] and rows[i]["kept"])
    empty = llm_data.documents(spark, []).where("false")
    assert line_quality.clean_lines(empty).collect() == []


def test_clean_documents_are_kept(spark):
    folder = "/root/testdata/sf0.01"
    rows = llm_data.by_id(queries.queries()["op8_line_quality"](spark, folder))
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    for doc in docs:
        assert tuple(rows[doc["doc_id"]][c] for c in COUNTS) == base_counts(doc["text"])
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    judged = [(rows[r["doc_id"]], r["quality"]) for r in labels]
    assert np.mean([r["kept"] for r, q in judged if q == 1 and not r["base_failed"]]) >= 0.99
    assert not any(r["kept"] for r, q in judged if q == 0)


# --- secrets -----------------------------------------------------------------------------

SECRET = 'password = "Abcdefgh1234"'


def b64(data):
    return base64.b64encode(data if isinstance(data, bytes) else data.encode()).decode()


def plain_spans(text):
    """The base patterns as they are stated."""
    assign = re.compile(
        r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"
        r"[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    )
    out = [("assign", m.start(), m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


@pytest.mark.parametrize("wrapped", [
    b64(SECRET), b64(b64(SECRET)), urllib.parse.quote(SECRET, safe=""), b64(gzip.compress(SECRET.encode())),
    b64(zlib.compress(SECRET.encode())), b64(bz2.compress(SECRET.encode())),
    b64(gzip.compress(("see " + b64(SECRET)).encode())), urllib.parse.quote(b64(SECRET) + "=", safe=""),
    "".join(f"\\u{ord(c):04x}" for c in SECRET), "\\u0070assword%3dAbcdefgh1234",
    base64.urlsafe_b64encode(("é?>" + SECRET).encode()).decode(),
])
def test_wrapped_secrets_are_found_where_they_lie(wrapped):
    text = f"é before {wrapped} after"
    plain, every = secrets.all_spans(text)
    assert plain == [] and {k for k, _, _ in every} == {"assign"}
    for _, start, end in every:
        assert 9 <= start < end <= 9 + len(wrapped)
    assert "Abcdefgh1234" not in secrets.masked(text, every)


def test_layers_do_not_run_in_circles():
    for text in ["%25" * 2000, "%2525252525", b64(b64(b64("nothing here at all"))), "\\u005cu005cu005c" * 50]:
        assert secrets.all_spans(text)[1] == []


def test_bombs_are_bounded():
    bomb = b64(gzip.compress(b"a" * 5_000_000))
    assert secrets.all_spans(f"x {bomb} y", most=1 << 20) == ([], [])


def test_masking_merges_overlaps():
    text = 'token = "0123456789abcdef0123456789abcdef" end'
    plain, every = secrets.all_spans(text)
    assert [k for k, _, _ in plain] == ["assign", "hex"] and plain == every
    assert secrets.masked(text, every) == '[assign]" end'


def test_base_spans_on_awkward_rows(spark):
    marks = ["Token: abcdefgh", "ſecret=abcdefgh12", "toKen=abcdefgh12", "api_key='x'", "APIKEY  :\t12345678",
             "passwd=short secret=longenough1", "AKIA" + "A" * 20, "xAKIAAKIAAKIAAKIAA", "AKIA12",
             "f" * 31, "0" * 32 + "g" + "a" * 40, "é" * 30 + "deadbeef" * 5, SECRET * 3, "password=password=12345678"]
    texts = llm_data.awkward() + marks
    rows = llm_data.by_id(secrets.scan_secrets(llm_data.documents(spark, texts), with_text=True))
    assert len(rows) == len(texts) + 1
    for i, text in enumerate(texts):
        plain = [tuple(s) for s in rows[i]["plain"]]
        assert plain == plain_spans(text or ""), text
        assert set(plain) <= {tuple(s) for s in rows[i]["spans"]}
    empty = llm_data.documents(spark, []).where("false")
    assert secrets.scan_secrets(empty).collect() == []


def test_secret_query_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = llm_data.by_id(queries.queries()["op9_secret_spans"](spark, folder))
    found = 0
    for doc in spark.read.parquet(f"{folder}/documents.parquet").collect():
        plain, row = plain_spans(doc["text"]), rows[doc["doc_id"]]
        found += len(plain)
        assert [row[f"n_{k}"] for k in secrets.KINDS] == [sum(s[0] == k for s in plain) for k in secrets.KINDS]
        assert row["base_sha256"] == hashlib.sha256(secrets.shown(plain).encode()).hexdigest()
        assert set(filter(None, secrets.shown(plain).split(","))) <= set(row["spans"].split(","))
    assert found
