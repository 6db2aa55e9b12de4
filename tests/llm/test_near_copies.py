"""Near copies against brute-force Jaccard of five-word shingles."""

import random

import corpus_pipeline
import pytest

from opsloom.llm import near_copies

FOLDER = "/root/testdata/sf0.01"


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(texts):
    """Smallest id reachable over pairs of similarity 0.8 or more."""
    sets = {k: shingles(t) for k, t in texts.items()}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            common = len(sets[a] & sets[b])
            if sets[a] == sets[b] or common >= 0.8 * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {k: find(k) for k in keys}


def least_ids(rows):
    least = {}
    for row in rows:
        least[row["group"]] = min(row["doc_id"], least.get(row["group"], row["doc_id"]))
    return {row["doc_id"]: least[row["group"]] for row in rows}


def edited():
    draw = random.Random(5)
    base = [[f"w{draw.randrange(900)}" for _ in range(draw.choice([30, 120, 300]))] for _ in range(12)]
    out = ["", None, "one two", "One  two", "one two three four five six"]
    for _ in range(150):
        words = list(draw.choice(base))
        for _ in range(draw.randint(0, len(words) // 25)):
            words[draw.randrange(len(words))] = f"w{draw.randrange(900)}"
        out.append(" ".join(words))
    return out


def test_groups_match_brute_force_jaccard(spark):
    texts = dict(enumerate(edited()))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert least_ids(near_copies.near_copies(docs).collect()) == brute(texts)


def test_stage_leaves_no_near_copies(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    want = brute({r["doc_id"]: r["text"] for r in docs.collect()})
    left = corpus_pipeline.drop_near_copies(spark, docs, FOLDER)
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(set(want.values()))


def test_large_group_makes_few_pairs(spark):
    draw = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(300):
        own = list(words)
        own[draw.randrange(400)] = "x"
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert set(least_ids(near_copies.near_copies(docs).collect()).values()) == {0}


def family(count, most, seed):
    """Texts with one to ``most`` changed words out of 200 of one text."""
    draw = random.Random(seed)
    words = [f"w{draw.randrange(2000)}" for _ in range(200)]
    texts = []
    for _ in range(count):
        own = list(words)
        for at in draw.sample(range(200), draw.randint(1, most)):
            own[at] = f"x{draw.randrange(100_000)}"
        texts.append(" ".join(own))
    return dict(enumerate(texts))


@pytest.mark.parametrize("count, most, seed", [(300, 4, 1), (300, 10, 2), (2000, 10, 3)])
def test_large_groups_lose_few_links(spark, count, most, seed):
    """Above ``crowd`` members a link can be lost; no documents are grouped that are not linked."""
    texts = family(count, most, seed)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got, want = least_ids(near_copies.near_copies(docs).collect()), brute(texts)
    assert sum(got[k] != want[k] for k in want) <= 0.01 * count
    assert all(want[k] == want[least] for k, least in got.items())


def test_rows_that_share_an_id_but_not_a_text_stay(spark):
    one, two = "a b c d e f g h i", "r s t u v w x y z"
    rows = [(1, one, "fr"), (1, two, "en"), (1, one, "en"), (2, two, "en"), (3, None, "en")]
    for parts in (1, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(parts)
        left = corpus_pipeline.drop_near_copies(spark, docs, FOLDER).collect()
        assert sorted(map(tuple, left), key=str) == [(1, one, "en"), (1, two, "en"), (3, None, "en")]
