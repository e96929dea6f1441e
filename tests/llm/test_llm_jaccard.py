"""The n-gram Jaccard join against all pairs."""

import random
import re

import pytest

from opsframe.llm.components import connected_components
from opsframe.llm.jaccard_join import similar_documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    label = {i: i for i, _ in rows}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if None not in (i, j) and a and b and 100 * len(a & b) >= 80 * len(a | b):
                low, high = sorted((find(i), find(j)))
                label[high] = low
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=str)


def altered(rng, words, share):
    return [rng.choice("pqrstuvw") * 3 + str(rng.randrange(50)) if rng.random() < share else w for w in words]


def corpus(seed):
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(60)}" for _ in range(rng.choice([3, 6, 40, 90, 200]))] for _ in range(8)]
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "One"), (4, "one"), (5, "one two"), (None, "one"), (None, "one")]
    for n in range(10, 170):
        words = altered(rng, rng.choice(base), rng.choice([0, 0, 0.01, 0.02, 0.03, 0.05]))
        if rng.random() < 0.3:
            words = words + rng.choice(base)[:20]
        text = " ".join(words)
        rows.append((n, text.upper() if rng.random() < 0.2 else text))
    rng.shuffle(rows)
    return rows + rows[:5]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, node int, sig string")
    got = similar_documents(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_no_rows(spark):
    assert similar_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(20, 60)] + [(100, i) for i in range(101, 130)] + [(5, 5)]
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    label = {r.node: r.label for r in found}
    assert {label[i] for i in range(20, 61)} == {20}
    assert {label[i] for i in range(100, 130)} == {100}
    assert 5 not in label


def test_rows_that_repeat_many_times(spark):
    near = " ".join(f"w{i}" for i in range(200))
    rows = [(1, near), (2, near + " more")] * 4000 + [(3, "something else that is long enough")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = similar_documents(docs).groupBy("doc_id", "component_id").count().collect()
    assert {(r.doc_id, r.component_id, r["count"]) for r in got} == {(1, 1, 4000), (2, 1, 4000), (3, 3, 50)}


def test_mirrored_words_are_not_alike(spark):
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    mirror = word.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, word), (2, mirror), (3, f"{word} {mirror}"), (4, f"{mirror} {word}")], "doc_id long, text string")
    assert all(r.doc_id == r.component_id for r in similar_documents(docs).collect())
