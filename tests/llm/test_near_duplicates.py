import collections
import random

import pytest

from jobloom.llm import near_duplicates as near
from jobloom.llm.components import connected
from tests.llm.brute import groups, shingles


def test_components(spark):
    draw = random.Random(2)
    edges = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7)]
    label = {v: v for e in edges for v in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    touched = {v for a, b in edges for v in (a, b) if a != b}
    got = {r["vertex"]: r["component"] for r in connected(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()}
    assert got == {v: label[v] for v in touched}


def test_prefixes_shorten_until_the_recall_is_reached():
    forest = near.Forest()
    length = forest.length(0.8)
    assert forest.recall(length, 0.8) >= forest.target > forest.recall(length + 1, 0.8)
    assert near.Forest(target=0.5).length(0.8) > length


def check(rows, docs):
    """docs: (id, text). Groups, links and copies against all pairs; one document of a group is first."""
    label, links = groups([t for _, t in docs])
    ids = [i for i, _ in docs]
    order = lambda i: (i is None, i or 0)
    members, sets = collections.defaultdict(list), collections.defaultdict(list)
    for place, (doc, text) in enumerate(docs):
        members[label[place]].append(doc)
        sets[frozenset(shingles(text)) or place].append(doc)
    want = collections.Counter(
        (doc, min(members[label[p]], key=order), min(sets[frozenset(shingles(text)) or p], key=order), links[p]) for p, (doc, text) in enumerate(docs)
    )
    assert collections.Counter((r["doc_id"], r["class_id"], r["copy_of"], r["n_links"]) for r in rows) == want
    assert sum(r["first"] for r in rows) == len(members)
    assert all(r["doc_id"] == r["class_id"] for r in rows if r["first"]) and len(ids) == len(rows)


def near_copies(seed, copies, lengths=(12, 120)):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefgh", k=4))
    docs = []
    for _ in range(copies):
        base = [word() for _ in range(draw.randint(*lengths))]
        for _ in range(draw.randint(1, 12)):
            text = list(base)
            for _ in range(draw.randint(0, 4)):
                text[draw.randrange(len(text))] = word()
            docs.append(" ".join(text))
    draw.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("blocks", [1500, 4])
def test_near_copies(spark, monkeypatch, blocks):
    monkeypatch.setattr(near, "BLOCK_CLASSES", blocks)  # with 4, groups are compared block by block
    docs = near_copies(1, 25)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    check(near.join(frame).collect(), docs)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    check(near.join(odd_docs, carry=tuple(odd_docs.columns)).collect(), [(r[0], r[1]) for r in odd_rows])
    assert near.join(no_docs).collect() == []
