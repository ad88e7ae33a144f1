import collections
import zlib
from itertools import product

import pytest

from jobloom.llm import sharding


@pytest.mark.parametrize(("dimensions", "bits"), [(1, 4), (2, 3), (3, 4), (4, 2)])
def test_curve_visits_every_cell_and_moves_one_step(dimensions, bits):
    places = sharding.curve_places(dimensions, bits)
    cells = list(product(range(1 << bits), repeat=dimensions))
    assert sorted(places) == list(range(len(cells)))
    along = [cell for _, cell in sorted(zip(places, cells, strict=True))]
    for a, b in zip(along, along[1:], strict=False):
        assert sum(abs(x - y) for x, y in zip(a, b, strict=True)) == 1


def check(rows, texts, shards=40):
    shape = collections.defaultdict(list)
    for r in rows:
        shape[r["shard"]].append((r["slot"], r["curve"]))
    counts = [len(shape[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(shape) <= set(range(shards))
    last = -1
    for s in range(shards):
        places = sorted(shape[s])
        assert [slot for slot, _ in places] == list(range(len(places)))
        for _, curve in places:  # runs of the curve
            assert curve >= last
            last = curve
    want = collections.Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in texts)
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want


def test_whole_table_prunes_in_several_dimensions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sharding.hilbert_shards(docs, shards=10, carry=("lang", "source")).collect()
    check(rows, [(d.doc_id, d.text) for d in docs.collect()], 10)
    spread = collections.defaultdict(set)
    for r in rows:
        spread[r["shard"]].add(r["row"]["lang"])
    assert sum(map(len, spread.values())) < 0.75 * 4 * len(spread)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs, tmp_path):
    check(sharding.hilbert_shards(odd_docs).collect(), [(r[0], r[1]) for r in odd_rows])
    assert sharding.hilbert_shards(no_docs).collect() == []
    sharding.write_shards(odd_docs, str(tmp_path / "out"), shards=4, dimensions=("source", "n_chars"))
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert set(stored.columns) == {*odd_docs.columns, "shard"} and stored.count() == len(odd_rows)
    with pytest.raises(ValueError, match="too many cells"):
        sharding.hilbert_shards(odd_docs, bits=8)


def test_plan_has_no_python(odd_docs):
    assert "Python" not in sharding.hilbert_shards(odd_docs)._jdf.queryExecution().executedPlan().toString()
