import zlib

from sonoledger.llm.shards import SHARDS, byte_shards


def test_against_plain_prefix_sums(table):
    docs = table("documents")
    rows = sorted((d, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for d, t in docs.select("doc_id", "text").collect())
    total, before, want, seen = sum(r[2] for r in rows), 0, [], {}
    for d, crc, size in rows:
        shard = min(SHARDS - 1, (2 * before + size) * SHARDS // (2 * total))
        want.append((d, size, crc, "bytes", shard, seen.setdefault(shard, 0), None))
        seen[shard] += 1
        before += size
    assert sorted(map(tuple, byte_shards(docs).collect())) == want


def test_edges(make_docs, spark):
    docs = make_docs([(None, "a"), (None, None), (3, "é" * 40), (3, "é" * 40), (4, "x" * 1000), (5, "")] * 5)
    docs = docs.withColumnRenamed("lang", "shard").withColumnRenamed("source", "size")
    got = byte_shards(docs, shards=4).collect()
    assert len(got) == 30
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert sum(r.size for r in got) == 5 * (2 + 1 + 81 + 81 + 1001 + 1)
    loads = [sum(r.size for r in got if r.shard == s) for s in range(4)]
    assert max(loads) - min(loads) <= 2 * 1001
    assert byte_shards(make_docs([])).collect() == []


def test_plan_is_native(make_docs):
    plan = byte_shards(make_docs(["a", "b"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
