import pytest
from helpers import hard_documents, no_documents, rows_of
from pyspark.sql import functions as F

from logweir.llm.sharding import locate, op9_feistel_shards, permute, shard

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 24, 97, 1000, 1024])
def test_permutation_is_a_bijection_and_locate_agrees(spark, rows):
    numbers = spark.range(rows).select("id", permute(F.col("id"), rows, seed=5).alias("p"))
    got = {r.id: r.p for r in numbers.collect()}
    assert sorted(got.values()) == list(range(rows))
    assert all(locate(i, rows, 5, seed=5) == (p % 5, p // 5) for i, p in got.items())
    with pytest.raises(ValueError):
        locate(rows, rows, 5)


def check_shards(rows, shards):
    counts = {}
    for s, slot in rows:
        counts.setdefault(s, []).append(slot)
    total = sum(map(len, counts.values()))
    assert all(sorted(v) == list(range(len(v))) for v in counts.values())
    sizes = [len(counts.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == total


def test_query(spark):
    got = op9_feistel_shards(spark, SF).collect()
    check_shards([(r.shard, r.slot) for r in got], 24)
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    import zlib

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in got:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 8, zlib.crc32(data))


def test_hard_rows_and_any_partitioning(spark):
    docs = hard_documents(spark)
    one = rows_of(shard(docs.coalesce(1), 5), "doc_id", "text", "shard", "slot")
    many = rows_of(shard(docs.repartition(7), 5), "doc_id", "text", "shard", "slot")
    assert one == many and len(one) == docs.count()
    check_shards([r[2:] for r in one], 5)
    assert shard(docs, 5).columns == [*docs.columns, "shard", "slot"]
    assert shard(no_documents(spark)).count() == 0
    with pytest.raises(ValueError):
        shard(docs, 0)
