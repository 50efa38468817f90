import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from eventlake.llm import sharding
from eventlake.llm.queries import op11_sharding
from tests.conftest import SF001
from tests.llm.conftest import doc_frame


def check_shards(rows, n, shards):
    """Counts at most one apart, slots gapless; rows are (shard, slot)."""
    of = defaultdict(list)
    for s, t in rows:
        of[s].append(t)
    counts = [len(of[s]) for s in range(shards)]
    assert set(of) <= set(range(shards)) and sum(counts) == n and max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in of.values())


def test_query(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    got = op11_sharding(spark, SF001).collect()
    check_shards([(r.shard, r.slot) for r in got], len(docs), 8)
    text = {d.doc_id: (d.text or "").encode() for d in docs}
    assert Counter(r.doc_id for r in got) == Counter(d.doc_id for d in docs)
    for r in got:
        assert r.size == len(text[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id])
        assert r.law == "rows" and r.grown_shard is None
    order = [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    up = sum(a < b for a, b in zip(order, order[1:])) / (len(order) - 1)
    assert 0.35 < up < 0.65  # shuffled, not in the table's order
    again = {(r.doc_id, r.shard, r.slot) for r in op11_sharding(spark, SF001).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in got}


@pytest.mark.parametrize("bucket", [1, 40, 1_000_000])
def test_every_row_has_one_place(spark, bucket):
    rows = [(i % 7, "t" * (i % 30)) for i in range(300)] + [(None, None)] * 150 + [(1, ""), (2, "é" * 5000)]
    df = doc_frame(spark, rows).withColumnRenamed("lang", "draw").withColumnRenamed("source", "bucket").withColumn(
        "row", F.create_map(F.lit("at"), F.lit(1)))
    out = sharding.shuffle_shards(df.repartition(3), shards=5, bucket_bytes=bucket)
    assert out.columns == [*df.columns, "shard_size", "shard_no", "shard_slot"]
    got = out.collect()
    check_shards([(r.shard_no, r.shard_slot) for r in got], len(rows), 5)
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    assert all(r.shard_size == len((r.text or "").encode()) + 1 and r.row == {"at": 1} for r in got)


def test_a_hot_row_spreads_over_the_buckets(spark, monkeypatch):
    seen = {}
    whole = sharding.stage_counted

    def kept(df, name, **kw):
        out = whole(df, name, **kw)
        seen[name] = out[0]
        return out

    monkeypatch.setattr(sharding, "stage_counted", kept)
    sharding.shuffle_shards(doc_frame(spark, [(None, "x" * 99)] * 4000), bucket_bytes=10_000)
    sizes = [r["count"] for r in seen["shard_buckets"].groupBy("bucket").count().collect()]
    assert len(sizes) == 40 and max(sizes) < 200


def test_edges_and_bucket_starts(spark):
    assert sharding.shuffle_shards(doc_frame(spark, [])).collect() == []
    got = sharding.shuffle_shards(doc_frame(spark, [(1, "a"), (2, None)]), shards=8).collect()
    check_shards([(r.shard_no, r.shard_slot) for r in got], 2, 8)
    with pytest.raises(ValueError):
        sharding.shuffle_shards(doc_frame(spark, []).withColumn("shard_no", F.lit(1)))
    counts = [(b, b % 5 + 1) for b in range(0, 20_000, 3)]
    starts = {r.bucket: r.start for r in sharding.bucket_starts(spark.createDataFrame(counts, "bucket long, n long")).collect()}
    upto = 0
    for b, n in counts:
        assert starts[b] == upto
        upto += n


def test_native_and_written(spark, tmp_path):
    out = sharding.shuffle_shards(doc_frame(spark, [(i, f"text {i}") for i in range(100)]), shards=4, bucket_bytes=50)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    sharding.write_shards(out, str(tmp_path / "shards"))
    rows = sharding.read_shard(spark, str(tmp_path / "shards"), 2).collect()
    assert [r.shard_slot for r in rows] == list(range(25))
