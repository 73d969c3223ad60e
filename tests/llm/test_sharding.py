import zlib

from forgeline.llm import sharding as H
from forgeline.llm.sharding import Shard


def rows(n=3000):
    return [(i, f"text {i % 50}") for i in range(n)] + [(None, "x"), (None, "y"), (5000, None), (5001, ""), (7, "text 7"), (7, "text 7")]


def test_contract(frame):
    data = rows()
    got = H.shard_documents(frame(data), H.topology(8), H.topology(9)).collect()
    assert len(got) == len(data)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == sorted(
        ((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in data), key=str)
    for s in range(8):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots))) and 0.85 < len(slots) / (len(data) / 8) < 1.15
    assert all(r.grown_shard in (r.shard, 8) for r in got)
    moved = sum(r.grown_shard == 8 for r in got) / len(got)
    assert 0.07 < moved < 0.16
    again = {r.doc_id: r.shard for r in H.shard_documents(frame(data[:500]), H.topology(8), H.topology(9)).collect()}
    assert all(again[r.doc_id] == r.shard for r in got if r.doc_id in again)


def test_weights_and_confined_movement(frame):
    from pyspark.sql import functions as F

    before = [Shard(0, 0, 0, 1.0), Shard(0, 0, 1, 3.0), Shard(0, 1, 2, 2.0), Shard(1, 2, 3, 2.0)]
    after = [Shard(0, 0, 0, 1.0), Shard(0, 0, 1, 1.0), Shard(0, 1, 2, 4.0), Shard(1, 2, 3, 2.0)]  # inside region 0 alone
    df = frame([(i, "t") for i in range(8000)]).select("doc_id")
    df = H.descend(H.descend(df, F.col("doc_id").cast("string"), before), F.col("doc_id").cast("string"), after, "new_")
    got = df.collect()
    share = [sum(r.shard == s for r in got) / len(got) for s in range(4)]
    assert all(abs(a - b) < 0.03 for a, b in zip(share, (1 / 8, 3 / 8, 2 / 8, 2 / 8), strict=True))
    assert all(r.new_region == r.region for r in got)  # its region's weight hasn't changed
    assert {r.new_shard for r in got if r.shard == 3} == {3}


def test_empty(frame):
    assert H.shard_documents(frame([]), H.topology(8), H.topology(9)).count() == 0
