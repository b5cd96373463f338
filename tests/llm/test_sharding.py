"""Minimax contiguous shards: against all partitions, with outsized groups, and odd input."""

import random
import zlib
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from ridgeway.llm import sharding

SCHEMA = "doc_id bigint, text string"


def best(sizes, shards):
    """The least greatest sum of contiguous parts, by trying all cuts."""
    n = len(sizes)
    found = sum(sizes)
    for k in range(min(shards, n)):
        for cuts in combinations(range(1, n), k):
            edges = [0, *cuts, n]
            found = min(found, max(sum(sizes[a:b]) for a, b in zip(edges, edges[1:], strict=False)))
    return found


def ends_of(spark, sizes):
    total, rows = 0, []
    for size in sizes:
        total += size
        rows.append((total,))
    return spark.createDataFrame(rows, "end bigint"), total


@pytest.mark.parametrize("cells", [8, 1 << 16])
def test_capacity_is_the_smallest(spark, cells):
    for seed in range(2):
        draw = random.Random(seed)
        sizes = [draw.randint(1, 60) for _ in range(14)]
        ends, total = ends_of(spark, sizes)
        for shards in (1, 4):
            known = sharding.Boundaries(ends, total, cells)
            capacity = sharding.smallest_capacity(known, shards, max(sizes))
            assert capacity == best(sizes, shards)
            cuts = [0, *sharding.cut_points(known, shards, capacity), total]
            parts = [b - a for a, b in zip(cuts, cuts[1:], strict=False)]
            assert sum(parts) == total and 0 <= min(parts) and max(parts) <= capacity
            assert set(cuts) <= {0} | {r.end for r in ends.collect()}


def test_outsized_groups_fill_shards_by_themselves():
    assert sharding.outsized([50, 30, 5, 5, 5, 5], 100, 4) == 2
    assert sharding.outsized([1, 1, 1, 1], 4, 4) == 0
    assert sharding.outsized([9], 9, 3) == 1


def test_a_third_of_all_rows_in_one_group(spark):
    rows = [(i, "the same text" if i % 3 == 0 else f"text number {i}") for i in range(3000)]
    got = sharding.places(spark.createDataFrame(rows, SCHEMA)).toPandas()
    text = dict(rows)
    assert (got.text_crc32 == [zlib.crc32(text[i].encode()) for i in got.doc_id]).all()
    assert (got["size"] == [len(text[i]) + 1 for i in got.doc_id]).all()
    hot = got[got.doc_id % 3 == 0]
    assert hot.shard.nunique() == 1 and set(got[got.shard == hot.shard.iloc[0]].doc_id) == set(hot.doc_id)
    rest = got[got.doc_id % 3 != 0].groupby("shard")["size"].sum()
    assert len(rest) == 15 and rest.max() - rest.min() <= 40
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
        assert list(part.sort_values("slot").doc_id) == sorted(part.doc_id)


def test_odd_rows(spark, tmp_path):
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [(1, None), (2, ""), (None, "é"), (3, "é"), (4, long), (4, long), (5, " ")]
    frame = spark.createDataFrame(rows, SCHEMA).select(
        "*", *[F.lit(c).alias(c) for c in ("shard", "digest", "size", "slot", "end")]
    )
    got = sharding.places(frame).collect()
    assert len(got) == 7 and all(r.law == "bytes" and r.grown_shard is None for r in got)
    of = {}
    for r in got:
        of.setdefault(r.doc_id, set()).add((r.size, r.text_crc32, r.shard))
    assert of[1] == of[2] and {(1, 0)} == {x[:2] for x in of[1]}
    assert of[None] == of[3] and {x[0] for x in of[3]} == {3}
    assert len(of[4]) == 1
    for shard in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    nothing = sharding.places(frame.where("1 = 0"))
    assert nothing.count() == 0 and nothing.columns == sharding.places(frame).columns
    sharding.write_shards(frame, str(tmp_path / "out"), shards=3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 7 and set(back.columns) == set(frame.columns)
    per_text = back.groupBy(F.coalesce("text", F.lit(""))).agg(F.countDistinct("shard").alias("n"))
    assert per_text.where("n > 1").count() == 0
    with pytest.raises(ValueError):
        sharding.plan(frame, shards=0)
