"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from ridgeway.llm import (
    bpe,
    components,
    content_dedup,
    impact_topk,
    jaccard_join,
    license_scan,
    mixing,
    secret_scan,
    token_counts,
    toxicity,
    warc,
)
from ridgeway.llm.queries import ASCII_PATTERN, RANK_FILE

PATH, PATTERN = public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN
DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"word{i % 977}" for i in range(60_000))
WORDS = [f"w{i}" for i in range(400)]


def sentence(seed, n=60):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


def rows_of(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs in every column, empty and blank texts, a long one, repeated rows, and
    columns whose names the operators use themselves."""
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (None, "no identifier here", "en", "a", 3),
        (3, " \n\t ", None, "a", 3), (4, sentence(1), "en", "b", 1), (5, sentence(1), "en", None, 1),
        (6, sentence(1) + " tail", "en", "b", 2), (7, LONG, "en", "b", 9), (7, LONG, "en", "b", 9),
        (8, "é \U0001f600 token = abcdef123 Cc-By", "xx", "c", 1),
    ]
    frame = spark.createDataFrame(rows, DOCUMENT)
    clash = ("row", "digest", "kept", "piece", "body", "size", "shard", "place", "block", "ids", "toxic", "n")
    return frame.select("*", *[F.lit(name).alias(name) for name in clash])


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("1 = 0")


def test_content_sort(odd, empty):
    got = rows_of(content_dedup.runs(odd), "row.doc_id", "keep_id", "group_size", "kept")
    assert sorted(got, key=repr) == sorted(
        [(1, 2, 2, False), (2, 2, 2, True), (None, None, 1, True), (3, 3, 1, True), (4, 5, 2, False),
         (5, 5, 2, True), (6, 6, 1, True), (7, 7, 2, True), (7, 7, 2, False), (8, 8, 1, True)], key=repr,
    )
    kept = content_dedup.without_copies(odd)
    assert kept.columns == odd.columns and kept.count() == 7
    assert content_dedup.runs(empty).count() == 0


def test_content_sort_splits_a_hot_text(spark):
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(3000)]
    got = content_dedup.runs(spark.createDataFrame(rows, "doc_id bigint, text string"))
    hot = got.where(F.col("row.text") == "same text")
    assert rows_of(hot.select("keep_id", "group_size").distinct(), "keep_id", "group_size") == [(2999, 2000)]
    assert hot.where("kept").count() == 1 and got.where("kept").count() == 1001


def test_jaccard(odd, empty):
    got = rows_of(jaccard_join.classes(odd), "doc_id", "class_id", "n_links", "copy_id")
    assert got == sorted(
        [(1, 1, 0, 1), (2, 2, 0, 2), (None, None, 0, None), (3, 3, 0, 3), (4, 4, 2, 4), (5, 4, 2, 4),
         (6, 4, 2, 6), (7, 7, 1, 7), (7, 7, 1, 7), (8, 8, 0, 8)], key=repr,
    )
    assert jaccard_join.classes(empty).count() == 0
    kept = jaccard_join.one_per_class(odd)
    assert kept.columns == odd.columns
    assert rows_of(kept, "doc_id") == sorted([(i,) for i in (1, 2, None, 3, 4, 7, 7, 8)], key=repr)


def test_jaccard_over_several_blocks(spark, monkeypatch):
    """A group of near copies larger than a block, next to unlike texts."""
    monkeypatch.setattr(jaccard_join, "BLOCK_WEIGHT", 3_000)
    base = sentence(5, 120).split()
    rows = []
    for i in range(60):
        words = base.copy()
        words[i] = f"other{i}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, sentence(1000 + i, 80)) for i in range(40)]
    sets = {i: set(jaccard_join.ngrams(t).tolist()) for i, t in rows}
    near = {
        i: [j for j in sets if j != i and len(sets[i] & sets[j]) * 5 >= 4 * len(sets[i] | sets[j])] for i in sets
    }
    got = jaccard_join.classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert any(near.values())
    for r in got:
        assert r["n_links"] == len(near[r["doc_id"]])
        assert r["class_id"] == (0 if r["doc_id"] < 100 else r["doc_id"])


def test_similarity_at_the_threshold_counts():
    a = jaccard_join.np.arange(90, dtype="uint64")
    b = jaccard_join.np.arange(10, 100, dtype="uint64")
    assert jaccard_join.linked([a, b], None, (4, 5), {}).tolist() == [[0, 1]]
    assert not len(jaccard_join.linked([a, b], None, (81, 100), {}))


def test_dense_and_sparse_overlaps_agree(monkeypatch):
    np = jaccard_join.np
    chooser = np.random.default_rng(1)
    sets = [np.unique(chooser.integers(0, 300, 80).astype("uint64")) for _ in range(60)]
    pairs = np.argwhere(np.triu(np.ones((60, 60), bool), 1))
    sparse = jaccard_join.overlaps(sets, sets, pairs)
    monkeypatch.setattr(jaccard_join, "DENSE_PAIRS", 1)
    monkeypatch.setattr(jaccard_join, "COLUMNS", 64)
    assert (jaccard_join.overlaps(sets, sets, pairs) == sparse).all()


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (201, 200)]
    got = components.components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b")
    roots = {r["node"]: r["root"] for r in got.collect()}
    assert roots == {
        **dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 200: 200, 201: 200
    }


def test_bpe_keeps_columns_and_round_trips(odd, empty):
    got = bpe.encode(odd, PATH, PATTERN, ASCII_PATTERN)
    assert set(got.columns) == {*odd.columns, "n_tokens", "decoded"}
    for r in got.collect():
        assert bytes(r["decoded"]).decode() == (r["text"] or "")
        assert r["n_tokens"] == len(r["ids"])
    assert bpe.encode(empty, PATH, PATTERN).count() == 0
    assert bpe.digests(empty, PATH, PATTERN).count() == 0


def test_bpe_of_hard_texts_equals_the_library():
    ranks = bpe.read_ranks(PATH)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    coder = bpe.ByteBPE(ranks, PATTERN, ASCII_PATTERN)
    chooser = random.Random(2)
    signs = [32, 10, 9, 97, 98, 233, 0x1C, 0x85, 0xA0, 0x2028, 0x3000, 0x5D0, 0x1F600, 48, 0x660, 39, 115, 46]
    texts = ["a" * 3001, "ab" * 2000, " " * 500 + "x", "'s'S don't'", "", "\n\n \t x", "日本語テキスト" * 30]
    texts += ["".join(chr(chooser.choice(signs)) for _ in range(120)) for _ in range(150)]
    texts += ["".join(chooser.choice("lowerthingstion") for _ in range(300)) for _ in range(60)]
    for text in texts:
        assert coder.encode(text) == library.encode_ordinary(text), text[:40]
    packed = coder.encode_packed(texts)
    assert [coder.decode_packed(p).decode() for p in packed] == texts


def test_rank_queue_takes_the_lowest_bucket():
    np = jaccard_join.np
    queue = bpe.RankQueue(60_000)
    queue.push(np.array([59_999, 3, 3, 4096]), np.array([0, 9, 1, 5]))
    assert [(r, sorted(p.tolist())) for r, p in (queue.pop() for _ in range(3))] == [
        (3, [1, 9]), (4096, [5]), (59_999, [0])
    ]
    assert queue.pop()[0] == -1


def test_toxicity(odd, empty, spark):
    labels = spark.createDataFrame([(1, 0), (4, None), (None, 1), (7, 0), (7, 1)], "doc_id bigint, toxic int")
    assert toxicity.train(odd, labels) is None
    none = toxicity.graded(odd, None)
    assert rows_of(none.select("severity", "toxic").distinct(), "severity", "toxic") == [(0.0, False)]
    assert none.count() == 10 and toxicity.graded(empty, None).count() == 0
    texts = [(i, f"{sentence(i)} {'nasty awful' if i % 4 == 0 else ''}") for i in range(200)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    model = toxicity.train(docs, docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic")))
    got = {r["doc_id"]: r["toxic"] for r in toxicity.graded(docs, model).collect()}
    assert got == {i: i % 4 == 0 for i in range(200)}
    assert toxicity.graded(odd, model).where("doc_id IN (1, 2, 3) AND p_toxic > 0").count() == 0


def test_toxicity_grades_share_weights():
    model = toxicity.Model({"bad$": 1.0}, [0.0, 1.0, 3.0])
    chances = model.at_least(1.0)
    assert chances == sorted(chances, reverse=True) and chances[1] == 0.5


def test_warc(spark, tmp_path):
    big = "é" * 400_000
    rows = [(1, "u1", "x"), (3, None, "x"), (2, "u\r\n2", None), (4, "u4", ""), (5, "u5", big), (None, "n", "x"),
            (6, "u6", "a\r\n\r\nWARC/1.1\r\n\r\n"), (6, "u6", "a\r\n\r\nWARC/1.1\r\n\r\n")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("sha1", F.lit("z"))
    got = rows_of(warc.round_trip(spark, pages), "page_id", "payload_bytes", "record_type", "refers_to", "intact")
    assert got == sorted(
        [(1, 1, "revisit", 3, True), (3, 1, "response", None, True), (2, 0, "revisit", 4, True),
         (4, 0, "response", None, True), (5, 800_000, "response", None, True), (None, 1, "revisit", 3, True),
         (6, 17, "response", None, True), (6, 17, "response", None, True)], key=repr,
    )
    assert warc.round_trip(spark, pages.where("1 = 0")).count() == 0
    archives = warc.write(warc.chunked(warc.planned(pages, least_bytes=10)), f"file://{tmp_path}/w")
    archives = spark.createDataFrame(archives.collect(), archives.schema).where("records > 0")
    chunks = [r for r in warc.read(archives).collect() if r["page_id"] == 5]
    assert [r["chunk_no"] for r in chunks] == list(range(4)) and [r["last"] for r in chunks] == [False] * 3 + [True]
    assert max(len(r["data"]) for r in chunks) == warc.CHUNK_BYTES
    data = b"".join(bytes(r["data"]) for r in chunks)
    assert data == big.encode()
    for i, r in enumerate(chunks):
        so_far = hashlib.sha1(data[: (i + 1) * warc.CHUNK_BYTES]).hexdigest()
        assert warc.base32(so_far) == r["running_sha1"]


def test_token_counts(spark, odd, empty, monkeypatch):
    coder = bpe.codec(PATH, PATTERN, ASCII_PATTERN)
    expected = sorted(((r["doc_id"], len(coder.encode(r["text"] or ""))) for r in odd.collect()), key=repr)
    assert rows_of(token_counts.counts(spark, odd, PATH, PATTERN, 50_256), "doc_id", "n_tokens") == expected
    # documents over many blocks, blocks without an end
    monkeypatch.setattr(token_counts, "BLOCK_TOKENS", 1_000)
    assert rows_of(token_counts.counts(spark, odd, PATH, PATTERN, 50_256), "doc_id", "n_tokens") == expected
    assert token_counts.counts(spark, empty, PATH, PATTERN, 50_256).count() == 0


def test_tokens_after_the_last_end(spark, tmp_path, monkeypatch):
    np = jaccard_join.np
    monkeypatch.setattr(token_counts, "BLOCK_TOKENS", 3)
    (tmp_path / "tokens-0.bin").write_bytes(np.array([1, 9, 9, 1, 1, 1, 1, 1, 9, 1, 1], "<u2").tobytes())
    cut = token_counts.blocks(spark, f"file://{tmp_path}", 2)
    got = token_counts.stitched(token_counts.scan(cut, 9, 2))
    assert rows_of(got, "ordinal", "n_tokens", "terminated") == [
        (0, 1, True), (1, 0, True), (2, 5, True), (3, 2, False)
    ]


def test_mixing(odd, empty):
    got = mixing.takes(odd)
    assert got.count() == 10 and mixing.takes(empty).count() == 0
    for r in got.collect():
        assert 0 <= r["taken"] <= 2 * r["size"]
    mixed = mixing.mixed(odd)
    assert mixed.columns == odd.columns
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts.get(7, 0) <= 4 and counts[1] == counts[2] == counts[3] == 1
    assert mixing.mixed(empty).count() == 0


def test_secrets(odd, empty, spark):
    got = {r["doc_id"]: secret_line(r["spans"]) for r in secret_scan.scan(odd).collect() if r["doc_id"]}
    assert got[8] == "assign:4:21" and got[1] == got[2] == got[7] == ""
    assert secret_scan.scan(empty).count() == 0
    text = "token=token: abcdefg AKIA" + "Z" * 16 + " 😀 " + "0123456789abcdef" * 2 + " x"
    rows = secret_scan.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()
    assert secret_line(rows[0]["spans"]) == "access:21:41,hex:44:76"


def secret_line(spans):
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)


def test_secrets_that_only_look_random(spark):
    """Long random strings are found once some secrets have been seen; long words are not."""
    chooser = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    secret = ["".join(chooser.choices(letters, k=32)) for _ in range(400)]
    rows = [(i, f"{sentence(i)} password: {secret[i]} internationalisation") for i in range(300)]
    plain = ["representation", "understanding", "characteristic", "administration"]
    rows += [(1000 + i, " ".join(chooser.choices(plain, k=50))) for i in range(300)]
    rows += [(5000, f"see {secret[350]} and internationalisationrepresentation")]
    got = secret_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).where("doc_id = 5000")
    assert [(s["kind"], s["start"], s["end"]) for s in got.first()["spans"]] == [("markov", 4, 36)]


def test_licenses(odd, empty, spark):
    got = {r["doc_id"]: r for r in license_scan.scan(odd).collect()}
    assert got[8]["base_labels"] == "cc-by" and got[8]["n_words"] == 6
    assert got[1]["n_words"] == 0 and got[1]["labels"] == "" and got[1]["score"] == 0
    assert license_scan.scan(empty).count() == 0
    texts = {
        1: "Licensed under the Apache License, Version 2.0 and more",
        2: "SPDX-License-Identifier: GPL-3.0-or-later",
        3: "This work is licensed under the GNU General Public License, version 3.",
        4: "Released under the MIT License.\nAll  rights\nreserved.",
        5: "mit der Zeit, under no license at all",
    }
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    labels = {r["doc_id"]: r["labels"] for r in license_scan.scan(frame).collect()}
    assert labels == {1: "apache-2.0", 2: "gpl-3.0", 3: "gpl,gpl-3.0", 4: "mit,reserved", 5: ""}


def test_license_rules_and_suppression():
    rules = license_scan.rules()
    assert len(rules) > 200 and [r.priority for r in rules] == sorted((r.priority for r in rules), reverse=True)
    high, low = rules[0], rules[-1]
    assert license_scan.suppressed([(2, 5, low), (0, 9, high), (20, 25, low), (8, 12, low)]) == [
        (0, 9, high), (20, 25, low)
    ]


def test_top_k(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (50, [0.5, 0.5]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [None, 1.0]),
            (5, [nan, 1.0]), (6, [inf, 0.0]), (7, [-1.0, 0.001]), (None, [1.0, 1.0]), (1, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("v", F.lit(1))
    vectors = impact_topk.quantised(frame)
    got = rows_of(impact_topk.top_k(vectors, F.col("vec_id") % 50 == 0, 3), "query_id", "rank", "vec_id", "score")
    assert got == [
        (0, 1, 1, 65536), (0, 2, 2, 65536), (0, 3, 50, 32768),
        (50, 1, 0, 32768), (50, 2, 1, 32768), (50, 3, 2, 32768),
    ]
    none = impact_topk.quantised(frame.where("1 = 0"))
    assert impact_topk.top_k(none, F.col("vec_id") % 50 == 0, 3).count() == 0


def test_pipeline_stages(spark):
    """Every stage on a small table with planted cases."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, folder)
        assert after.columns == docs.columns, name
        after = spark.createDataFrame(after.collect(), docs.schema)
        if name == "exact_dedup":
            assert after.count() == before.select("text").distinct().count()
        if name == "ngram_jaccard":
            assert jaccard_join.classes(after).where("n_links > 0").count() == 0
        if name == "toxicity":
            assert 0.8 * before.count() < after.count() < before.count()
        before = after
    final = corpus_pipeline.STAGES[-1][1](spark, before, folder)
    assert final.count() == before.count() and final.where("n_tokens IS NULL").count() == 0


def test_search_of_very_large_components(spark):
    """Arrays are sized by members, not by values; what passes 64 bits is clipped."""
    rows = [(i, [float(x) for x in (i * 1e9, -3.0 * i, 1e9 if i % 2 else 0.5)]) for i in range(200)]
    rows += [(200, [1e300, 0.0, 0.0]), (201, [-1e300, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    vectors = impact_topk.quantised(frame)
    exact = {r["vec_id"]: r["v"] for r in vectors.collect()}
    got = rows_of(impact_topk.top_k(vectors, F.col("vec_id") % 50 == 0, 5), "query_id", "rank", "vec_id", "score")
    clip = 2**63 - 1
    for query in range(0, 201, 50):
        scores = [(-max(-clip - 1, min(clip, sum(a * b for a, b in zip(exact[query], v, strict=True)))), i)
                  for i, v in exact.items() if i != query]
        want = [(query, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:5], 1)]
        assert [g for g in got if g[0] == query] == want


@pytest.mark.parametrize("spread", [1, 40, 10**6])
def test_posting_segments_are_exact(spread):
    import numpy as np

    draw = np.random.default_rng(spread)
    x = (draw.standard_cauchy((300, 7)) * spread).astype("int64")
    index = impact_topk.BlockIndex(x)
    for query in range(0, 300, 17):
        members, scores = index.search(x[query], 5, query)
        found = members[np.lexsort((members, -scores))[:5]]
        others = np.delete(np.arange(300), query)
        full = (x @ x[query])[others]
        assert found.tolist() == others[np.lexsort((others, -full))[:5]].tolist()


def test_long_pre_tokens_of_common_syllables():
    """Ranks whose merging can make a lower rank are merged by the bucket as well."""
    import time

    coder = bpe.codec(PATH, PATTERN)
    library = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    syllables = ["st", "th", "and", "an", "er", "in", "ion", "ing", "the", "re", "ou", "a", "e", "t", "tion"]
    for seed in range(60):
        draw = random.Random(seed)
        pool = syllables if seed % 2 else "abcdeinrstéç"
        text = "".join(draw.choice(pool) for _ in range(draw.randint(1, 3000)))
        assert coder.encode(text) == library.encode_ordinary(text), seed
    long = "".join(random.Random(7).choice(syllables) for _ in range(500_000))
    started = time.time()
    packed = coder.encode_packed([long])[0]
    assert time.time() - started < 20
    assert coder.decode_packed(packed) == long.encode() and coder.encode(long) == library.encode_ordinary(long)
