"""Registered corpus queries against brute force on the small tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from ridgeway.llm import bpe, impact_topk, jaccard_join, mixing, toxicity
from ridgeway.llm.oracle import statements
from ridgeway.llm.queries import RANK_FILE, registered

SMALL = "/root/testdata/sf0.001"


def result(spark, name, folder=SMALL):
    return [r.asDict() for r in registered()[name](spark, folder).collect()]


def documents(folder=SMALL):
    rows = duckdb.sql(f"SELECT doc_id, text, source FROM '{folder}/documents.parquet'").fetchall()
    return {i: (text or "", source) for i, text, source in rows}


@pytest.fixture(scope="module")
def tokenizer():
    ranks = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.mark.parametrize("name", sorted(statements()))
def test_queries_agree_with_their_sql(spark, name):
    database = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    wanted = database.execute(statements()[name])
    names = [d[0] for d in wanted.description]
    got = [tuple(r[n] for n in names) for r in result(spark, name)]
    assert sorted(got, key=repr) == sorted(wanted.fetchall(), key=repr)


def test_jaccard_links_and_classes(spark):
    grams = {}
    for i, (text, _) in documents().items():
        words = text.lower().split()
        n = min(5, len(words))
        grams[i] = {tuple(words[j : j + n]) for j in range(len(words) - n + 1)} if n else set()
    near = defaultdict(set)
    for a in grams:
        for b in grams:
            if a < b and grams[a] and grams[b]:
                common = len(grams[a] & grams[b])
                if common * 5 >= 4 * (len(grams[a]) + len(grams[b]) - common):
                    near[a].add(b)
                    near[b].add(a)

    def least(i):
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        return min(seen)

    rows = result(spark, "op1_ngram_jaccard")
    assert len(rows) == len(grams)
    for r in rows:
        assert r["n_links"] == len(near[r["doc_id"]]), r
        assert r["class_id"] == least(r["doc_id"]), r


def test_bpe_equals_the_library(spark, tokenizer):
    texts = documents()
    for r in result(spark, "op2_bpe_round_trip"):
        text = texts[r["doc_id"]][0]
        ids = tokenizer.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_token_counts_equal_the_library(spark, tokenizer):
    texts = documents()
    got = {r["doc_id"]: r["n_tokens"] for r in result(spark, "op5_token_counts")}
    assert got == {i: len(tokenizer.encode_ordinary(t)) for i, (t, _) in texts.items()}


def test_mixing_targets_and_words(spark):
    texts = documents()
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, (t, _) in texts.items()}
    of_source = Counter()
    for i, (_, source) in texts.items():
        of_source[source] += size[i]
    order = sorted(of_source, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(of_source.values())
    while True:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if 2 * of_source[s] < unit * weight[s]}
        if not full:
            break
        for s in full:
            target[s] = 2 * of_source[s]
            left -= target[s]
        open_ -= full
    target |= {s: unit * weight[s] for s in open_}
    taken = Counter()
    rows = result(spark, "op7_mixing")
    assert len(rows) == len(texts)
    for r in rows:
        source = texts[r["doc_id"]][1]
        assert r["size"] == size[r["doc_id"]]
        assert r["source_size"] == of_source[source]
        assert math.isclose(r["target"], target[source], rel_tol=1e-12)
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert len(r["shards"]) == (r["taken"] > 0) + (r["taken"] > r["size"]) or r["taken"] <= r["size"]
        taken[source] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in order)
    assert sorted(rows, key=repr) == sorted(result(spark, "op7_mixing"), key=repr)


def spans_of(text):
    found = []
    assign = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    for rank, (kind, pattern, group, least) in enumerate(
        (("assign", assign, 2, 6), ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24))
    ):
        for m in re.finditer(pattern, text):
            if len(m[group]) >= least:
                found.append((m.start(), rank, kind, m.end()))
    return sorted(found)


def test_secret_spans(spark):
    texts = documents("/root/testdata/sf0.01")
    rows = result(spark, "op8_secret_scan", "/root/testdata/sf0.01")
    assert len(rows) == len(texts) and any(r["n_hex"] for r in rows)
    for r in rows:
        base = spans_of(texts[r["doc_id"]][0])
        line = ",".join(f"{k}:{a}:{b}" for a, _, k, b in base)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        kinds = Counter(k for _, _, k, _ in base)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [kinds[k] for k in ("assign", "access", "hex")]
        shown = r["spans"].split(",") if r["spans"] else []
        assert set(line.split(",") if line else []) <= set(shown)


def test_license_words_and_base_labels(spark):
    texts = documents("/root/testdata/sf0.01")
    phrases = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}
    rows = result(spark, "op9_license_scan", "/root/testdata/sf0.01")
    assert len(rows) == len(texts) and any(r["n_base"] for r in rows)
    for r in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), texts[r["doc_id"]][0])
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        places = [
            (i, label) for phrase, label in phrases.items() for i in range(len(words))
            if tuple(words[i : i + len(phrase)]) == phrase
        ]
        at = [i for i, _ in places]
        labels = {label for _, label in places}
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == (min(at, default=None), max(at, default=None))
        assert r["base_labels"] == ",".join(sorted(labels))
        assert labels <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1


def test_toxicity_on_held_out_labels(spark):
    """Fit on the documents with an even number, judge the others."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    model = toxicity.train(docs, labels.where("doc_id % 2 = 0"))
    assert model.thresholds == sorted(model.thresholds)
    truth = labels.where("doc_id % 2 = 1").selectExpr("doc_id", "toxic AS truth")
    judged = toxicity.graded(docs, model).join(truth, "doc_id").collect()
    seen = Counter((bool(r["truth"]), r["toxic"]) for r in judged)
    assert all(0 <= r["severity"] <= toxicity.GRADES for r in judged)
    assert seen[True, True] > 0.93 * (seen[True, True] + seen[True, False])
    assert seen[False, True] < 0.01 * (seen[False, True] + seen[False, False])


def test_search_in_small_blocks_is_exact(spark):
    vectors = impact_topk.quantised(spark.read.parquet(f"{SMALL}/embeddings.parquet"))
    from pyspark.sql import functions as F

    whole = impact_topk.top_k(vectors, F.col("vec_id") % 50 == 0, 5).collect()
    parts = impact_topk.top_k(vectors, F.col("vec_id") % 50 == 0, 5, block_rows=60, query_rows=3).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, parts))


def test_hypergeometric_tree_keeps_quotas(spark):
    quotas = [700, 0, 31, 4, 1]
    frame = spark.createDataFrame([(quotas,)], "quotas array<bigint>")
    shards = [r["quotas"] for r in mixing.leaves(frame, 4, 3).collect()]
    assert [sum(c) for c in zip(*shards, strict=True)] == quotas
    assert {sum(s) for s in shards} <= {sum(quotas) // 16, sum(quotas) // 16 + 1}


def test_hypergeometric_draws_follow_the_distribution(spark):
    from pyspark.sql import functions as F

    frame = spark.range(4000).select(
        mixing.hypergeometric(
            F.lit(12).cast("bigint"), F.lit(18).cast("bigint"), F.lit(10).cast("bigint"), (F.col("id") + 0.5) / 4000
        ).alias("x")
    )
    seen = Counter(r["x"] for r in frame.collect())
    for x in range(11):
        p = math.comb(12, x) * math.comb(18, 10 - x) / math.comb(30, 10)
        assert abs(seen[x] / 4000 - p) < 1e-3


def test_pruning_keeps_what_may_reach_the_threshold():
    for compared, least in jaccard_join.fewest_matches((4, 5)).items():
        assert jaccard_join.chance_above(least, compared, 0.8) >= jaccard_join.TOLERANCE
        assert jaccard_join.chance_above(least - 1, compared, 0.8) < jaccard_join.TOLERANCE
