"""Secrets in long texts: linear time, positions and suppression against plain Python."""

import random
import re
import time

from pyspark.sql import functions as F

from ridgeway.llm import secret_scan

SCHEMA = "doc_id bigint, text string"
# The base patterns as they are stated.
ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
PLAIN = (("assign", ASSIGN, 1, 6), ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24))


def base_of(text, kind):
    _, pattern, group, least = next(p for p in PLAIN if p[0] == kind)
    return [(m.start(), m.end()) for m in re.finditer(pattern, text, re.ASCII) if len(m.group(group)) >= least]


def words(n, seed):
    draw = random.Random(seed)
    pool = ["bed", "fade", "é😀", "word", "token = short", "Password: 'longenough1'", "secret: token:abcdefgh",
            "AKIA12 AKIA" + "Z9" * 9, "AKIAKIA" + "Q" * 14, "0f" * 11, "0f" * 13, "api_key=" + "a" * 30]
    return " ".join(draw.choice(pool) for _ in range(n))


def test_base_spans_of_many_matches(spark):
    rows = [(i, words(n, i)) for i, n in enumerate((0, 1, 3, 50, 4000))]
    found = secret_scan.found(spark.createDataFrame(rows, SCHEMA))
    for row in found.collect():
        text = rows[row["doc_id"]][1]
        for kind, *_ in PLAIN:
            got = [(s["start"], s["end"]) for s in row[kind]]
            assert got == base_of(text, kind), (row["doc_id"], kind)
            assert all(s["value"] in text[s["start"] : s["end"]] for s in row[kind])


def test_five_megabytes_in_seconds(spark):
    text = " ".join(random.Random(1).choices(["bed", "fade", "cafe", "token = x", "deadbeef"], k=900_000))
    frame = spark.createDataFrame([(1, text + " " + "0123456789abcdef" * 2)], SCHEMA)
    secret_scan.found(frame.limit(0)).collect()
    started = time.time()
    row = secret_scan.found(frame).first()
    assert time.time() - started < 60
    assert [(s["start"], s["end"]) for s in row["hex"]] == [(len(text) + 1, len(text) + 33)]


def test_long_tokens_beside_base_spans(spark):
    draw = random.Random(6)
    for _ in range(3):
        cuts = sorted(draw.sample(range(400), 60))
        base = [(a, b) for a, b in zip(cuts[::4], cuts[1::4], strict=False)]
        tokens = [(a, b) for a, b in zip(cuts[1::3], cuts[2::3], strict=False)]
        entry = "struct<start:bigint,rank:int,kind:string,end:bigint,value:string>"
        spans = [(a, 0, "assign", b, "v") for a, b in base] + [(a, 3, "markov", b, "v") for a, b in tokens]
        frame = spark.createDataFrame([(sorted(spans),)], f"spans array<{entry}>")
        got = frame.select(secret_scan._uncovered(F.col("spans")).alias("s")).first()["s"]
        want = [s for s in sorted(spans) if s[1] == 0 or not any(a < s[3] and s[0] < b for a, b in base)]
        assert [tuple(s) for s in got] == want
