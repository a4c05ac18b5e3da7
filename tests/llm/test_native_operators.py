"""Sharding, exact dedup and chat formatting against plain versions."""

import hashlib
import re
import zlib

from pyspark.sql import functions as F

from terracell.llm import chat, exact_dedup, sharding

MASK = (1 << 64) - 1


def jump(key, n):
    key &= MASK
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & MASK
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_matches_the_published_function(spark):
    df = spark.range(0, 300).selectExpr("id * 7919 - 300000 AS k", "'x' AS shard")
    for n in (1, 2, 24, 150):
        for r in sharding.assign_shards(df, "k", n).collect():
            assert (r.shard, r.grown_shard) == (jump(r.k, n), jump(r.k, n + 1))


def test_slots(spark):
    rows = [(k, f"t{k % 7}é") for k in range(200)] + [(None, None), (None, None), (5, ""), (3, "same"), (3, "same"), (3, "same")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("clash")).withColumn("law", F.lit(1))
    got = sharding.shard_slots(df, 24).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        assert r.shard == jump(r.doc_id or 0, 24) and r.grown_shard in (r.shard, 24) and r.law == "key"
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t in rows)
    assert sharding.shard_slots(df.limit(0), 24).count() == 0
    assert sharding.assign_shards(df.withColumn("name", F.col("text")), "name", 9).filter("shard between 0 and 8").count() == len(rows)


def test_slots_of_very_long_texts(spark):
    df = spark.createDataFrame([(1, "x" * 3_000_000), (2, "é" * 1_000_000), (3, None), (3, None)], "doc_id long, text string")
    got = sharding.shard_slots(df, 24).collect()
    assert sorted(r.size for r in got) == [8, 8, 2_000_008, 3_000_008] and {r.text_crc32 for r in got if r.size == 8} == {0}


def brute_dedup(rows):
    texts = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in rows]
    groups = {}
    for (i, _), t in zip(rows, texts):
        groups.setdefault(t, []).append(i)
    return sorted(((i, min((x for x in groups[t] if x is not None), default=None), len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for (i, _), t in zip(rows, texts)), key=repr)


def test_exact_dedup(spark):
    rows = [(k, f"a  b\n{k % 40}") for k in range(300)] + [(900, None), (901, ""), (902, " "), (903, "\t\n"), (None, "a b 1"), (7, "x"), (7, "x"), (None, "alone"), (None, "alone"), (904, "long " * 20000), (905, "long\n" * 20000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("hash", F.lit(1)).withColumn("keep_id", F.lit("clash"))
    for how in ({}, {"bucket_entries": 3}, {"fingerprint": lambda c: F.xxhash64(F.substring(c, 1, 1))}, {"bucket_entries": 2, "fingerprint": lambda c: F.xxhash64(F.length(c) % 20)}):
        got = exact_dedup.dedup_decisions(df, **how).collect()
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == brute_dedup(rows)
        kept = [r.text_sha256 for r in got if r.kept]
        assert len(kept) == len(set(kept)) == len({r.text_sha256 for r in got})
    left = exact_dedup.deduplicated(df)
    assert left.columns == df.columns and left.count() == len({r.text_sha256 for r in got})
    assert exact_dedup.dedup_decisions(df.limit(0)).count() == 0 and exact_dedup.deduplicated(df.limit(0)).count() == 0


def test_exact_dedup_without_the_filter(spark, monkeypatch):
    rows = [(k, f"a  {k % 400}" if k % 3 else "hot") for k in range(3000)] + [(None, ""), (1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    monkeypatch.setattr(exact_dedup, "BROADCAST_ROWS", 10)
    for share in (100_000, 50):
        monkeypatch.setattr(exact_dedup, "HOT_SHARE", share)
        got = exact_dedup.dedup_decisions(df, bucket_entries=20).collect()
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == brute_dedup(rows)


def test_owners_are_ranges_of_hashes(spark):
    buckets = exact_dedup.directory(spark.range(5000).select((F.xxhash64("id") * F.when(F.col("id") % 5 > 0, 0).otherwise(1) + F.col("id")).alias("hash")), 100)
    cells, depth = exact_dedup.owners(buckets, 6)
    got = sorted((r.cell, r.owner) for r in cells.collect())
    assert [c for c, _ in got] == sorted({c for c, _ in got}) and depth == max(r.depth for r in buckets.collect())
    assert [o for _, o in got] == sorted(o for _, o in got) and 0 <= got[0][1] and got[-1][1] <= 5


def test_directory_splits_overfull_buckets(spark):
    hashes = spark.range(2000).select(F.xxhash64("id").alias("hash"))
    found = exact_dedup.directory(hashes, 100).collect()
    assert sum(r.entries for r in found) == 2000 and max(r.entries for r in found) <= 100 and max(r.depth for r in found) >= 5


def brute_chat(rows):
    talks = {}
    for c, t, r, x in rows:
        talks.setdefault(c, []).append((t if t is not None else -(10**9), r or "", x or ""))
    out = []
    for c, turns in talks.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out.append((c, len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\", "<\\s>", "[\\INST]", "\\\\</s>\\", " [/INST] ", "<s>", "", "é🙂\n\n", "a" * 50000, "<<s>s>", "[/[/INST]INST]"]
    rows = [(k, t, ["system", "user", "assistant"][(t + k) % 3], nasty[(k * 5 + t) % len(nasty)]) for k in range(30) for t in range(k % 6 + 1)]
    rows += [(None, 1, None, None), (77, None, "tool use&\n", "x"), (77, 1, "assistant", None), (78, 1, "user", "tie"), (78, 1, "user", "tie"), (-7, 0, "user", nasty[0]), (-7, 1, "assistant", nasty[0])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("said", F.lit(1)).withColumn("whole", F.lit(2))
    made = chat.examples(df)
    got = chat.read_back(made).collect()
    assert sorted(((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got), key=repr) == brute_chat(rows)
    assert sum(r.formatted_chars for r in got) == made.agg(F.sum(F.char_length("text"))).first()[0]
    for r in made.filter("conv_id = -7").collect():
        assert r.text[r.loss_start : r.loss_end].replace("<\\/s>", "</s>").replace("[\\INST]", "[INST]").replace("[\\/INST]", "[/INST]") == nasty[0]
        assert r.text.count("</s>") == 2 and r.text.count("[INST]") == 2
    assert made.filter("loss_end > loss_start").count() == sum(r == "assistant" and bool(x) for _, _, r, x in rows)
    assert chat.examples(df.limit(0)).count() == 0
