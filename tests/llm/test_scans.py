"""Secrets, byte BPE, toxicity, URL filters."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from terracell.llm import byte_bpe, secrets, toxicity, url_filter
from terracell.llm.automaton import Automaton, Rule

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute_spans(text):
    found = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    order = {"assign": 0, "access": 1, "hex": 2}
    return ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(found, key=lambda s: (s[0], order[s[1]])))


def test_secret_spans(spark):
    parts = ["token", "secret", "api_key", "apikey", "PassWord", "AKIA", "abc", "0123456789abcdef", "ABCD1234EFGH", "=", ":", " ", '"', "'", "é🙂", "x\n", "passwd"]
    rows = [(k, "".join(random.Random(k).choice(parts) for _ in range(random.Random(k).randrange(50)))) for k in range(600)]
    rows += [(1000, None), (1001, ""), (1002, "secret=token:token=abcdefgh"), (1003, "deadbeef " * 3000 + "password: hunter22 " + "0" * 30000 + "\n" + "AKIA" + "A" * 16), (1002, "secret=token:token=abcdefgh")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1))
    got = secrets.secret_spans(df).collect()
    assert len(got) == len(rows)
    want = {(i, brute_spans(t or "")) for i, t in rows}
    for r in got:
        base = ",".join(s for s in r.spans.split(",") if s.split(":")[0] in ("assign", "access", "hex"))
        assert (r.doc_id, base) in want
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(base.count(k) for k in ("assign", "access", "hex"))
    pem = spark.createDataFrame([(1, "é -----BEGIN RSA PRIVATE KEY-----")], "doc_id long, text string")
    assert secrets.secret_spans(pem).first().spans == "pem:2:33"
    assert secrets.secret_spans(df.limit(0)).count() == 0


def test_automaton_refuses_rules_it_cannot_run():
    for pattern in ("a*", "ab|abc?d"):
        with pytest.raises(ValueError):
            Automaton([Rule("r", pattern)])


@pytest.fixture(scope="module")
def codec():
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return byte_bpe.Codec(ranks, public_tokenizers.PATTERN), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=dict(ranks), special_tokens={})


def test_perfect_hash(codec):
    h = codec[0].hash
    assert sorted(h.values) == list(range(h.n)) and all(h.get(k) == v for k, v in zip(h.slots, h.values))
    assert h.get(b"no such token at all") == -1


def test_bpe_matches_the_library(spark, codec):
    own, library = codec
    parts = ["a", "the", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "1", "²", "'s", "'", "!", "ß", "日本", "🙂", "\u3000", "Tion", "<|endoftext|>"]
    rows = [(k, "".join(random.Random(k).choice(parts) for _ in range(k % 60))) for k in range(1500)] + [(-1, None), (-2, ""), (-3, "xy" * 30000), (-3, "xy" * 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("token_ids", F.lit(0))
    made = byte_bpe.decode_documents(byte_bpe.encode_documents(df, own), own)
    want = sorted(((i, library.encode_ordinary(t or "")) for i, t in rows), key=repr)
    got = made.collect()
    assert sorted(((r.doc_id, r.token_ids) for r in got), key=repr) == want
    assert sorted(bytes(r.decoded) for r in got) == sorted((t or "").encode() for _, t in rows)
    both = byte_bpe.encode_documents(df, own, decode=True)
    assert sorted(map(repr, both.collect())) == sorted(map(repr, got))
    ids = {(r.doc_id, r.n_tokens, r.ids_sha256) for r in byte_bpe.digests(made).collect()}
    assert ids == {(i, len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for i, x in want}
    assert byte_bpe.digests(byte_bpe.decode_documents(byte_bpe.encode_documents(df.limit(0), own), own)).count() == 0


def test_bpe_forgets_without_harm(codec, monkeypatch):
    own, library = codec
    monkeypatch.setattr(byte_bpe, "MEMO", 5)
    draw = random.Random(11)
    texts = ["".join(draw.choice(["the", "ing", " ", "  ", "\n", ".", ",", "qzx", "ñ", "x" * 300]) for _ in range(draw.randrange(40))) for _ in range(300)]
    for low in range(0, 300, 60):
        some = pa.array(["left out", *texts[low : low + 60]]).slice(1)
        offsets, ids = own.encode_column(some)
        decoded = own.decode_column(offsets, ids)
        for k, t in enumerate(texts[low : low + 60]):
            assert ids[offsets[k] : offsets[k + 1]].tolist() == library.encode_ordinary(t) == own.encode(t)
            assert decoded[k].as_py() == t.encode()


def test_toxicity(spark):
    draw = random.Random(5)
    plain = ["lorem", "ipsum", "dolor", "amet", "tempor", "magna", "aliqua", "veniam"]

    def text(bad):
        sentences = [" ".join(draw.choice(plain) for _ in range(8)) for _ in range(draw.randrange(1, 30))]
        if bad:
            sentences[draw.randrange(len(sentences))] += f" grubble{draw.choice(plain)}"
        return ". ".join(sentences) + "."

    rows = [(k, text(k % 5 == 0), k % 5 == 0) for k in range(900)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, None), (2000, ""), (2001, "lorem " * 40000), (2002, "ipsum. " * 9000 + "Grubblex!")], "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, int(b)) for i, _, b in rows] + [(None, 1), (5000, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    for i, t, bad in rows:
        held = zlib.crc32(str(i).encode()) % 3 == 1
        assert got[i].held_out == held
        if held:
            assert got[i].predicted == int(bad), (i, got[i].score)
            if bad:
                worst = max(got[i].offending, key=lambda s: s["score"])
                assert "grubble" in t[worst["start"] : worst["end"]]
    assert got[None].score == got[2000].score == got[2001].score == 0 and got[2002].predicted == 1
    kept = toxicity.clean_rows(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(got) - sum(r.predicted for r in got.values())
    none = toxicity.train(docs, labels.limit(0))
    assert toxicity.score_documents(docs.limit(3), none).agg(F.max("score")).first()[0] == 0.0
    assert toxicity.score_documents(docs.limit(0), model).count() == 0


def plain_score(model, text):
    """The noisy-or over sentences, patterns sought one by one."""
    rest = 1.0
    for sentence in re.split(r"[.!?\n]", text):
        words = " " + re.sub(r"[\W_]+", " ", sentence.lower()).strip() + " "
        found = [w for p, w in zip(model.patterns, model.weights) if p in words]
        if found:
            p0, p = (1 / (1 + math.exp(-z)) for z in (toxicity.BIAS, toxicity.BIAS + sum(found)))
            rest *= (1 - p) / (1 - p0)
    return 1 - rest


def test_toxicity_equals_a_plain_noisy_or_over_whole_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    texts, marks = {r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r.toxic for r in labels.collect()}
    known = sorted(i for i, y in marks.items() if y is not None and zlib.crc32(str(i).encode()) % 3 != 1 and texts.get(i) is not None and len(texts[i]) <= toxicity.TRAIN_CHARS)
    model = toxicity.train(docs, labels)
    again = toxicity.fit([texts[i] for i in known], [marks[i] for i in known])
    assert model.patterns == again.patterns and np.array_equal(model.weights, again.weights) and model.patterns
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    assert all(abs(got[i].score - plain_score(model, t or "")) < 1e-9 and got[i].predicted == (got[i].score >= 0.7) for i, t in texts.items())
    kept = {r.doc_id for r in toxicity.clean_rows(docs, model).collect()}
    assert kept == {i for i, t in texts.items() if plain_score(model, t or "") < 0.7}
    held = [(got[i].score, y) for i, y in marks.items() if y is not None and got[i].held_out]
    pairs = [(a > b) + (a == b) / 2 for a, y in held if y for b, z in held if not z]
    assert not pairs or sum(pairs) / len(pairs) > 0.9


def test_toxic_patterns_and_fit_are_the_plain_ones():
    draw = random.Random(9)
    texts = [" ".join(draw.choice(["lorem", "ipsum", "dolor", "amet"]) for _ in range(6)) + (". what a zorblin here" if k % 3 == 0 else "") + (". flunk" if k % 7 == 0 else "") for k in range(120)]
    marks = [int(k % 3 == 0) for k in range(120)]
    model = toxicity.fit(texts, marks)
    assert all(p in " what a zorblin here " for p in model.patterns) and any("zorb" in p for p in model.patterns)
    for pattern in model.patterns:
        a, c = (sum(pattern in f" {' '.join(re.findall('[a-z]+', t))} " for t, y in zip(texts, marks) if y == k) for k in (1, 0))
        assert a >= 3 and a * marks.count(0) > 4 * c * marks.count(1)

    def loss(weights):
        other = toxicity.Model(model.patterns, weights)
        scores = [min(max(plain_score(other, t), 1e-9), 1 - 1e-9) for t in texts]
        return -sum(math.log(q if y else 1 - q) for q, y in zip(scores, marks)) / len(texts) + toxicity.SHRINK * (weights**2).sum() / len(weights) / 2

    here = loss(model.weights)
    for k in range(len(model.weights)):
        for step in (-0.3, 0.3):
            moved = model.weights.copy()
            moved[k] = max(0.0, moved[k] + step)
            assert loss(moved) >= here - 1e-6


def test_toxicity_of_repeated_rows(spark):
    rows = [(k, "plain words. " + ("grubbledor" if k % 4 == 0 else "sit amet")) for k in range(240)]
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(240)], "doc_id long, toxic int")
    once, twice = (spark.createDataFrame(r, "doc_id long, text string") for r in (rows, rows * 3))
    a, b = toxicity.train(once, labels), toxicity.train(twice, labels.unionByName(labels))
    assert a.patterns == b.patterns and np.array_equal(a.weights, b.weights) and a.patterns
    got = toxicity.score_documents(twice, a).collect()
    assert len(got) == 720 and len({(r.doc_id, r.score) for r in got}) == 240
    tied = spark.createDataFrame([(1, "b"), (1, "a"), (1, None)], "doc_id long, text string")
    assert toxicity.train(tied, labels).patterns == []


def test_very_long_urls(spark):
    long = "http://" + "badnews" * 300 + ".example.org/es/" + "x" * 40_000 + "?" + "y" * 50_000
    rows = [(1, long, "<p>bad news</p>"), (2, "http://" + "a." * 5000 + "com/en/1", None), (3, "http://test/" + "-" * 60_000, "w" * 200_000)]
    got = {r.page_id: r for r in url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert (got[1].rule, got[1].verdict, len(got[1].path)) == ("org/es/", "block", 40_004) and got[1].words.startswith("bad news bad news")
    assert (got[2].rule, got[2].verdict) == ("com/en/", "block") and got[3].rule is None


def test_url_rules_and_parts():
    assert url_filter.parts("HTTP://A.Example.COM:80/En/7?x#y") == ("a.example.com:80", "/En/7")
    assert url_filter.parts("no scheme/here") == url_filter.parts(None) == ("", "")
    assert url_filter.parts("x://h#/a") == ("h", "") and url_filter.parts("x://h?/a") == ("h", "")
    assert url_filter.ruling("www.example.com", "/en/71") == ("allow", "example.com/en/7")
    assert url_filter.ruling("a.com", "/en/") == ("block", "com/en/") and url_filter.ruling("acom", "/en/") is None
    assert url_filter.ruling("example.net", "/de/8") == ("block", "example.net/de/8") and url_filter.ruling("com", "/en") is None


def test_url_model(spark):
    html = "<p>bad good news shop</p>" * 50
    rows = [(k, f"http://{'badnews' if k % 2 else 'goodshop'}{k % 3}.example.{'org' if k % 2 else 'net'}/{'es' if k % 2 else 'de'}/{k % 7}", html) for k in range(300)]
    rows += [(1000, "http://badnews.test/x", html), (1001, "http://goodshop.test/x", html), (1002, None, None), (1003, "nothing", ""), (1003, "nothing", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("verdict", F.lit(3))
    got = {r.page_id: r for r in url_filter.filter_urls(df).collect()}
    assert got[1000].verdict == "block" and got[1001].verdict == "allow" and got[1000].rule is None
    assert got[1000].words == "bad news test" and (got[1002].host, got[1002].path) == ("", "")
    assert url_filter.filter_urls(df.limit(0)).count() == 0


def test_url_filter_leaves_no_rare_word_or_token_out(spark):
    filler = " ".join("filler" + "".join(chr(97 + k // 26**p % 26) for p in range(3)) for k in range(1000))
    rows = [(k, f"http://{'casinofarm' if k % 3 else 'spam-pills'}.example.{'org' if k % 2 else 'net'}/{'es' if k % 2 else 'de'}/once{chr(97 + k % 26)}x{k}", filler) for k in range(200)]
    rows += [(900, "http://casinofarm.test/oncebx7", "<b>casino farm</b> pills casino"), (900, "http://spampills.test/", "spam"), (901, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    counts = url_filter.Counter(w for _, _, h in rows if h for w in re.findall("[a-z]+", re.sub("<[^>]*>", " ", h)))
    segmenter, seen, pages = url_filter.Segmenter(counts), {}, [0, 0]

    def tokens(u):
        host, path = url_filter.parts(u)
        words = [w for label in re.split(r"\W+", host) if label for w in segmenter.split(label)]
        return words, [f"h:{w}" for w in words] + [f"p:#{len(t)}" if t.isdigit() else f"p:{t}" for t in re.findall(r"[a-z]+|\d+", path)]

    for _, u, _ in rows:
        ruled = url_filter.ruling(*url_filter.parts(u))
        if ruled:
            pages[ruled[0] == "block"] += 1
            for t in tokens(u)[1]:
                seen.setdefault(t, [0, 0])[ruled[0] == "block"] += 1
    totals = [sum(c[k] for c in seen.values()) + len(seen) for k in (0, 1)]
    want = []
    for i, u, _ in rows:
        words, own = tokens(u)
        odds = math.log((pages[1] + 1) / (pages[0] + 1)) + sum(math.log((seen[t][1] + 1) / totals[1]) - math.log((seen[t][0] + 1) / totals[0]) for t in own if t in seen)
        want.append((i, " ".join(words), round(odds, 9)))
    assert sorted(want)[-3:] == [w for w in sorted(want) if w[0] >= 900] and {w[1] for w in want} >= {"casino farm test", "spam pills test"}
    for options in ({}, {"held": 0, "block_labels": 2}):
        got = url_filter.filter_urls(df, **options).collect()
        assert sorted((r.page_id, r.words, round(r.block_odds, 9)) for r in got) == sorted(want)


def test_segmenter_is_the_best_split():
    counts = {"bad": 50, "news": 40, "badne": 1, "ws": 2, "a": 5}
    s = url_filter.Segmenter(counts)

    def cost(words):
        return sum(s.costs.get(w, s.unknown + 2.3 * len(w)) for w in words)

    def splits(t):
        return [[]] if not t else [[t[:k], *rest] for k in range(1, len(t) + 1) for rest in splits(t[k:])]

    for name in ("badnews", "anewsbad", "xbadx", ""):
        assert abs(cost(s.split(name)) - min(map(cost, splits(name)))) < 1e-9
