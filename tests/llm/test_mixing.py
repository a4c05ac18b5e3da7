import math

from pyspark.sql import functions as F

from terracell.llm import mixing


def filled(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, capped, target = share * sum(sizes.values()), set(), {s: 0.0 for s in names}
    while left > 1e-9 and len(capped) < len(names):
        total = sum(weight[s] for s in names if s not in capped)
        given, left = left, 0.0
        for s in names:
            if s not in capped:
                target[s] += given * weight[s] / total
                if target[s] >= most * sizes[s]:
                    left += target[s] - most * sizes[s]
                    target[s] = float(most * sizes[s])
                    capped.add(s)
    return target


def rows_of(spark, sizes, per=40):
    rows, n = [], 0
    for s, size in sizes.items():
        for k in range(per):
            words = size // per + (k < size % per)
            rows.append((n, " ".join(["w"] * words) if words else None, s, "extra"))
            n += 1
    return spark.createDataFrame(rows, "doc_id long, text string, source string, target string")


def test_targets_and_amounts(spark):
    for sizes in ({"a": 4000, "b": 100, "c": 9000, None: 50, "é": 700}, {"a": 10, "b": 10000}, {"x": 500}):
        want = filled(sizes)
        got = mixing.mix(rows_of(spark, sizes)).collect()
        for s, size in sizes.items():
            own = [r for r in got if r.source == s]
            assert all(math.isclose(r.target, want[s], rel_tol=1e-9, abs_tol=1e-6) for r in own)
            assert all(r.source_size == size and 0 <= r.taken <= 2 * r.size for r in own)
            assert abs(sum(r.taken for r in own) - want[s]) <= 2 * max(r.size for r in own) + 1


def test_rows_repeat_as_taken(spark):
    df = rows_of(spark, {"a": 4000, "b": 100, None: 3000})
    taken = {r.doc_id: r.times for r in mixing.mix(df).collect()}
    found = mixing.mixed_rows(df)
    assert found.columns == df.columns
    counts = {r.doc_id: r["count"] for r in found.groupBy("doc_id").count().collect()}
    assert {k: v for k, v in taken.items() if v} == counts


def test_nested_thresholds(spark):
    df = rows_of(spark, {"a": 4000, "b": 4000})
    less = {r.doc_id: r.times for r in mixing.mix(df, share=0.5).collect()}
    more = {r.doc_id: r.times for r in mixing.mix(df, share=0.9).collect()}
    assert all(less[k] <= more[k] for k in less)


def test_empty_and_null(spark):
    df = rows_of(spark, {"a": 10}).limit(0)
    assert mixing.mix(df).count() == 0 and mixing.mixed_rows(df).count() == 0
    nulls = spark.createDataFrame([(None, None, None), (1, "", None), (1, "a b", "s"), (1, "a b", "s")], "doc_id long, text string, source string")
    got = mixing.mix(nulls).collect()
    assert len(got) == 4 and sorted(r.size for r in got) == [0, 0, 2, 2]
    assert nulls.filter(F.col("source").isNull()).count() == 2


def test_very_long_texts(spark):
    df = spark.createDataFrame([(1, "w " * 500_000, "a"), (2, "w", "a"), (3, "w w", "b")], "doc_id long, text string, source string")
    got = {r.doc_id: r for r in mixing.mix(df).collect()}
    assert got[1].size == 500_000 and all(r.taken <= 2 * r.size for r in got.values())
