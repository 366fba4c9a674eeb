import math
import random
from collections import defaultdict

from pyspark.sql import functions as F

from nestdoc.llm import mix as M

from .helpers import SCHEMA, odd_rows, prose, spaced


def filled(sizes, weights=(1, 2, 3), most=3):
    """Targets by plain water filling; sizes by source, in order."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    capped = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        open_ = [s for s in order if s not in capped]
        share = {s: w[s] * left / sum(w[x] for x in open_) for s in open_}
        new = {s for s in open_ if share[s] > most * sizes[s]}
        if not new:
            return {s: float(most * sizes[s]) if s in capped else share[s] for s in order}
        capped |= new


def test_targets_caps_and_sums(spark):
    rng = random.Random(1)
    rows = [(k, prose(rng, rng.choice([1, 5, 20, 60])), rng.choice(["a", "b", "b", "b", "c", "d", None])) for k in range(900)]
    rows += [(r[0], r[1], r[3]) for r in odd_rows(rng)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = M.mix_documents(df, keep=["doc_id", "source"]).collect()
    assert len(out) == len(rows)
    sizes, taken, largest, target = defaultdict(int), defaultdict(int), defaultdict(int), {}
    for r in out:
        s = r["source"]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
        target[s] = r["target"]
        assert 0 <= r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
    want = filled(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 and target[s] <= 3 * sizes[s]
        assert abs(taken[s] - target[s]) <= largest[s]
    assert sorted(map(repr, M.mix_documents(df, keep=["doc_id", "source"]).collect())) == sorted(map(repr, out))
    assert sum(sizes.values()) == sum(len(spaced(t)) for _, t, _ in rows)


def test_inclusion_follows_the_odds(spark):
    """Over many seeds documents come in about as often as their weight says."""
    rows = [(k, "w " * 10, "a", 1.0 + k % 3) for k in range(60)] + [(100 + k, "w " * 10, "b", 1.0) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, weight double").cache()
    seen = defaultdict(int)
    for seed in range(12):
        for r in M.mix_documents(df, weight="weight", seed=seed).collect():
            if r["doc_id"] < 100:
                seen[r["doc_id"] % 3] += r["copies"]
    # source a is due 2/3 of its size: weights 1, 2, 3 give 1/3, 2/3 and 1 on average
    n = 12 * 20
    assert abs(seen[0] / n - 1 / 3) < 0.12 and abs(seen[1] / n - 2 / 3) < 0.12 and abs(seen[2] / n - 1) < 0.12


def test_draw_is_that_of_sorted_pareto_ranks(spark):
    """The documents that the query's draw takes, by plain sorting of Pareto's ranks."""
    rng = random.Random(11)
    rows = [(k, prose(rng, rng.choice([0, 1, 3, 8, 30, 200])), rng.choice(["a", "b", "b", "b", "b", "c", None])) for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    drawn = {r["doc_id"]: r["u"] for r in df.select("doc_id", M.unit_hash(df["doc_id"], df["text"], F.lit(0)).alias("u")).collect()}
    got = {r["doc_id"]: r for r in M.mix_documents(df, weight=M.by_length).collect()}
    size = {i: len(spaced(t)) for i, t, _ in rows}
    by_source = defaultdict(list)
    for i, _, s in rows:
        by_source[s].append(i)
    targets = filled({s: sum(size[i] for i in ids) for s, ids in by_source.items()})
    shares = set()
    for s, ids in by_source.items():
        due = dict.fromkeys(ids, 0.0)
        capped = set()
        while True:
            left = targets[s] - sum(3 * size[i] for i in capped)
            weight = {i: math.log2(1 + size[i]) for i in ids if i not in capped}
            total = sum(w * size[i] for i, w in weight.items())
            for i, w in weight.items():
                due[i] = min(3.0, left * w / total) if total else 0.0
            new = {i for i in weight if due[i] >= 3}
            if not new:
                break
            capped |= new
            due |= dict.fromkeys(capped, 3.0)
        copies = {i: math.floor(due[i] + 1e-9) if size[i] else 0 for i in ids}
        lack = targets[s] - sum(copies[i] * size[i] for i in ids)
        ranks = []
        for i in ids:
            p = due[i] - copies[i]
            if size[i] and p > 1e-9:
                shares.add(round(p, 6))
                ranks.append(((drawn[i] / (1 - drawn[i])) / (p / (1 - p)), i))
        for _, i in sorted(ranks):
            if size[i] >= 2 * lack:
                break
            copies[i] += 1
            lack -= size[i]
        assert copies == {i: got[i]["copies"] for i in ids}, s
    assert len(shares) > 10  # the probabilities differ


def test_mix_rows_and_empty_table(spark):
    rng = random.Random(7)
    rows = [(k, prose(rng, 20), "ab"[k % 2], 1) for k in range(60)] + [(0, None, "a", 2), (None, "x y", None, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    out = M.take_mix(df)
    assert out.columns == [*df.columns, "_copies"]
    assert all(r["_copies"] > 0 and r["text"] for r in out.collect())
    none = spark.createDataFrame([], SCHEMA)
    assert M.mix_documents(none).count() == 0 and M.take_mix(none).count() == 0
    words = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, source string")
    assert [r["taken"] for r in M.mix_documents(words).collect()] == [0, 0]
