import re
from collections import defaultdict

import pytest
from helpers import documents, hard_documents, no_documents, rows_of

from logweir.llm.mixing import mix, op1_pivotal_mix, plan_copies

SF = "/root/testdata/sf0.001"


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Weighted shares, with the excess over the caps dealt out again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, result = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total >= most * sizes[s]}
        if not full:
            result |= {s: left * weight[s] / total for s in open_}
            break
        result |= {s: most * sizes[s] for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_ -= full
    return result


def check(rows, texts):
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for doc_id, source, size, source_size, t, took in rows:
        sizes[source] += size
        taken[source] += took
        target[source] = t
        assert took in (0, size, 2 * size)
    expected = targets(sizes)
    for source, t in target.items():
        assert t == pytest.approx(expected[source], abs=1e-6)
    return sizes, taken, target


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op1_pivotal_mix(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    rows = [
        (r.doc_id, docs[r.doc_id].source, r.size, r.source_size, r.target, r.taken) for r in got
    ]
    for r in got:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id].text or ""))
    sizes, taken, target = check(rows, docs)
    # Ten documents a source only; together the words are still near.
    assert sum(taken.values()) == pytest.approx(sum(target.values()), rel=0.05)
    again = op1_pivotal_mix(spark, SF)
    assert rows_of(again, *again.columns) == sorted((tuple(r) for r in got), key=repr)


def test_large_sources_come_near_their_targets(spark):
    words = [3, 5, 8, 200, 40]
    rows = [
        (i, "w " * words[i * i % 5], "hot" if i % 3 else f"s{i % 4}") for i in range(3000)
    ]
    plan = plan_copies(documents(spark, rows)).collect()
    taken, target = defaultdict(int), {}
    for r in plan:
        taken[r.source] += r.size * r.copies * r.rows
        target[r.source] = r.target
    assert all(abs(taken[s] - t) <= 200 for s, t in target.items())
    one = [r for r in plan if r.source == "hot" and 0 < r.target / r.source_size % 1 < 1]
    assert len({r.copies for r in one}) == 2


def test_hard_rows(spark):
    docs = hard_documents(spark)
    plan = plan_copies(docs)
    assert sum(r.rows for r in plan.collect()) == docs.count()
    assert all(r.copies == 1 for r in plan.filter("size = 0").collect())
    mixed = mix(docs)
    assert mixed.columns == docs.columns
    copies = {(r.doc_id, r.source, r.text_hash): r.copies for r in plan.collect()}
    assert mixed.count() == sum(
        r.copies * r.rows for r in plan.collect()
    ) and set(copies.values()) <= {0, 1, 2}
    assert mix(no_documents(spark)).count() == 0
