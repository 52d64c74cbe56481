import random

import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F
from helpers import documents, hard_documents, no_documents

from logweir.llm import jaccard_join
from logweir.llm.jaccard_join import OP5_SQL, keep_one, near_duplicates, op5_set_relations

SF = "/root/testdata/sf0.001"


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))) if words else frozenset()


def brute_force(rows, percent):
    """doc_id -> (set size, smallest id reachable)"""
    sets = {i: shingle_set(t) for i, t, _ in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def family(seed, size):
    """Near copies at all distances around two texts, exact copies, short texts."""
    random.seed(seed)
    bases = [[f"b{k}w{i}" for i in range(90)] for k in range(2)]
    shared = [f"s{i}" for i in range(40)]
    rows = []
    for i in range(size):
        words = list(random.choice(bases))
        for _ in range(random.choice([0, 0, 1, 1, 2, 3, 6])):
            at = random.randrange(len(words))
            words[at : at + random.randrange(3)] = [f"x{random.randrange(50)}"]
        if i % 5 == 0:
            words = [f"u{i}v{k}" for k in range(60)] + shared
        rows.append((i, " ".join(words), "a"))
    rows += [(1000 + i, t, "a") for i, t in enumerate(["A b", "a B", "a", "A", "c d e", "", None])]
    return rows


def test_query_against_sql(spark):
    got = oracle.spark_rows(op5_set_relations(spark, SF))
    assert got == oracle.duckdb_rows(oracle.connect(SF), OP5_SQL)


@pytest.mark.parametrize("percent, block, parts, rounds", [(90, 512, 1, 4), (75, 16, 3, 1)])
def test_against_brute_force(spark, monkeypatch, percent, block, parts, rounds):
    """Also with tiny blocks, dealt lists and many families missed."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "ROUNDS", rounds)
    if parts > 1:
        monkeypatch.setattr(jaccard_join, "LIST", 5)
        fixed = (np.arange(jaccard_join.SKETCH) % 2) * 400
        monkeypatch.setattr(jaccard_join, "sketch", lambda rows: fixed)
    rows = family(3, 160)
    got = near_duplicates(documents(spark, rows), percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_force(rows, percent)


def test_forest_equals_links():
    random.seed(1)
    sets = [jaccard_join.shingles(t) for _, t, _ in family(9, 60) if t]
    ids = np.arange(len(sets)) * 3 + 1
    rows = [(int(i), t, "a") for i, (_, t, _) in zip(ids, [r for r in family(9, 60) if r[1]])]
    found = {int(i): int(i) for i in ids}
    changes = [np.setxor1d(s, sets[0]) for s in sets]
    found |= dict(jaccard_join.forest(ids, np.array([len(s) for s in sets]), changes, 90))
    assert found == {i: c for i, (_, c) in brute_force(rows, 90).items()}


def test_hard_rows(spark):
    docs = hard_documents(spark)
    got = near_duplicates(docs).collect()
    assert len(got) == docs.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id))
    assert {c for _, c in by_id[1] | by_id[2]} == {1}
    assert by_id[3] == {(0, 3)} and by_id[4] == {(0, 4)} and by_id[8].pop()[1] == 5
    assert by_id[7] == {(1, 7)}
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 5, 6, 7, 7]
    assert near_duplicates(no_documents(spark)).count() == 0
    with pytest.raises(ValueError):
        near_duplicates(docs, 20)


def test_columns_named_like_results_keep_their_values(spark):
    docs = hard_documents(spark).withColumn("n_shingles", F.lit(7)).withColumn("component_id", F.lit("x"))
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert {(r.n_shingles, r.component_id) for r in kept.collect()} == {(7, "x")}


def test_a_token_rare_in_each_task_is_counted_and_its_list_dealt(spark, monkeypatch):
    """The same shingle in every row, three times in each of 100 tasks."""
    monkeypatch.setattr(jaccard_join, "STEP", 16)
    monkeypatch.setattr(jaccard_join, "LIST", 20)
    rows = [(i, f"all have this {i} {i}b {i}c", "a") for i in range(300)]
    docs = documents(spark, rows).repartition(100)
    counts = jaccard_join.sketch(jaccard_join.prepared(docs, "text"))
    everywhere = int(jaccard_join.shingles("all have this")[0] % np.uint64(jaccard_join.SKETCH))
    assert 150 < counts[everywhere] < 450  # four standard errors and more
    postings = docs.select(F.col("doc_id").alias("set_"), F.explode(F.array(F.lit(7), "doc_id")).alias("token"))
    for most in (50_000, 1):  # the long lists by broadcast, and by both ways
        monkeypatch.setattr(jaccard_join, "MAX_HOT_KEYS", most)
        got = jaccard_join.with_parts(postings, 600).groupBy("token").agg(
            F.min("parts").alias("least"), F.max("parts").alias("most"), F.count("*").alias("n")
        )
        parts = {r.token: (r.least, r.most, r.n) for r in got.collect()}
        assert parts.pop(7) == (16, 16, 301) and set(parts.values()) == {(1, 1, 1)}
    got = near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_force(rows, 90)
    # No two of them link; with a lower bar, dealt lists find those that do.
    near = [(i, f"all have this and that too {'x' * (i % 3)}", "a") for i in range(90)]
    got = near_duplicates(documents(spark, near).repartition(30), 60).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_force(near, 60)


def test_short_lists_have_the_pairs_of_the_general_way():
    random.seed(4)
    draw = np.random.default_rng(4)
    lengths = [random.randrange(1, 40) for _ in range(60)]
    ends = np.cumsum(lengths)
    starts, n = ends - lengths, int(ends[-1])
    size = draw.integers(18, 24, n)
    chunk = np.repeat(draw.integers(0, 2, 60), lengths) * draw.integers(0, 2, n)
    columns = [draw.integers(0, 90, n), draw.integers(0, 5, n), size, draw.integers(0, 3, n), chunk]
    found, expected = jaccard_join.short_list_pairs(starts, ends, columns, 90), []
    for lo, hi in zip(starts, ends):
        for x in range(lo, hi) if hi - lo <= jaccard_join.SHORT else ():
            for y in range(x + 1, hi):
                (a, f, m, i, c), (b, g, k, j, d) = ([int(v[z]) for v in columns] for z in (x, y))
                split = len(set(chunk[lo:hi])) > 1
                room = min(i, j) + min(m - i, k - j)
                if a != b and f != g and not (split and c == d) and 100 * min(m, k) >= 90 * max(m, k):
                    if 190 * room >= 90 * (m + k):
                        expected.append((a, b, m, k) if a < b else (b, a, k, m))
    assert expected and sorted(map(tuple, found.tolist())) == sorted(expected)


def pages(words, copies, changes, seed):
    """(id, text) of copies of a page, each with some words changed."""
    random.seed(seed)
    for i in range(copies):
        own = list(words)
        for _ in range(changes):
            own[random.randrange(len(own))] = f"y{random.randrange(10**6)}"
        yield " ".join(own)


def test_a_family_of_thousands_follows_from_its_pivot(spark):
    """3000 copies with a word changed link with each other; a tenth more lie aside."""
    words = [f"p{i}" for i in range(200)]
    near = list(pages(words, 3000, 1, 1))
    aside = list(pages(words, 300, 9, 2))
    members = spark.createDataFrame(
        [(i, 0, 198, t) for i, t in enumerate(near + aside)],
        "set_ long, family_ long, n_ long, text string",
    )
    held = jaccard_join.stored(jaccard_join.stars(members, 90))
    sets = [shingle_set(t) for t in near + aside]
    told = {r.set_: r for r in held.collect()}
    assert len(told) == len(sets) == held.count()
    for i, own in enumerate(sets):
        r = told[i]
        both = len(own & sets[0])
        assert (r.plus, r.minus, len(r.change)) == (
            len(own) - both, len(sets[0]) - both, len(own ^ sets[0])
        )
        assert r.linked == (100 * both >= 90 * (len(own) + len(sets[0]) - both))
    assert all(told[i].linked for i in range(3000))
    # No pair of members that link with the pivot is tested; the others are, exactly.
    assert jaccard_join.rest_edges(held.filter("linked"), 90).count() == 0
    links = {frozenset(e) for e in jaccard_join.rest_edges(held, 90).collect()}
    rest = [i for i in told if not told[i].linked]
    assert rest
    root = {i: 0 if told[i].linked else i for i in told}

    def find(i, up):
        while up[i] != i:
            i = up[i]
        return i

    brute = dict(root)
    for up, pairs in (
        (root, [tuple(e) for e in links]),
        (brute, [(i, j) for i in rest for j in told if i != j
                 and 190 * len(sets[i] & sets[j]) >= 90 * (len(sets[i]) + len(sets[j]))]),
    ):
        for i, j in pairs:
            a, b = sorted((find(i, up), find(j, up)))
            up[b] = a
    assert {i: find(i, root) for i in told} == {i: find(i, brute) for i in told}


def test_pivots_answers_stand_for_their_members(spark):
    """What the pivots' overlap says of a pair is what its own sets say."""
    words = [f"p{i}" for i in range(120)]
    texts = []
    for far in (0, 3, 4, 40):  # pages at growing distance from the first
        page = [*words[: 120 - far], *[f"q{far}v{i}" for i in range(far)]]
        texts += [" ".join(page), *pages(page, 6, 1, far), *pages(page, 2, 3, far)]
    sets = [shingle_set(t) for t in texts]
    family = [i - i % 9 for i in range(len(texts))]
    rows = [(i, f, len(sets[i]), t) for i, (f, t) in enumerate(zip(family, texts))]
    members = spark.createDataFrame(rows, "set_ long, family_ long, n_ long, text string")
    held = jaccard_join.stored(jaccard_join.stars(members, 90))
    pairs = spark.createDataFrame(
        [(i, j, len(sets[i]), len(sets[j])) for i in range(len(sets)) for j in range(i)
         if family[i] != family[j]], "a long, b long, na long, nb long",
    )
    tagged = jaccard_join.behind_pivots(pairs, held)
    heads = tagged.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()
    whole = members.select("set_", "text")
    answers = jaccard_join.stored(jaccard_join.overlaps(heads, whole, 90))
    told = jaccard_join.from_pivots(tagged, answers, 90).collect()
    said = [r for r in told if r.linked is not None]
    assert len(said) * 2 > len(told)
    for r in said:
        both = len(sets[r.a] & sets[r.b])
        assert r.linked == (190 * both >= 90 * (len(sets[r.a]) + len(sets[r.b])))
