import oracle
import pytest

from logweir.llm import url_lists
from logweir.llm.url_lists import FILES, OP8_SQL, DigestArray, judge_urls, op8_digest_array

SF = "/root/testdata/sf0.001"


def test_query_against_sql(spark):
    got = oracle.spark_rows(op8_digest_array(spark, SF))
    assert got == oracle.duckdb_rows(oracle.connect(SF), OP8_SQL)


def brute_force(rules, host, path):
    fits = [
        (len(h) + len(p), len(h), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[2:] if fits else (None, None)


@pytest.mark.parametrize("digest", [None, lambda text: len(text) % 3, lambda text: 7])
def test_collisions_are_confirmed_by_string(tmp_path, digest):
    rules = [(f"h{i}.com", f"/p{i % 7}", "block" if i % 2 else "allow") for i in range(60)]
    rules += [("com", "", "allow"), ("h1.com", "/p", "block")]
    DigestArray.write(str(tmp_path), rules, digest)
    assert {p.stem for p in tmp_path.iterdir()} == set(FILES)
    array = DigestArray(lambda name: str(tmp_path / f"{name}.npy"), digest)
    urls = [(f"a.h{i}.com", f"/p{i % 5}x") for i in range(80)] + [("", ""), ("xh1.com", "/p1")]
    entries, verdicts = array.judge([h for h, _ in urls], [p for _, p in urls])
    assert list(zip(entries, verdicts)) == [brute_force(rules, h, p) for h, p in urls]


def test_hard_rows(spark):
    urls = ["http://A.NET/x", "http://a.net", None, "", "no scheme", "x://y.org/fr/?q", "http://\nnet/"]
    rows = [(i, u, 9, "old") for i, u in enumerate([*urls, urls[0]])]
    pages = spark.createDataFrame(rows, "page_id long, url string, keys int, rule string")
    split = pages.withColumns(
        {"host": url_lists.url_host(pages["url"]), "path": url_lists.url_path(pages["url"])}
    )
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(split, url_lists.RULES).collect()}
    assert got[0] == got[7] == ("a.net", "/x", "net/", "block")
    assert got[1] == ("a.net", "", None, "allow")
    assert got[2] == got[3] == got[4] == ("", "", None, "allow")
    assert got[5] == ("y.org", "/fr/", "org/fr/", "allow")
    assert judge_urls(split.limit(0), url_lists.RULES).count() == 0
    assert {r.verdict for r in judge_urls(split, []).collect()} == {"allow"}


def test_verdicts_of_any_length(spark):
    pages = spark.createDataFrame([(1, "a.net", "/")], "page_id long, host string, path string")
    long = "block_this_source_for_ever"
    assert judge_urls(pages, [("net", "/", long), ("org", "/", "x")]).first().verdict == long
