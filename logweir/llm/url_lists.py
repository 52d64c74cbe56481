"""URL lists as a sorted digest array, probed by vectorised binary search.

A list entry is a host with a path, like ``example.net/en/``; it fits its host and
all subdomains, for paths that start with the entry's path. The array holds the
sorted 64-bit xxhash of every entry, beside it the entries' strings. Each task maps
the files into memory, so all workers of a machine share one copy, hashes every
candidate (host suffix, path prefix) of its URLs, looks all of them up in one
binary search, and accepts a hit only if the stored string is equal.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import table, with_fields

# Entries of a list that is shipped to all executors (about 100 bytes each).
MAX_ENTRIES = 20_000_000
# URLs probed at once.
SLICE = 2_000

# Fixed rules of the registered query.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def url_host(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _UPPER.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    path = F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(path, F.lit(""))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


FILES = ("keys", "ends", "text", "verdicts", "path_lengths")


class DigestArray:
    """Sorted 64-bit keys with the strings and verdicts they stand for."""

    def __init__(
        self,
        place: Callable[[str], str],
        digest: Callable[[str], int] | None = None,
    ):
        """``place`` gives the path of each of ``FILES``."""

        def load(name: str) -> np.ndarray:
            return np.load(place(name), mmap_mode="r")

        self.keys, self.ends, self.text = load("keys"), load("ends"), load("text")
        self.verdicts, self.path_lengths = load("verdicts"), load("path_lengths")
        self.digest = digest or xxhash.xxh64_intdigest

    @staticmethod
    def write(
        folder: str,
        rules: Iterable[tuple[str, str, str]],
        digest: Callable[[str], int] | None = None,
    ) -> None:
        """Store rules (host, path, verdict); of equal ones the first counts."""
        digest = digest or xxhash.xxh64_intdigest
        first: dict[tuple[str, str], str] = {}
        for host, path, verdict in rules:
            first.setdefault((host, path), verdict)
        items = sorted((digest(_entry(h, p)), _entry(h, p), v) for (h, p), v in first.items())
        blobs = [text.encode() for _, text, _ in items]
        lengths = sorted({len(path) for _, path in first})
        for name, values in {
            "keys": np.array([key for key, _, _ in items], "uint64"),
            "ends": np.cumsum([0, *map(len, blobs)], dtype="int64"),
            "text": np.frombuffer(b"".join(blobs) or b"\0", "uint8"),
            "verdicts": np.array([v for _, _, v in items] or [""], "str"),
            "path_lengths": np.array(lengths, "int64"),
        }.items():
            np.save(os.path.join(folder, f"{name}.npy"), values)

    def find(self, entries: list[str]) -> np.ndarray:
        """The place of each string in the array, -1 where it isn't a member."""
        found = np.full(len(entries), -1, "int64")
        if not len(self.keys) or not entries:
            return found
        wanted = np.array([self.digest(e) for e in entries], "uint64")
        at = np.searchsorted(self.keys, wanted)
        inside = at < len(self.keys)
        hits = np.flatnonzero(inside)[self.keys[at[inside]] == wanted[inside]]
        for i in hits:
            place, text = int(at[i]), entries[i].encode()
            # Different strings may share a key; they lie side by side.
            while place < len(self.keys) and self.keys[place] == wanted[i]:
                if self.string(place) == text:
                    found[i] = place
                    break
                place += 1
        return found

    def string(self, place: int) -> bytes:
        return self.text[self.ends[place] : self.ends[place + 1]].tobytes()

    def candidates(self, host: str, path: str) -> list[str]:
        """All entries that would fit, the longest host and path first."""
        suffixes, rest = [], host
        while rest:
            suffixes.append(rest)
            rest = rest.partition(".")[2]
        prefixes = [path[:n] for n in self.path_lengths[::-1] if n <= len(path)]
        both = [(len(s) + len(p), len(s), _entry(s, p)) for s in suffixes for p in prefixes]
        return [entry for _, _, entry in sorted(both, reverse=True)]

    def judge(self, hosts: list[str], paths: list[str]) -> tuple[list, list]:
        """The longest fitting entry of each URL with its verdict, or None."""
        flat: list[str] = []
        owner: list[int] = []
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            own = self.candidates(host, path)
            flat += own
            owner += [i] * len(own)
        found = self.find(flat)
        entries, verdicts = [None] * len(hosts), [None] * len(hosts)
        for k in np.flatnonzero(found >= 0)[::-1]:  # the longest one last
            place = int(found[k])
            entries[owner[k]] = flat[k].replace("\0", "")
            verdicts[owner[k]] = str(self.verdicts[place])
        return entries, verdicts


def _entry(host: str, path: str) -> str:
    """Host and path as one string that no other pair can give."""
    return f"{host}\0{path}"


def _ship(spark, rules) -> str:
    """Send the array to all executors; the mark in the names of its files.

    Spark copies the files into each executor's own folder, where they are mapped.
    """
    mark = uuid.uuid4().hex
    folder = tempfile.mkdtemp(prefix="logweir-")  # tasks fetch from it until the end
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    DigestArray.write(folder, rules)
    for name in FILES:
        path = os.path.join(folder, f"{name}-{mark}.npy")
        os.rename(os.path.join(folder, f"{name}.npy"), path)
        spark.sparkContext.addFile(path)
    return mark


def judge_urls(
    urls: DataFrame,
    rules: Iterable[tuple[str, str, str]],
    host_col: str = "host",
    path_col: str = "path",
    default: str = "allow",
) -> DataFrame:
    """Add ``rule`` and ``verdict`` to rows with a host and a path.

    ``rules`` are (host, path, verdict) with lower-case hosts. The longest fitting
    rule decides, of equally long ones that with the longer host; URLs on no list
    get ``default`` and a null rule. Null or empty hosts fit no rule; a null path
    counts as empty. Older columns of these two names are replaced, all others
    kept. More than ``MAX_ENTRIES`` rules are refused: the array is copied to
    every executor, so its size must be bounded.
    """
    rules = list(rules)
    if len(rules) > MAX_ENTRIES:
        raise ValueError(f"more than {MAX_ENTRIES} rules")
    urls = urls.drop("rule", "verdict")
    mark = _ship(urls.sparkSession, rules)
    names = [*urls.columns, "rule", "verdict"]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = DigestArray(lambda name: SparkFiles.get(f"{name}-{mark}.npy"))
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                hosts = [h or "" for h in batch.column(host_col).to_pylist()]
                paths = [p or "" for p in batch.column(path_col).to_pylist()]
                entries, verdicts = digests.judge(hosts, paths)
                verdicts = [v or default for v in verdicts]
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns,
                        pa.array(entries, pa.string()),
                        pa.array(verdicts, pa.string()),
                    ],
                    names,
                )

    return urls.mapInArrow(probe, with_fields(urls, rule="string", verdict="string"))


def op8_digest_array(spark, sf_dir: str) -> DataFrame:
    url = F.col("url")
    pages = table(spark, sf_dir, "pages").select(
        "page_id", url_host(url).alias("host"), url_path(url).alias("path")
    )
    return judge_urls(pages, RULES)


_HOST = r"translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP8_SQL = f"""
WITH parts AS (
    SELECT page_id, {_HOST} AS host,
           regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path,
           row_number() OVER () AS row_no
    FROM pages
),
rules(rule_host, rule_path, says) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
           ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
fits AS (
    SELECT p.*, rule_host || rule_path AS rule, says,
           row_number() OVER (
               PARTITION BY row_no ORDER BY length(rule_host || rule_path) DESC
           ) AS place
    FROM parts p LEFT JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host))
     AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(says, 'allow') AS verdict
FROM fits WHERE place = 1"""
