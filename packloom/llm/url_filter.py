"""URL rules looked up in a sorted array of 64-bit digests.

The keys, xxhash digests of the rules' strings, are sorted and written to a file that Spark ships to the executors
(SparkContext.addFile); tasks map it into memory, probe it with a vectorised binary search and confirm each hit
against the rule's full string, which is stored beside it. A URL is probed with its host's suffixes at label
boundaries joined with its path's prefixes of the lengths that rules have.
"""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values: (verdict, host, path).
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: The verdict where no key is found.
OTHERWISE = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(key: str) -> int:
    return xxhash.xxh64_intdigest(key)


def write_index(folder: str, rules: Iterable[tuple[str, str, str]], hashed=digest) -> str:
    """The index as a file: a line of JSON (sizes, path lengths), the sorted keys, the strings' ends and the strings."""
    found = sorted({host + path: (hashed(host + path), verdict, len(path)) for verdict, host, path in rules}.items(), key=lambda x: (x[1][0], x[0]))
    texts = [json.dumps([verdict, key]).encode() for key, (_, verdict, _) in found]
    head = json.dumps({"n": len(found), "lengths": sorted({x[1][2] for x in found})}).encode() + b"\n"
    head += b" " * (-len(head) % 8)
    path = os.path.join(folder, f"url-rules-{uuid.uuid4().hex}.idx")
    with open(path, "wb") as f:
        f.write(len(head).to_bytes(8, "little") + head)
        f.write(np.array([x[1][0] for x in found], "<u8").tobytes())
        f.write(np.cumsum([0, *map(len, texts)], dtype="<u8").tobytes())
        f.write(b"".join(texts))
    return path


class Index:
    """A written index, mapped into memory."""

    def __init__(self, path: str, hashed=digest):
        self.hashed, data = hashed, np.memmap(path, np.uint8, "r")
        size = int.from_bytes(data[:8].tobytes(), "little")
        facts, at = json.loads(data[8 : 8 + size].tobytes()), 8 + size
        n, self.lengths = facts["n"], facts["lengths"]
        self.keys, self.ends, self.texts = data[at : at + 8 * n].view("<u8"), data[at + 8 * n : at + 16 * n + 8].view("<u8"), data[at + 16 * n + 8 :]

    def find(self, probes: list[str]) -> list[tuple[str, str] | None]:
        """(verdict, rule) of each probe that is a stored string, confirmed in full; else None."""
        hashes = np.fromiter(map(self.hashed, probes), "<u8", len(probes))
        first, last = np.searchsorted(self.keys, hashes, "left"), np.searchsorted(self.keys, hashes, "right")
        out: list[tuple[str, str] | None] = [None] * len(probes)
        for i in np.flatnonzero(last > first).tolist():
            for k in range(first[i], last[i]):
                verdict, rule = json.loads(self.texts[int(self.ends[k]) : int(self.ends[k + 1])].tobytes())
                if rule == probes[i]:
                    out[i] = verdict, rule
        return out


def probes(host: str, path: str, lengths: list[int]) -> list[str]:
    """The strings that a rule for this URL could have."""
    labels = host.split(".")
    return [".".join(labels[k:]) + path[:n] for k in range(len(labels)) for n in lengths if n <= len(path)] if host else []


def _judge(name: str, otherwise: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(SparkFiles.get(name))
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            own = [probes(h, p, index.lengths) for h, p in zip(hosts, paths, strict=True)]
            found, at, rules, verdicts = index.find([x for each in own for x in each]), 0, [], []
            for each in own:
                hits = [x for x in found[at : at + len(each)] if x]
                at += len(each)
                verdict, rule = max(hits, key=lambda x: len(x[1])) if hits else (otherwise, None)
                rules.append(rule)
                verdicts.append(verdict)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], ["page_id", "host", "path", "rule", "verdict"])

    return run


def ship(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> str:
    """Writes the index and has Spark send it to every executor, present and future; returns its name there."""
    path = write_index(tempfile.mkdtemp(prefix="packloom-"), rules)
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def judge(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, otherwise: str = OTHERWISE) -> DataFrame:
    """page_id, host, path, rule, verdict of each page's url.

    Host: from after the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; path: on up to "?", "#" or the
    end. Null urls and urls without "://": both empty, no rule. The longest fitting rule wins. Repeated rows are
    judged each; no rows: none; other columns are ignored.
    """
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    kind = dict(rows.dtypes)["page_id"]
    return rows.mapInArrow(_judge(ship(pages.sparkSession, rules), otherwise), f"page_id {kind}, host string, path string, rule string, verdict string")


ORACLE = r"""
WITH parsed AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), rules(verdict, rh, rp) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), hits AS (
  SELECT page_id, max_by(rh || rp, length(rh || rp)) AS rule, max_by(verdict, length(rh || rp)) AS verdict
  FROM parsed JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id
)
SELECT p.page_id, p.host, p.path, h.rule, coalesce(h.verdict, 'allow') AS verdict FROM parsed p LEFT JOIN hits h USING (page_id)
"""
