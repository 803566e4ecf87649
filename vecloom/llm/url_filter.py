"""URL filter: a memory-mapped sorted array of rule digests.

Rules are ``(action, host, path)``.  Each one is stored under the 64-bit xxhash
of its full string ``host + path``; the sorted digests lie in one file that every
Python worker maps into memory, so workers of one machine share its pages.  A
batch of URLs turns into one vector of probe keys (every parent domain of the
host with every rule-path length), which a single vectorised binary search
looks up.  Hits are confirmed against the stored full strings, so a digest
collision can not decide a URL.

The array is shipped with the job's files while it is below ``max_array_rules``;
beyond that the probes are joined with the rule table on digest and full string,
with the same result.

Defined results: a null URL or one without ``://`` has an empty host and path; a
URL that no rule fits gets ``rule`` null and the filter's default verdict; of
rules that fit, the longest full string wins, and of two rules with the same
string the one that blocks.  An empty rule table gives the default everywhere.
Columns of the input named like the results are replaced.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import fresh_name, without

MAX_ARRAY_RULES = 5_000_000
_BLOCK, _ALLOW = "block", "allow"
_RESULTS = ("host", "path", "rule", "verdict")
_OPEN: dict[str, RuleArray] = {}


def url_host(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(_part(url, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: str | Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return _part(url, 2)


def _part(url: str | Column, group: int) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit(""))


def pack_rules(rules: list[tuple[str, str, str]]) -> bytes:
    """The file: number of rules, sorted digests, offsets, actions, then the full strings."""
    best: dict[bytes, str] = {}
    for action, host, path in rules:
        full = (host.lower() + path).encode()
        best[full] = _BLOCK if _BLOCK in (action, best.get(full)) else _ALLOW
    keyed = sorted((xxhash.xxh64_intdigest(full), full) for full in best)
    digests = np.array([d for d, _ in keyed], dtype="<u8")
    offsets = np.concatenate([[0], np.cumsum([len(f) for _, f in keyed], dtype="<u8")]).astype("<u8")
    blocks = np.array([best[f] == _BLOCK for _, f in keyed], dtype="u1")
    hosts = np.array([f.find(b"/") if b"/" in f else len(f) for _, f in keyed], dtype="<u8")
    lengths = np.unique(np.array([len(f) for _, f in keyed], dtype="<u8") - hosts)
    head = np.array([len(keyed), len(lengths)], dtype="<u8")
    return b"".join([*(a.tobytes() for a in (head, lengths, digests, offsets, blocks)), *(f for _, f in keyed)])


class RuleArray:
    """Sorted digests over a memory-mapped file, probed in batches."""

    def __init__(self, file: str) -> None:
        data = np.memmap(file, dtype="u1", mode="r")
        n, kinds = (int(x) for x in data[:16].view("<u8"))
        at = 16 + 8 * kinds
        self.path_lengths = [int(x) for x in data[16:at].view("<u8")]
        self.digests = data[at:at + 8 * n].view("<u8")
        self.offsets = data[at + 8 * n:at + 16 * n + 8].view("<u8")
        at += 16 * n + 8
        self.blocks, self.strings = data[at:at + n], data[at + n:]

    def find(self, keys: list[bytes]) -> np.ndarray:
        """Position of each key's rule, or -1."""
        found = np.full(len(keys), -1, dtype=np.int64)
        if not len(self.digests) or not keys:
            return found
        wanted = np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), dtype=np.uint64, count=len(keys))
        at = np.searchsorted(self.digests, wanted)
        for i in np.flatnonzero(self.digests[np.minimum(at, len(self.digests) - 1)] == wanted):
            j = int(at[i])
            while j < len(self.digests) and self.digests[j] == wanted[i]:  # colliding digests lie side by side
                if self.full(j) == keys[i]:
                    found[i] = j
                    break
                j += 1
        return found

    def full(self, j: int) -> bytes:
        return self.strings[int(self.offsets[j]):int(self.offsets[j + 1])].tobytes()


def probe_keys(host: str, path: str, path_lengths: list[int]) -> Iterator[bytes]:
    """Full strings of every rule that could fit: parent domains times rule-path lengths (in bytes)."""
    tail = path.encode()
    ends = [tail[:n] for n in path_lengths if n <= len(tail)]
    rest = host
    while rest:
        name = rest.encode()
        for end in ends:
            yield name + end
        rest = rest.partition(".")[2]


def filter_urls(
    pages: DataFrame, rules: DataFrame, *, url: str = "url", default: str = _ALLOW, max_array_rules: int = MAX_ARRAY_RULES
) -> DataFrame:
    """Add ``host, path, rule, verdict`` to every row; ``rules`` has columns ``action, host, path``."""
    spark = pages.sparkSession
    rules = rules.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("action", "host", "path")])
    held = rules.limit(max_array_rules + 1).toArrow()
    parts = without(pages, *_RESULTS) if url not in _RESULTS else pages
    parts = parts.withColumns({"host": url_host(pages[url]), "path": url_path(pages[url])})
    if held.num_rows > max_array_rules:
        return _joined(parts, rules, default)

    packed = pack_rules(list(zip(*(held.column(c).to_pylist() for c in ("action", "host", "path")), strict=True)))
    name = f"url-rules-{xxhash.xxh3_128_hexdigest(packed)}.bin"
    file = os.path.join(tempfile.gettempdir(), name)  # named by content: a second use is the same file
    with tempfile.NamedTemporaryFile(dir=os.path.dirname(file), delete=False) as out:
        out.write(packed)
    os.replace(out.name, file)
    spark.sparkContext.addFile(file)  # the driver serves it; each executor fetches its own copy once

    @F.pandas_udf("rule string, blocks boolean")
    def judge(hosts, paths):
        import pandas as pd

        if name not in _OPEN:
            _OPEN[name] = RuleArray(SparkFiles.get(name))
        array = _OPEN[name]
        keys, owner = [], []
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            for key in probe_keys(host, path, array.path_lengths):
                keys.append(key)
                owner.append(i)
        found = array.find(keys)
        best: list[int] = [-1] * len(hosts)
        for k in np.flatnonzero(found >= 0):
            i, j = owner[k], int(found[k])
            if best[i] < 0 or len(array.full(j)) > len(array.full(best[i])):
                best[i] = j
        return pd.DataFrame({
            "rule": [array.full(j).decode() if j >= 0 else None for j in best],
            "blocks": [bool(array.blocks[j]) if j >= 0 else None for j in best],
        })

    judged = fresh_name(parts, "__judged")
    return (
        parts.withColumn(judged, judge("host", "path"))
        .withColumns({
            "rule": F.col(f"{judged}.rule"),
            "verdict": F.when(F.col(f"{judged}.blocks"), _BLOCK).when(~F.col(f"{judged}.blocks"), _ALLOW).otherwise(default),
        })
        .drop(judged)
    )


def _joined(parts: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same verdicts for a rule table too large to ship: distinct (host, path) probes meet rules by digest."""
    table = (
        rules.groupBy(F.concat(F.lower("host"), "path").alias("rule"))
        .agg(F.max(F.col("action") == _BLOCK).alias("blocks"), F.max(F.octet_length("path")).alias("n"))
        .withColumn("digest", F.xxhash64("rule"))
    )
    lengths = F.broadcast(table.agg(F.collect_set("n").alias("lengths")))  # one row, as many values as distinct lengths
    label = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(label)), lambda i: F.array_join(F.slice(label, i, F.size(label)), "."))
    urls = parts.select("host", "path").distinct()
    probes = (
        urls.join(lengths)
        .select("host", "path", F.explode(hosts).alias("part"), "lengths")
        .select("host", "path", "part", F.explode("lengths").alias("n"))
        .where((F.col("part") != "") & (F.octet_length("path") >= F.col("n")))
        .select("host", "path", F.concat("part", F.expr("cast(substr(cast(path as binary), 1, n) as string)")).alias("key"))
    )
    fits = probes.join(table, (F.xxhash64("key") == table["digest"]) & (F.col("key") == table["rule"]))
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "blocks"), F.octet_length("rule")).alias("best"))
    verdict = F.when(F.col("best.blocks"), _BLOCK).when(~F.col("best.blocks"), _ALLOW).otherwise(default)
    return parts.join(best, ["host", "path"], "left").withColumns({"rule": F.col("best.rule"), "verdict": verdict}).drop("best")
