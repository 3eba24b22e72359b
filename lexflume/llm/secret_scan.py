"""Secret scans over an incremental ledger of blobs.

Every version of a text is addressed by the SHA-256 of its content. The ledger holds a row per blob and version of the
rules that has been scanned, with its findings, also where there are none. A scan takes each unseen pair once, however
many paths hold the blob, and joins findings back to all paths.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexflume.llm.common import kept, table

#: kind, pattern, group whose length counts, its least length. The first three are the base rules; the rest are added.
RULES = (
    ("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A | re.I, 2, 12),
    ("access", r"AKIA[A-Z0-9]+", re.A, 0, 18),
    ("hex", r"[0-9a-f]+", re.A, 0, 16),
    ("pem", r"-----BEGIN[A-Z\x20]*PRIVATE KEY-----(?:[A-Za-z0-9+/=\s:,-]*?-----END[A-Z\x20]*PRIVATE KEY-----)?", re.A, 0, 0),
    ("github", r"gh[pousr]_[A-Za-z0-9]+", re.A, 0, 40),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]+", re.A, 0, 15),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", re.A, 0, 40),
    ("url", r"[a-z][a-z0-9+.-]{0,30}://[^\s/:@]{1,256}:[^\s/:@]{1,256}@", re.A, 0, 0),
)
BASE = 3
#: Names the rules above; a change of any rule is a new version.
VERSION = hashlib.sha256(repr([(kind, pattern, int(flags), group, least) for kind, pattern, flags, group, least in RULES]).encode()).hexdigest()[:16]
#: A run of hexadecimal digits is found by its least length at once; runs are maximal, so the matches are the same.
_FAST = {"hex": r"[0-9a-f]{16,}"}
_COMPILED = [(kind, re.compile(_FAST.get(kind, pattern), flags), group, least) for kind, pattern, flags, group, least in RULES]
LEDGER = "blob string, rules string, n_assign long, n_access long, n_hex long, base string, spans string"


def scan_text(text: str) -> tuple[list[int], str, str]:
    """Counts of the base kinds, the base spans, all spans. Spans are kind:start:end in code points, comma-joined."""
    found, counts = [], [0] * BASE
    for k, (kind, pattern, group, least) in enumerate(_COMPILED):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
                if k < BASE:
                    counts[k] += 1
    found.sort()
    return counts, ",".join(x for _, k, x in found if k < BASE), ",".join(x for _, _, x in found)


def _scan(batches: Iterator[pd.DataFrame], version: str) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for blob, text in zip(b["blob"], b["text"], strict=True):
            counts, base, spans = scan_text(text)
            out.append((blob, version, *counts, base, spans))
        yield pd.DataFrame(out, columns=[x.split()[0] for x in LEDGER.split(", ")])


def scan(versions: DataFrame, ledger: DataFrame | None = None, path: str = "path") -> tuple[DataFrame, DataFrame]:
    """(findings per path, rows that the ledger gains) for versions (path, text).

    A null text is an empty one. Several versions may share a path; null paths are kept. Blobs that the ledger has under
    this version of the rules are not read again; the gained rows are to be appended to it. An empty table gives empty
    results. Other columns aren't looked at. A ledger that holds a row several times, as after an append that was tried
    again, counts it once.
    """
    spark = versions.sparkSession
    ledger = ledger if ledger is not None else spark.createDataFrame([], LEDGER)
    v = versions.select(path, F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("blob", F.sha2(F.col("text").cast("binary"), 256))
    version = VERSION
    known = ledger.where(F.col("rules") == version).dropDuplicates(["blob"])
    ids = kept(v.select(path, "blob"))
    unseen = ids.groupBy("blob").agg(F.count(F.lit(1)).alias("_paths"), F.min(path).alias("_path")).join(known, "blob", "left_anti")
    # of all the rows that hold a blob, one path's are read; the narrow side is hashed, so texts aren't sorted
    one = unseen.select(F.col("blob").alias("_blob"), "_path").hint("shuffle_hash")
    texts = v.join(one, (F.col("blob") == F.col("_blob")) & F.col(path).eqNullSafe(F.col("_path"))).select("blob", "text")
    gained = kept(texts.mapInPandas(lambda batches: _scan(batches, version), LEDGER).dropDuplicates(["blob"]))
    found = ids.join(known.unionByName(gained), "blob").drop("rules")
    return found, gained


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger in a folder of the shared store; an empty one where there is none yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    some = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(LEDGER).parquet(folder) if some else spark.createDataFrame([], LEDGER)


def scan_history(versions: DataFrame, folder: str, path: str = "path") -> DataFrame:
    """Findings per path of versions; what the ledger in the folder gains is appended to it."""
    found, gained = scan(versions, read_ledger(versions.sparkSession, folder), path)
    found = kept(found)  # the ledger is read before it grows
    gained.write.mode("append").parquet(folder)
    return found


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = scan(table(spark, sf_dir, "documents"), path="doc_id")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans", "blob")
