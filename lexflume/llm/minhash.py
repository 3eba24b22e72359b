"""MinHash near-dedup by improved consistent weighted sampling over TF-IDF shingles.

Words are lower-cased and stripped of marks at their ends; a shingle is five words in a row (a shorter text is one
shingle). Documents with the same words are one text. A shingle's weight in a text is its count there times its inverse
document frequency, 1 + ln((1 + N) / (1 + df)), relative to that of a shingle of one text; N and df count different
texts, so exact copies don't make a text's shingles light. Texts are coded in chunks; a chunk asks shards, ranges of
hashes, for the frequencies of its shingles, which are exact but for shingles whose hashes of BITS bits are equal. Samples are drawn from
the weights by improved consistent weighted sampling (Ioffe, 2010): two texts share one with the probability of their weighted Jaccard
similarity. Texts that share all samples of a band are candidates; each is held against its bucket's hub, by the
signatures first and then exactly, by the counts of shingles alone: near copies share just what is frequent, and the
more of them there are the less it weighs, so weights would take large groups apart. Where a bucket's texts are then
in several components, blocks of it meet in tasks that compare what is still apart, and return links only: no pair is a
row unless it is a hub's or a link. Verified links form classes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexflume.llm.common import connected_components, freed, kept, mix64, table
from lexflume.llm.lm_score import _u, _uk, _z, _zk

WORDS, SIMILAR = 5, 0.8
BANDS, ROWS = 16, 3
#: Shared samples, of BANDS * ROWS, under which a pair isn't read: one whose weights are 0.6 alike, as those of a pair at
#: SIMILAR in a group of thousands of near copies are, has fewer once in 10,000 times.
SHARED = 16
#: Bits of a shingle's hash in chunks and shards.
BITS = 48
#: Bytes and texts of a chunk.
CHUNK_BYTES, CHUNK_DOCS = 4_000_000, 4096
#: Candidates of a hub that are verified in one run of rows.
RUN = 512
#: Texts of a bucket that are compared in one task, with as many others of it.
BLOCK = 512
_PRIMES = np.array([mix64(np.array([i + 1], np.uint64))[0] | np.uint64(1) for i in range(WORDS)], np.uint64)


class Words(dict):
    """64-bit hashes of words without case and outer marks; 0 for what has nothing else. Emptied beyond its bound."""

    MOST = 1_000_000

    def __missing__(self, w: bytes) -> int:
        core = w.decode("utf-8", "replace").lower()
        if not core.isalnum():
            a, b = 0, len(core)
            while a < b and not core[a].isalnum():
                a += 1
            while b > a and not core[b - 1].isalnum():
                b -= 1
            core = core[a:b]
        v = self[w] = xxhash.xxh3_64_intdigest(core.encode("utf-8", "replace")) | 1 if core else 0
        return v


def words(text: str | None, cache: Words) -> np.ndarray:
    if len(cache) > cache.MOST:
        cache.clear()
    w = text.encode("utf-8", "replace").split() if isinstance(text, str) else []  # at ASCII white space
    h = np.fromiter(map(cache.__getitem__, w), np.uint64, len(w))
    return h[h != 0]


def shingles(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the shingles of a sequence of words, and their counts."""
    n = max(1, len(h) - WORDS + 1) if len(h) else 0
    with np.errstate(over="ignore"):
        s = np.zeros(n, np.uint64)
        for k in range(min(WORDS, len(h))):
            s += h[k : k + n] * _PRIMES[k]
    return np.unique(mix64(s), return_counts=True)


_SCALE = np.float32(2.0**-32)


@functools.cache
def _odds(samples: int, salt: int) -> np.ndarray:
    return (mix64(np.arange(samples, dtype=np.uint64) + np.uint64(salt << 32)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def _draws(s: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r and ln c, with r and c Gamma(2, 1), and b uniform, for each element and sample, from hashes of both.

    32-bit arithmetic throughout, which is done on several lanes at once.
    """
    halves = s.view(np.uint32).reshape(-1, 2)
    low, high = np.ascontiguousarray(halves[:, 0])[:, None], np.ascontiguousarray(halves[:, 1])[:, None]

    def hashed(salt: int) -> np.ndarray:
        h = low * _odds(samples, salt)[None, :]
        h ^= high * _odds(samples, salt + 1)[None, :]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(16)
        return h

    def gamma(h: np.ndarray) -> np.ndarray:  # from two 16-bit uniforms
        u = (h & np.uint32(0xFFFF)).view(np.int32).astype(np.float32)
        u += np.float32(0.5)
        v = (h >> np.uint32(16)).view(np.int32).astype(np.float32)
        v += np.float32(0.5)
        u *= v
        u *= _SCALE
        return -np.log(u)

    one, two = hashed(1), hashed(3)
    r, c = gamma(one), np.log(gamma(two))
    one *= np.uint32(0x9E3779B1)
    one ^= two
    b = (one >> np.uint32(9)).view(np.int32).astype(np.float32) * np.float32(2.0**-23)
    return r, c, b


def signature(s: np.ndarray, weight: np.ndarray, samples: int = BANDS * ROWS) -> np.ndarray:
    """The samples of one weighted set, as 64-bit names.

    For sample k and element s, with t = floor(ln w / r + b), the element with the least c / (exp(r (t - b)) exp(r)) is
    sampled, under the name (s, t). For weight 1, the usual one, t is 0.
    """
    best, name = np.full(samples, np.inf, np.float32), np.zeros(samples, np.uint64)
    k = np.arange(samples)
    for some in (np.flatnonzero(weight == 1.0), np.flatnonzero(weight != 1.0)):
        for at in range(0, len(some), 192):
            own = some[at : at + 192]
            r, c, b = _draws(s[own], samples)
            if weight[own[0]] == 1.0:
                t = None
                a = c - r * (np.float32(1.0) - b)
            else:
                t = np.floor(np.log(weight[own])[:, None].astype(np.float32) / r + b)
                a = c - r * (t - b) - r
            i = a.argmin(axis=0)
            low = a[i, k]
            less = low < best
            best = np.where(less, low, best)
            turn = np.uint64(0) if t is None else t[i, k].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            name = np.where(less, mix64(s[own[i]] ^ turn), name)
    return name


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two sets with sorted elements: the sum of least weights over the sum of greatest."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1) if len(b[0]) else np.zeros(0, np.int64)
    both = b[0][at] == a[0][: len(at)]
    least = float(np.minimum(a[1][both], b[1][at[both]]).sum())
    total = float(a[1].sum() + b[1].sum()) - least
    return least / total if total else 0.0


CODED = "chunk long, ids binary, f1 binary, f2 binary, lens binary, keys binary, counts binary"
REQUEST = "chunk long, part int, keys binary, n binary"
ANSWER = "chunk long, part int, n binary"
SIGNED = "doc_id long, total double, sig binary, bands array<long>"


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])


def _encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks of the texts with words: ids, two halves of the words' fingerprints, and sorted shingles with their counts."""
    from pyspark import TaskContext

    part, made, cache = TaskContext.get().partitionId(), 0, Words()
    ids, marks, keys, counts, size = [], [], [], [], 0

    def flush():
        f = np.array([divmod(x, 1 << 64) for x in marks], np.uint64)
        lens = _z(np.fromiter(map(len, keys), np.int64, len(keys)))
        return _frame([((part << 24) + made, _z(np.array(ids, np.int64)), _z(f[:, 0]), _z(f[:, 1]), lens, _zk(np.concatenate(keys)), _z(np.concatenate(counts)))], CODED)

    for b in batches:
        for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
            h = words(text, cache)
            if not len(h):
                continue
            s, n = shingles(h)
            ids.append(doc_id)
            marks.append(xxhash.xxh3_128_intdigest(h.tobytes()))
            keys.append(s >> np.uint64(64 - BITS))
            counts.append(n.astype(np.int32))
            size += len(text)
            if size >= CHUNK_BYTES or len(ids) >= CHUNK_DOCS:
                yield flush()
                made += 1
                ids, marks, keys, counts, size = [], [], [], [], 0
    if ids:
        yield flush()


def _named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for r in b.itertuples():
            ids = _u(r.ids, np.int64)
            yield pd.DataFrame({"doc_id": ids, "f1": _u(r.f1, np.int64), "f2": _u(r.f2, np.int64), "chunk": r.chunk, "place": np.arange(len(ids))})


def _marked(rows: pd.DataFrame) -> pd.DataFrame:
    """A bit for each place of a chunk: whether its text is one of the rows."""
    own = np.zeros(CHUNK_DOCS, bool)
    own[rows["place"]] = True
    return pd.DataFrame({"chunk": rows["chunk"].iloc[:1], "own": [np.packbits(own).tobytes()]})


class _Chunk:
    """The texts of a coded row that stand for themselves and their copies: ends of their lists, shingles and counts."""

    def __init__(self, r):
        lens = _u(r.lens, np.int64)
        own = np.unpackbits(np.frombuffer(r.own, np.uint8), count=len(lens)).astype(bool)
        mine = np.repeat(own, lens)
        self.ids, self.ends = _u(r.ids, np.int64)[own], np.cumsum(lens[own])
        self.keys, self.counts = _uk(r.keys)[mine], _u(r.counts, np.int32)[mine]


def _ask(shards: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                keys, n = np.unique(_Chunk(r).keys, return_counts=True)
                cut = np.searchsorted(keys * np.uint64(shards) >> np.uint64(BITS), np.arange(shards + 1))
                yield _frame([(r.chunk, s, _zk(keys[lo:hi]), _z(n[lo:hi])) for s, (lo, hi) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if lo < hi], REQUEST)

    return run


def _answer(rows: pd.DataFrame) -> pd.DataFrame:
    """In how many texts each of the shingles stands that chunks ask one shard for."""
    lists = [_uk(x) for x in rows["keys"]]
    _, of = np.unique(np.concatenate(lists), return_inverse=True)
    total = np.bincount(of, np.concatenate([_u(x, np.int64) for x in rows["n"]])).astype(np.int64)[of]
    ends = np.cumsum([len(x) for x in lists])[:-1]
    return _frame([(c, p, _z(x)) for c, p, x in zip(rows["chunk"], rows["part"], np.split(total, ends), strict=True)], ANSWER)


def idf(df: np.ndarray, n: int) -> np.ndarray:
    """The inverse document frequency among n texts, relative to that of a shingle of one text, for which it is 1."""
    return (1.0 + np.log((1.0 + n) / (1.0 + df))) / (1.0 + np.log((1.0 + n) / 2.0))


def _sign(whole: int):
    def run(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return _frame([], SIGNED)
        x = _Chunk(next(rows.itertuples()))
        _, of = np.unique(x.keys, return_inverse=True)
        weight = x.counts * idf(np.concatenate([_u(a, np.int64) for a in replies.sort_values("part")["n"]]), whole)[of]
        seeds, out = mix64(x.keys), []
        for doc_id, lo, hi in zip(x.ids, np.append(0, x.ends[:-1]), x.ends, strict=True):
            name = signature(seeds[lo:hi], weight[lo:hi])
            band = mix64(name.reshape(BANDS, ROWS) * _PRIMES[:ROWS]).sum(axis=1, dtype=np.uint64)
            band = mix64(band + np.arange(BANDS, dtype=np.uint64))
            out.append((doc_id, float(x.counts[lo:hi].sum()), (name & np.uint64(255)).astype(np.uint8).tobytes(), band.view(np.int64)))
        return _frame(out, SIGNED)

    return run


def signed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, rep) of each document with words, and (doc_id, total, sig, bands) of each rep: the least id of those
    with the same words, its number of shingles, a byte per sample and band names."""
    d = docs.select("doc_id", "text")
    shards = max(8, d._jdf.queryExecution().toRdd().getNumPartitions())  # in proportion to the input
    coded = kept(d.mapInPandas(_encode, CODED))
    named = kept(coded.mapInPandas(_named, "doc_id long, f1 long, f2 long, chunk long, place int"))
    reps = kept(named.groupBy("f1", "f2").agg(F.min(F.struct("doc_id", "chunk", "place")).alias("r")).select("f1", "f2", "r.*"))
    member = kept(named.select("doc_id", "f1", "f2").join(reps.select("f1", "f2", F.col("doc_id").alias("rep")), ["f1", "f2"]).select("doc_id", "rep").distinct())
    # sent everywhere, a bit a document, so that chunks stay where they are
    own = coded.join(F.broadcast(kept(reps.groupBy("chunk").applyInPandas(_marked, "chunk long, own binary"))), "chunk")
    counts = kept(own.mapInPandas(_ask(shards), REQUEST).groupBy("part").applyInPandas(_answer, ANSWER))
    freed(d.sparkSession)
    return member, kept(own.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInPandas(_sign(reps.count()), SIGNED))


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of ids whose texts are similar. A hub a is sent once per RUN of its candidates, not per pair."""
    ids = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "_id")
    texts = kept(docs.join(ids.hint("shuffle_hash"), F.col("doc_id") == F.col("_id")).select("doc_id", "text").dropDuplicates(["doc_id"]))
    runs = pairs.groupBy("a").agg(F.expr(f"cast(count(1) div {RUN} + 1 as int)").alias("_runs"))
    dealt = kept(pairs.join(runs, "a").withColumn("run", F.pmod(F.xxhash64("b"), F.col("_runs")).cast("int")).select("a", "b", "run"))
    hubs = dealt.select("a", "run").distinct().join(texts, F.col("a") == F.col("doc_id")).select("a", "run", F.lit(None).cast("long").alias("b"), "text")
    others = dealt.join(texts, F.col("b") == F.col("doc_id")).select("a", "run", "b", "text")
    rows = hubs.unionByName(others).repartition("a", "run").sortWithinPartitions("a", "run", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, hub, own = Words(), None, None
        for batch in batches:
            out = []
            for a, b, text in zip(batch["a"], batch["b"], batch["text"], strict=True):
                s, n = shingles(words(text, cache))
                x = (s, n.astype(float))
                if b is None or b != b or b is pd.NA:
                    hub, own = a, x
                elif hub == a and similarity(own, x) >= SIMILAR:
                    out.append((a, int(b)))
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return rows.mapInPandas(run, "a long, b long")


def _likely(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """The pairs whose sizes and signatures let them be similar."""
    left, right = (sigs.select(F.col("doc_id").alias(c), F.col("sig").alias(f"s{c}"), F.col("total").alias(f"t{c}")) for c in "ab")
    both = pairs.join(left, "a").join(right, "b").where(F.least("ta", "tb") >= F.greatest("ta", "tb") * (SIMILAR - 1e-9)).select("a", "b", "sa", "sb")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            if len(x):
                n = BANDS * ROWS
                same = np.frombuffer(b"".join(x["sa"]), np.uint8).reshape(-1, n) == np.frombuffer(b"".join(x["sb"]), np.uint8).reshape(-1, n)
                yield x[same.sum(axis=1) >= SHARED][["a", "b"]]

    return both.mapInPandas(run, "a long, b long")


def across(rest: DataFrame, own: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) between texts of different components c that share a bucket; rest is (doc_id, band, value, c, n).

    A bucket of n texts is cut into blocks of about BLOCK; each two blocks, and each block with itself, meet in one place.
    There a pair is read in the first of the bands that it shares, if its signatures let it be similar and its
    components haven't been linked there before, so all components end as if every pair had been read.
    """
    ids = rest.select(F.col("doc_id").alias("_id")).distinct()
    texts = docs.join(ids.hint("shuffle_hash"), F.col("doc_id") == F.col("_id")).select("doc_id", "text").dropDuplicates(["doc_id"])
    texts = kept(texts.join(own.select("doc_id", "total", "sig", "bands"), "doc_id"))
    blocks = F.expr(f"cast((n + {BLOCK - 1}) div {BLOCK} as int)")
    r = rest.withColumn("block", F.pmod(F.xxhash64("doc_id"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    key = ["band", "value", "lo", "hi"]
    r = r.select("doc_id", "band", "value", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "c")
    rows = r.join(texts, "doc_id").repartition(*key).sortWithinPartitions(*key)

    def compare(band: int, g: pd.DataFrame, cache: Words) -> Iterator[tuple[int, int]]:
        sig, bands = np.frombuffer(b"".join(g["sig"]), np.uint8).reshape(len(g), -1), np.stack(g["bands"].to_numpy())
        total, block = g["total"].to_numpy(), g["block"].to_numpy()
        doc, one = g["doc_id"].to_numpy(), bool((g["lo"] == g["hi"]).iloc[0])
        roots, place = np.unique(g["c"].to_numpy(), return_inverse=True)
        label = place.copy()  # of the components linked so far
        sets: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def of(i: int):
            if i not in sets:
                s, n = shingles(words(g["text"].iloc[i], cache))
                sets[i] = (s, n.astype(float))
            return sets[i]

        for i in range(len(g) - 1):
            rest_ = np.arange(i + 1, len(g))
            fine = (label[rest_] != label[i]) & (np.minimum(total[rest_], total[i]) >= np.maximum(total[rest_], total[i]) * (SIMILAR - 1e-9))
            if not one:
                fine &= block[rest_] != block[i]
            rest_ = rest_[fine]
            if not len(rest_):
                continue
            fine = (sig[rest_] == sig[i]).sum(axis=1) >= SHARED
            fine &= ~(bands[rest_, :band] == bands[i, :band]).any(axis=1)
            for j in rest_[fine]:
                if label[j] != label[i] and similarity(of(i), of(int(j))) >= SIMILAR:
                    yield int(doc[i]), int(doc[j])
                    label[label == label[j]] = label[i]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, held = Words(), None
        for b in batches:
            b = b if held is None else pd.concat([held, b], ignore_index=True)
            starts = np.flatnonzero(np.concatenate([[True], (b[key].to_numpy()[1:] != b[key].to_numpy()[:-1]).any(axis=1)])) if len(b) else np.zeros(0, int)
            for lo, hi in zip(starts[:-1], starts[1:], strict=True):
                if hi - lo > 1:
                    yield pd.DataFrame([*compare(int(b["band"].iloc[lo]), b.iloc[lo:hi], cache)], columns=["a", "b"], dtype="int64")
            held = b.iloc[starts[-1] :] if len(starts) else None
        if held is not None and len(held) > 1:
            yield pd.DataFrame([*compare(int(held["band"].iloc[0]), held, cache)], columns=["a", "b"], dtype="int64")

    return rows.mapInPandas(run, "a long, b long").distinct()


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id) of each row of docs (doc_id, text); class_id is the least id of the class.

    Texts without words, null ones among them, are classes of their own. Rows with null ids get a null class and take no
    part. Rows that repeat an id and text are one document; of rows with one id and different texts, links of any of
    them count for the id. An empty table gives an empty result; other columns aren't looked at.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    some = docs.where("doc_id is not null")
    # documents with the same words: the least id stands for them
    member, sigs = signed(some)
    freed(docs.sparkSession)
    own = sigs.dropDuplicates(["doc_id"])
    banded = own.select("doc_id", F.posexplode("bands").alias("band", "value"))
    full = banded.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("h1"), F.min_by("doc_id", F.xxhash64("doc_id", "band")).alias("h2")).where("n > 1")
    buckets = kept(banded.join(full, ["band", "value"]).select("doc_id", "band", "value", "h1", "h2"))
    hub = F.when(F.col("band") % 3 == 0, F.col("h2")).otherwise(F.col("h1"))
    pairs = buckets.select(F.least(hub, F.col("doc_id")).alias("a"), F.greatest(hub, F.col("doc_id")).alias("b"), hub.alias("hub")).where("a <> b").select(F.col("hub").alias("a"), F.expr("if(a = hub, b, a)").alias("b")).distinct()
    narrow = own.select("doc_id", "sig", "total")
    linked = kept(verified(kept(_likely(pairs, narrow)), some))
    freed(docs.sparkSession)
    comp = connected_components(linked)
    # buckets whose texts are in several components
    marked = buckets.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("doc_id", "band", "value", F.coalesce("component", "doc_id").alias("c"))
    mixed = marked.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi and n > 2").select("band", "value", "n")
    rest = kept(marked.join(mixed, ["band", "value"]))
    if rest.take(1):
        more = kept(across(rest, own, some))
        freed(docs.sparkSession)
        comp = connected_components(comp.where("node <> component").toDF("a", "b").union(more))  # what hangs together already is so by one link
    of = member.join(comp.select(F.col("node").alias("rep"), "component"), "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("c")).groupBy("doc_id").agg(F.min("c").alias("c"))
    return docs.select("doc_id").join(of, "doc_id", "left").select("doc_id", F.coalesce("c", "doc_id").alias("class_id"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document with its class; the class's first document stays."""
    return classes(table(spark, sf_dir, "documents")).withColumn("stays", F.col("doc_id") == F.col("class_id"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those whose class has an earlier one; rows with null ids stay."""
    freed(spark)  # what earlier stages have left
    gone = classes(docs).where("class_id < doc_id").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(gone.hint("shuffle_hash"), docs["doc_id"].cast("long") == F.col("_id"), "left_anti")
