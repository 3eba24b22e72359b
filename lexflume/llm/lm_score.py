"""LM scoring with an n-gram model whose levels are Elias-Fano shards.

Chunks. Texts are coded in chunks: a chunk lists its distinct words, sorted by hash, and its tokens as places in that
list. What a chunk must know of its words, pairs and triples it asks of shards by hash: a request lists a chunk's
distinct keys of one order with their training counts, a shard adds up what all chunks send and answers each chunk in
the order of its list. A key is one entry per chunk, so no shard grows with a key's frequency.

Rounds. Words and pairs are asked for first. A triple can't be more frequent than its pairs, so of the triples only those
are asked for whose two pairs are kept.

Model. Every n-gram of orders 2 and 3 with at least LEAST training occurrences is kept, whatever the size of the corpus;
nothing of the model is collected or broadcast, and there are as many shards as input partitions. A shard is a slice of
one level: the hashes of its kept n-grams as an ascending sequence in Elias-Fano form, with their counts.
Probabilities interpolate absolute discounting down to add-one unigrams, whose counts are exact for every word. What a
context's kept successors take from it is summed in a last round: of the chunks that list an n-gram, one owns it and
adds it to its context, and contexts are summed by shards like counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexflume.llm.common import freed, held_out, kept, mix64, table
from lexflume.llm.elias_fano import EliasFano

FOLDS, HELD = 7, 2
LEAST, DISCOUNT = 2, 0.75
CHUNK_BYTES, CHUNK_DOCS = 8_000_000, 8192
#: What requests are about: words, pairs and triples, then the words and pairs that are contexts.
WORDS, PAIRS, TRIPLES, AFTER_WORD, AFTER_PAIR = range(5)
#: The word that ends a text, and stands before its first.
MARK = np.uint64(xxhash.xxh3_64_intdigest(b""))
_ODD = 0x9E3779B97F4A7C15


def _z(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def _u(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def _zk(keys: np.ndarray) -> bytes:
    """Ascending hashes as differences, byte planes apart: the upper planes are all but empty."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    return _z(gaps.view(np.uint8).reshape(-1, 8).T)


def _uk(b: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(_u(b, np.uint8).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


CODED = "chunk long, n long, ids binary, nulls binary, lens binary, flags binary, tokens binary, words binary"


class _Local(dict):
    """Places of words in order of first sight."""

    def __missing__(self, w: bytes) -> int:
        v = self[w] = len(self)
        return v


def _encode():
    names = [x.split()[0] for x in CODED.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        local, ids, nulls, lens, flags, tokens, size = _Local(), [], [], [], [], [], 0

        def flush():
            chunk = (part << 24) + made
            words = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in local), np.uint64, len(local))
            words, place = np.unique(words, return_inverse=True)
            flat = place[np.concatenate(tokens)].astype(np.uint32)
            train = np.repeat(np.array(flags, bool), lens)
            row = (chunk, int(train.sum()), _z(np.array(ids, np.int64)), _z(np.array(nulls, bool)), _z(np.array(lens, np.int64)), _z(np.array(flags, bool)), _z(flat), _zk(words))
            return pd.DataFrame([row], columns=names)

        for b in batches:
            for doc_id, text, train in zip(b["doc_id"], b["text"], b["train"], strict=True):
                raw = text.encode("utf-8", "replace").lower() if isinstance(text, str) else b""
                w = raw.split()
                w.append(b"")  # the end
                null = doc_id is None or doc_id != doc_id or doc_id is pd.NA
                ids.append(0 if null else int(doc_id))
                nulls.append(null)
                lens.append(len(w))
                flags.append(bool(train))
                tokens.append(np.fromiter(map(local.__getitem__, w), np.int64, len(w)))
                size += len(raw)
                if size >= CHUNK_BYTES or len(ids) >= CHUNK_DOCS:
                    yield flush()
                    made += 1
                    local, ids, nulls, lens, flags, tokens, size = _Local(), [], [], [], [], [], 0
        if ids:
            yield flush()

    return run


class _Chunk:
    """The texts of a coded row: keys of its words and pairs, and each token's places among them.

    one is the place of the word before a token; a text's first token has an end before it. later are the others, which
    end a triple too.
    """

    def __init__(self, r):
        self.chunk, self.ids, self.nulls, self.lens = r.chunk, _u(r.ids, np.int64), _u(r.nulls, bool), _u(r.lens, np.int64)
        self.train = np.repeat(_u(r.flags, bool), self.lens)
        self.words, self.cur = _uk(r.words), _u(r.tokens, np.uint32).astype(np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.lens)[:-1]])
        self.one = np.concatenate([[0], self.cur[:-1]])
        self.one[self.start] = np.searchsorted(self.words, MARK)
        self.later = np.ones(len(self.cur), bool)
        self.later[self.start] = False
        self.later = np.flatnonzero(self.later)
        with np.errstate(over="ignore"):
            pair = mix64(self.words[self.one] * np.uint64(_ODD) + mix64(self.words)[self.cur])
        self.pairs, self.pair = np.unique(pair, return_inverse=True)

    def with_triples(self, pairs: np.ndarray) -> "_Chunk":
        """Adds the keys of the triples that can be kept, given the counts of pairs, and tokens' places among them, or -1."""
        at = self.later[(pairs[self.pair[self.later - 1]] >= LEAST) & (pairs[self.pair[self.later]] >= LEAST)]
        with np.errstate(over="ignore"):
            triple = mix64(self.pairs[self.pair[at - 1]] * np.uint64(_ODD) + mix64(self.words)[self.cur[at]])
        self.ended, self.triple = at, np.full(len(self.cur), -1, np.int64)
        self.triples, self.triple[at] = np.unique(triple, return_inverse=True)
        return self

    def counts(self, place: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(place[self.train & (place >= 0)], minlength=n).astype(np.int64)


def _dealt(chunk: int, kind: int, keys: np.ndarray, values: np.ndarray, shards: int) -> list[tuple]:
    """Requests of one kind: shards are ranges of hashes, so a sorted list is its shards' lists in order."""
    of = ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
    cut = np.searchsorted(of, np.arange(shards + 1))
    return [(chunk, kind, s, _zk(keys[cut[s] : cut[s + 1]]), _z(values[cut[s] : cut[s + 1]])) for s in range(shards) if cut[s] < cut[s + 1]]


REQUEST = "chunk long, kind int, part int, keys binary, sums binary"
ANSWER = "chunk long, kind int, part int, answers binary, v long"


def _asked(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[x.split()[0] for x in REQUEST.split(", ")])


def _ask(shards: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                x = _Chunk(r)
                for kind, keys, place in ((WORDS, x.words, x.cur), (PAIRS, x.pairs, x.pair)):
                    yield _asked(_dealt(x.chunk, kind, keys, x.counts(place, len(keys)), shards))

    return run


def _ask_triples(shards: int):
    def run(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        x = _Chunk(next(rows.itertuples())).with_triples(_answers(replies, PAIRS)[0])
        return _asked(_dealt(x.chunk, TRIPLES, x.triples, x.counts(x.triple, len(x.triples)), shards))

    return run


class Shard:
    """A slice of a level: its keys, ascending, in Elias-Fano form relative to the first that may be looked up."""

    def __init__(self, keys: np.ndarray, base: np.uint64):
        self.base, self.keys = base, EliasFano.of((keys - base).astype(np.int64))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        if not self.keys.n:
            return np.full(len(keys), -1, np.int64)
        x = (keys - self.base).astype(np.int64)
        at = self.keys.successor(x)
        return np.where((at < self.keys.n) & (self.keys.access(np.minimum(at, self.keys.n - 1)) == x), at, -1)


def _answer(rows: pd.DataFrame) -> pd.DataFrame:
    """Twice the kept totals of one shard's keys, plus one for the chunk that owns a key; row -1 has their number."""
    kind, part = int(rows["kind"].iloc[0]), int(rows["part"].iloc[0])
    lists = [_uk(x) for x in rows["keys"]]
    keys = np.concatenate(lists)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    total = np.add.reduceat(np.concatenate([_u(x, np.int64) for x in rows["sums"]])[order], first)
    fine = total >= (LEAST if kind in (PAIRS, TRIPLES) else 1)
    shard, total, own = Shard(ranked[first[fine]], ranked[0]), total[fine], np.zeros(len(keys), np.int64)
    own[order[first[fine]]] = 1
    at, out = 0, []
    for chunk, asked in zip(rows["chunk"], lists, strict=True):
        place = shard.find(asked)
        got = np.where(place >= 0, 2 * total[place], 0) if len(total) else np.zeros(len(asked), np.int64)
        out.append((chunk, kind, part, _z(got + own[at : at + len(asked)]), 0))
        at += len(asked)
    if kind == WORDS:
        out.append((-1, kind, part, None, len(total)))
    return pd.DataFrame(out, columns=[x.split()[0] for x in ANSWER.split(", ")])


def _answers(replies: pd.DataFrame, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Totals of a chunk's keys of one kind, and which of them it owns."""
    mine = replies[replies["kind"] == kind].sort_values("part")
    a = np.concatenate([np.zeros(0, np.int64), *[_u(x, np.int64) for x in mine["answers"]]])
    return a >> 1, (a & 1).astype(bool)


def _contexts(x: _Chunk, words: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words and pairs of a chunk that can have kept successors."""
    used = np.zeros(len(pairs), bool)
    used[x.pair[x.later - 1]] = True
    return np.flatnonzero(words >= LEAST), np.flatnonzero(used & (pairs >= LEAST))


def _ask_contexts(shards: int):
    def run(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        """What the kept n-grams that a chunk owns take from their contexts, in units of a quarter."""
        x = _Chunk(next(rows.itertuples()))
        words, _ = _answers(replies, WORDS)
        (pairs, own2), (triples, own3) = _answers(replies, PAIRS), _answers(replies, TRIPLES)
        x.with_triples(pairs)
        of_pair, of_triple = np.zeros(len(pairs), np.int64), np.zeros(len(triples), np.int64)
        of_pair[x.pair] = x.one
        of_triple[x.triple[x.ended]] = x.pair[x.ended - 1]
        taken = lambda of, n, own, size: np.bincount(of[own], 4 * (n[own] - DISCOUNT), size).astype(np.int64)
        w, p = _contexts(x, words, pairs)
        out = _dealt(x.chunk, AFTER_WORD, x.words[w], taken(of_pair, pairs, own2, len(words))[w], shards)
        return _asked(out + _dealt(x.chunk, AFTER_PAIR, x.pairs[p], taken(of_triple, triples, own3, len(pairs))[p], shards))

    return run


SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _score(whole: int):
    def run(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        x = _Chunk(next(rows.itertuples()))
        (words, _), (pairs, _), (triples, _) = (_answers(replies, k) for k in (WORDS, PAIRS, TRIPLES))
        x.with_triples(pairs)
        w, p = _contexts(x, words, pairs)

        def spare(kind, place, counts):
            out = np.ones(len(counts))
            out[place] = np.maximum(1e-9, 1.0 - _answers(replies, kind)[0] / (4.0 * counts[place]))
            return out

        after_word, after_pair = spare(AFTER_WORD, w, words), spare(AFTER_PAIR, p, pairs)
        own = lambda n, context: np.where(n > 0, (n - DISCOUNT) / np.maximum(1, context), 0.0)
        base = np.log10(words[x.cur] + 1.0) - math.log10(whole)
        prob = own(pairs[x.pair], words[x.one]) + after_word[x.one] * ((words[x.cur] + 1.0) / whole)
        # the context of order two is the pair that ends one token before, in the same text
        ctx = x.pair[x.later - 1]
        prob[x.later] = own(np.append(triples, 0)[x.triple[x.later]], pairs[ctx]) + after_pair[ctx] * prob[x.later]
        add = lambda a: np.add.reduceat(a, x.start)
        ids = pd.array(x.ids, dtype="Int64")
        ids[x.nulls] = pd.NA
        return pd.DataFrame({"doc_id": ids, "n_tokens": x.lens, "n_known": add((words[x.cur] > 0).astype(np.int64)), "base_score": add(base), "score": add(np.log10(prob))})

    return run


def lm_score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row of docs (doc_id, text).

    Words and n-grams are told apart by 64-bit hashes. A null text is an empty one: its only token is the end. Null ids
    are in no fold, so they train. Repeated rows count and are scored each. Without training tokens every probability is
    that of an unseen word. An empty table gives an empty result; other columns aren't looked at.
    """
    d = docs.select(F.col("doc_id").cast("long"), "text")
    d = d.withColumn("train", ~F.coalesce(held_out(F.col("doc_id"), FOLDS, HELD), F.lit(False)))
    shards = max(8, d._jdf.queryExecution().toRdd().getNumPartitions())  # in proportion to the input
    coded = kept(d.mapInPandas(_encode(), CODED))
    n = coded.agg(F.sum("n")).first()[0] or 0
    counts = kept(coded.mapInPandas(_ask(shards), REQUEST).groupBy("kind", "part").applyInPandas(_answer, ANSWER))
    freed(d.sparkSession)
    v = counts.where("chunk = -1").agg(F.sum("v")).first()[0] or 0
    counts = counts.where("chunk >= 0")
    triples = coded.groupBy("chunk").cogroup(counts.where(F.col("kind") == PAIRS).groupBy("chunk")).applyInPandas(_ask_triples(shards), REQUEST)
    counts = counts.union(kept(triples.groupBy("kind", "part").applyInPandas(_answer, ANSWER)))
    del triples
    freed(d.sparkSession)
    taken = coded.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInPandas(_ask_contexts(shards), REQUEST)
    taken = kept(taken.groupBy("kind", "part").applyInPandas(_answer, ANSWER))
    freed(d.sparkSession)
    out = coded.groupBy("chunk").cogroup(counts.union(taken).groupBy("chunk")).applyInPandas(_score(n + v + 1), SCORED)
    return out.select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD).alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(table(spark, sf_dir, "documents"))
