"""Bounded-space online packing of token sequences.

Each partition keeps a fixed number of open windows. A document's ids are cut at multiples of the window's size; the
full pieces are windows of their own, and the rest is placed in the open window that it fills best. When none has room,
the fullest is emitted and a new one opened. What is still open at the end of the partitions is merged: the leftovers
of some partitions at a time are strung together and cut into full windows, the end into powers of two, which need no
padding.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexflume.llm.common import kept, table

SIZE, OPEN, END = 2048, 256, 1
#: Partitions whose leftovers are merged together: at most MERGED * OPEN windows, 8 MB of ids.
MERGED = 4
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def tokenizer(path: str):
    """A function from texts to lists of ids, as the tokenizers library gives them for the file at path."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def ranked_tokenizer(path: str):
    """The same ids by tiktoken, from the same vocabulary and pre-tokenizer; several times faster.

    The file of ranks beside the tokenizer's own holds the same vocabulary, and special tokens' strings in a text
    count as those tokens, as there.
    """
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
    special = {"<|endoftext|>": len(ranks)}
    t = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda texts: [t.encode(x, allowed_special="all") for x in texts]


class Packer:
    """Open windows of one partition. Pieces are (doc_id, start, ids, doc_tokens)."""

    def __init__(self, size: int = SIZE, most: int = OPEN):
        self.size, self.most = size, most
        self.by_room: list[tuple[int, int]] = []  # (room, window), sorted
        self.windows: dict[int, list] = {}
        self.made = 0

    def place(self, piece) -> list[list]:
        """The windows that became ready. A piece that fills a window is one of its own, whatever else is open."""
        n, ready = len(piece[2]), []
        if n == self.size:
            return [[piece]]
        at = bisect.bisect_left(self.by_room, (n, -1))
        if at < len(self.by_room):
            room, w = self.by_room.pop(at)
        else:
            if len(self.windows) == self.most:
                ready.append(self.windows.pop(self.by_room.pop(0)[1]))
            room, w = self.size, self.made
            self.made += 1
            self.windows[w] = []
        self.windows[w].append(piece)
        if room == n:
            ready.append(self.windows.pop(w))
        else:
            bisect.insort(self.by_room, (room - n, w))
        return ready


def _rows(window: list, sequence: int) -> list[tuple]:
    out, at = [], 0
    for doc_id, start, ids, total in window:
        out.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, at))
        at += len(ids)
    return out


NAMES = [x.split()[0] for x in SCHEMA.split(", ")]


def _pack(path: str, encoder, size: int, most: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encode, packer, made = encoder(path), Packer(size, most), 0
        full: list[tuple] = []

        def frame(rows, ids=None, window=None):
            f = pd.DataFrame(rows, columns=NAMES)
            f["doc_id"] = f["doc_id"].astype("Int64")
            f["part"], f["ids"], f["window"] = part, ids, window
            return f

        for batch in batches:
            texts, keys = batch["text"].tolist(), batch["doc_id"].tolist()
            for a in range(0, len(texts), 64):
                some = [x if isinstance(x, str) else "" for x in texts[a : a + 64]]
                for doc_id, ids in zip(keys[a : a + 64], encode(some), strict=True):
                    ids = np.array([*ids, END], dtype=np.uint32)
                    key = None if doc_id is None or doc_id != doc_id else int(doc_id)
                    for start in range(0, len(ids), size):
                        for w in packer.place((key, start, ids[start : start + size], len(ids))):
                            full += _rows(w, (part << 32) + made)
                            made += 1
            if full:
                yield frame(full)
                full = []
        for k, w in enumerate(packer.windows[x] for x in sorted(packer.windows)):
            yield frame(_rows(w, (part << 32) + k), [x[2].astype("<u4").tobytes() for x in w], k)

    return run


def _merge(size: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """The leftovers of a group of partitions, in their order, cut into full windows and an end of powers of two."""
        rows = rows.sort_values(["part", "window", "offset"], kind="stable")
        left = int(rows["length"].sum())
        sizes = [size] * (left // size) + [1 << b for b in range(size.bit_length() - 1, -1, -1) if (left % size) >> b & 1]
        # beyond the ids that partitions give: the first half of the numbers of sequences is theirs
        base, out, k, room, window = (1 << 62) + (int(key[0]) << 32), [], 0, sizes[0] if sizes else 0, []
        for r in rows.itertuples():
            ids, at = np.frombuffer(r.ids, dtype="<u4"), 0
            key_ = None if r.doc_id is None or r.doc_id != r.doc_id or r.doc_id is pd.NA else int(r.doc_id)
            while at < len(ids):
                n = min(room, len(ids) - at)
                window.append((key_, r.start + at, ids[at : at + n], r.doc_tokens))
                at, room = at + n, room - n
                if not room:
                    out += _rows(window, base + k)
                    k, window = k + 1, []
                    room = sizes[k] if k < len(sizes) else 0
        f = pd.DataFrame(out, columns=NAMES)
        f["doc_id"] = f["doc_id"].astype("Int64")
        return f

    return run


def pack(docs: DataFrame, path: str | None = None, encoder=ranked_tokenizer, size: int = SIZE, most: int = OPEN) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of each piece of docs (doc_id, text).

    A document's ids are those of the tokenizer and END. A null or empty text has END alone. Null ids of documents
    stay null; repeated rows are packed each. The sequences of a partition depend on its rows and their order alone,
    so a task that is run again gives the same ones, and the pieces are kept before leftovers are read from them.
    An empty table gives an empty result; other columns aren't looked at.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    pieces = kept(docs.mapInPandas(_pack(path, encoder, size, most), SCHEMA + ", part int, ids binary, window long"))
    done = pieces.where("ids is null").select(*NAMES)
    left = pieces.where("ids is not null").groupBy(F.expr(f"part div {MERGED}").cast("long").alias("g")).applyInPandas(_merge(size), SCHEMA)
    return done.unionByName(left)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of docs (doc_id, text), as pack() defines them for nulls, empty texts, repeats and empty tables."""
    return pack(docs)
