"""Line dedup by a segment-partition edit join.

All lines that aren't empty are compared, without white space at their ends. Lines of FUZZY code points or more are
alike within EDITS edits, those from SHORT within one edit, shorter ones if they are equal; of two lines the shorter one
decides. Two lines within t edits share one of the t + 1
segments that the shorter is cut into, at a place that t bounds (Li, Deng, Wang and Feng, 2011): each line is indexed by
its own segments, and probes those of lines of its length and up to t less with the substrings that multi-match-aware
selection leaves. Keys hold length, segment and a hash of its text. Of what shares a key, the lines that have another
whose parity sketch is near (an edit changes at most two of its bits) meet again with their texts, in blocks, and each
pair is verified with a banded bit-parallel edit distance (Hyyro, 2003) under the least of the keys that it shares. No
pair is a row: a line gives its number of links there, and one link to the first line of those it hangs together with.
Linked lines form classes; a class's first line, by document id and place, stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexflume.llm.common import connected_components, freed, kept, mix64, split_join, table

EDITS, SHORT, FUZZY = 2, 16, 32
#: Sketches, or keys of pairs, that are compared at once.
MANY = 1 << 16
#: Lines, and code points of lines, of one key that meet in a task with as many others.
BLOCK, POINTS = 2048, 1 << 22
#: Entries of a key that a task gathers to compare sketches; a key with more is cut into blocks of as many.
GATHER = 1 << 20
#: Code points hashed at once.
CHUNK = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1


def row_key() -> Column:
    """Tells documents apart: rows with the same id and text are one, others aren't, null ids or not."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text"))


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, row, line, lid) of each line that is compared; row is row_key(), lid the 64-bit hash of the trimmed line."""
    d = docs.select(F.col("doc_id").cast("long"), row_key().alias("row"), F.posexplode(F.split("text", "\n")).alias("line", "t"))
    d = d.withColumn("t", F.trim("t", F.lit(" \t\n\x0b\f\r")))
    return d.where(F.length("t") > 0).select("doc_id", "row", "line", F.xxhash64("t").alias("lid"))


class Powers:
    """Powers of an odd number modulo 2^64 and of its inverse, grown as needed."""

    def __init__(self):
        self.n, self.up, self.down = 0, np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def grow(self, n: int) -> None:
        if n > self.n:
            size = max(n, CHUNK + 1)
            with np.errstate(over="ignore"):
                make = lambda b: np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, b, np.uint64))])
                self.up, self.down, self.n = make(np.uint64(_BASE)), make(np.uint64(pow(_BASE, -1, 1 << 64))), size


def segments(length: np.ndarray, edits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Start and size of each of the edits + 1 even segments of lines of the given lengths; the longer ones come last."""
    k = edits + 1
    size, more = length // k, length % k
    out, at = [], np.zeros_like(length)
    for i in range(k):
        own = size + (i >= k - more)
        out.append((at, own))
        at = at + own
    return out


def keys(lines: list[str], lids: np.ndarray, powers: Powers) -> tuple[np.ndarray, ...]:
    """(key, lid, sketch, probe) arrays of all index and probe entries of the lines."""
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    length = np.fromiter(map(len, lines), np.int64, len(lines))
    start = np.concatenate([[0], np.cumsum(length)[:-1]])
    powers.grow(len(points) + 1)
    with np.errstate(over="ignore"):
        code = mix64(points.astype(np.uint64))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(code * powers.up[: len(points)])])
        bit = (np.uint64(1) << (code & np.uint64(31))).astype(np.uint32)
        sketch = np.bitwise_xor.reduceat(bit, start)

        def entry(at, size, cls, i, edits):
            h = (sums[at + size] - sums[at]) * powers.down[at]
            return mix64(h + mix64(cls.astype(np.uint64) * np.uint64(2 * EDITS + 2) + np.uint64(i + (EDITS + 1) * (edits < EDITS))))

        key, who, probe = [], [], []

        def add(fine, at, size, cls, i, edits, probes):
            if fine.any():
                key.append(entry((start + at)[fine], size[fine], cls[fine], i, edits))
                who.append(np.flatnonzero(fine))
                probe.append(np.full(len(who[-1]), probes))

        for edits, low, high in ((EDITS, FUZZY, length.max(initial=0)), (1, SHORT, FUZZY - 1)):
            for i, (p, size) in enumerate(segments(length, edits)):
                add((length >= low) & (length <= high), p, size, length, i, edits, False)
            for less in range(edits + 1):
                shorter = length - less
                for i, (p, size) in enumerate(segments(shorter, edits)):
                    least, most = max(-i, less - (edits - i)), min(i, less + (edits - i))
                    for off in range(least, most + 1):
                        at = p + off
                        add((at >= 0) & (at + size <= length) & (shorter >= low) & (shorter <= high), at, size, shorter, i, edits, True)
    who = np.concatenate(who)
    return np.concatenate(key).view(np.int64), lids[who], sketch[who].view(np.int32), np.concatenate(probe)


def _entries(batches: Iterator[pd.DataFrame], least: int) -> Iterator[pd.DataFrame]:
    powers, seen = Powers(), set()
    for b in batches:
        lines, lids, size = [], [], 0

        def flush():
            k, lid, sketch, probe = keys(lines, np.array(lids, np.int64), powers)
            return pd.DataFrame({"key": k, "lid": lid, "mark": sketch.view(np.uint32).astype(np.int64) << 1 | probe})

        for text in b["text"]:
            for x in text.split("\n") if isinstance(text, str) else ():
                x = x.strip(" \t\n\x0b\f\r")
                if len(x) < least:
                    continue
                h = xxhash.xxh64_intdigest(x.encode("utf-8", "replace"), 42)
                if h in seen:  # a line that a partition repeats is entered once; others are told apart by the join
                    continue
                if len(seen) > 2_000_000:
                    seen.clear()
                seen.add(h)
                lines.append(x)
                lids.append(h - (1 << 64) if h >> 63 else h)
                size += len(x)
                if size >= CHUNK:
                    yield flush()
                    lines, lids, size = [], [], 0
        if lines:
            yield flush()


def _near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether sketches differ in no more bits than EDITS edits can change."""
    return np.bitwise_count(x ^ y) <= 2 * EDITS


def _starts(b: pd.DataFrame, names: list[str]) -> np.ndarray:
    """The first rows of the groups of a frame that is sorted by names."""
    new = np.zeros(len(b), bool)
    new[:1] = True
    for c in names:
        x = b[c].to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _groups(batches: Iterator[pd.DataFrame], names: list[str], most: int | None = None) -> Iterator[tuple[pd.DataFrame, bool]]:
    """Frames of whole groups of rows that are sorted by names, and True; rows of a group beyond most come as they are, with False."""
    held: list[pd.DataFrame] = []
    passing = False  # whether the held group is beyond the bound
    for b in batches:
        if not len(b):
            continue
        starts = _starts(b, names)
        if held and any(held[-1][c].iloc[-1] != b[c].iloc[0] for c in names):
            yield pd.concat(held, ignore_index=True), not passing
            held, passing = [], False
        if len(starts) > 1:
            head = b.iloc[: starts[1]]  # of the held group
            if held and passing:
                yield pd.concat([*held, head], ignore_index=True), False
                ready = b.iloc[starts[1] : starts[-1]]
            else:
                ready = pd.concat([*held, b.iloc[: starts[-1]]], ignore_index=True)
            if len(ready):
                yield ready, True
            held, passing, b = [], False, b.iloc[starts[-1] :]
        held.append(b)
        if most is not None and (passing or sum(map(len, held)) > most):
            passing = True
            while len(held) > 1 or len(held[0]) > 1:  # a row stays, to tell what group this is
                yield pd.concat([*held[:-1], held[-1].iloc[:-1]], ignore_index=True), False
                held = [held[-1].iloc[-1:]]
    if held:
        yield pd.concat(held, ignore_index=True), not passing


def _members(lid: np.ndarray, sketch: np.ndarray, role: np.ndarray) -> np.ndarray:
    """(lid, sketch, role) of those of one key's lines that another, in the other role, is near."""
    lid, at, of = np.unique(lid, return_index=True, return_inverse=True)
    if len(lid) < 2:
        return np.zeros((3, 0), np.int64)
    roles = np.zeros(len(lid), np.int64)
    np.bitwise_or.at(roles, of, role)
    kinds, kind = np.unique(sketch[at], return_inverse=True)  # lines with one sketch are compared as one
    of_kind, n = np.zeros(len(kinds), np.int64), np.bincount(kind)
    np.bitwise_or.at(of_kind, kind, roles)
    index, probes, near = np.flatnonzero(of_kind & 1), np.flatnonzero(of_kind & 2), np.zeros(len(kinds), bool)
    step = max(1, MANY // max(1, len(probes)))
    for lo in range(0, len(index), step):
        i = index[lo : lo + step]
        m = _near(kinds[i, None], kinds[None, probes]) & ((i[:, None] != probes[None, :]) | (n[i] > 1)[:, None])
        near[i] |= m.any(axis=1)
        near[probes[m.any(axis=0)]] = True
    fine = near[kind]
    return np.stack([lid[fine], sketch[at][fine].view(np.int32).astype(np.int64), roles[fine]])


CANDIDATE = "key long, lid long, sketch int, role int, whole boolean"


def _frame(key, rows: np.ndarray, whole: bool) -> pd.DataFrame:
    return pd.DataFrame({"key": key, "lid": rows[0], "sketch": rows[1].astype(np.int32), "role": rows[2].astype(np.int32), "whole": whole})


def _candidates(batches: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    """Of entries sorted by key the lines that have near ones under a key; all entries of a key with more than most."""
    for b, whole in _groups(batches, ["key"], most):
        key, lid, mark = b["key"].to_numpy(), b["lid"].to_numpy(), b["mark"].to_numpy()
        sketch, role = (mark >> 1).astype(np.uint32), 1 + (mark & 1)
        if not whole:
            yield _frame(key, np.stack([lid, sketch.view(np.int32).astype(np.int64), role]), False)
            continue
        first = _starts(b, ["key"])
        count = np.diff(np.append(first, len(key)))
        small = first[count == 2]  # most groups that hold anything
        fine = small[(role[small] != role[small + 1]) & (lid[small] != lid[small + 1]) & _near(sketch[small], sketch[small + 1])]
        both = np.concatenate([fine, fine + 1])
        keys_, out = [key[both]], [np.stack([lid[both], sketch[both].view(np.int32).astype(np.int64), role[both]])]
        for g, n in zip(first[count > 2], count[count > 2], strict=True):
            r = role[g : g + n]
            if r.min() != r.max():
                out.append(_members(lid[g : g + n], sketch[g : g + n], r))
                keys_.append(np.full(out[-1].shape[1], key[g]))
        yield _frame(np.concatenate(keys_), np.concatenate(out, axis=1), True)


def _blocked(rows: DataFrame, size: int, points: int = 1) -> DataFrame:
    """rows (key, lid, points, ...) with lo, hi and block: each two blocks of a key's rows meet under one (key, lo, hi)."""
    salt = F.pmod(F.xxhash64("lid"), F.lit(64)).cast("int")
    n = F.greatest(F.ceil(F.count(F.lit(1)) / size), F.ceil(F.sum("points") / points)).cast("int")
    many = rows.groupBy("key").agg(n.alias("_n")).where("_n > 1").withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(63))))
    r = rows.withColumn("_s", salt).join(many, ["key", "_s"], "left").withColumn("_n", F.coalesce("_n", F.lit(1)))
    r = r.withColumn("block", F.pmod(F.xxhash64("lid", F.lit(1)), F.col("_n")).cast("int")).withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return r.withColumns({"lo": F.least("block", "_o"), "hi": F.greatest("block", "_o")}).drop("_s", "_n", "_o", "points")


def _pairs(one: bool, first: np.ndarray, second: np.ndarray, role: np.ndarray, sketch: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of a row of first and one of second, one as index and one as probe, whose sketches are near; one: both are the same rows."""
    step, swapped = max(1, MANY // max(1, len(second))), (role >> 1) | ((role & 1) << 1)
    for at in range(0, len(first), step):
        i = first[at : at + step]
        m = _near(sketch[i, None], sketch[None, second]) & ((role[i, None] & swapped[None, second]) > 0)
        if one:
            m &= i[:, None] < second[None, :]
        x, y = np.nonzero(m)
        yield i[x], second[y]


def _big(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What _candidates does, for blocks of the keys with more than GATHER entries; a line may come from several."""
    for b, _ in _groups(batches, ["key", "lo", "hi"]):
        for g in np.split(np.arange(len(b)), _starts(b, ["key", "lo", "hi"])[1:]):
            lid, sketch, role = b["lid"].to_numpy()[g], b["sketch"].to_numpy()[g].view(np.uint32), b["role"].to_numpy()[g]
            out = _members(lid, sketch, role)
            yield _frame(np.full(out.shape[1], b["key"].iloc[g[0]]), out, True)


_NONE = np.iinfo(np.int64).min


def _table(who: np.ndarray, key: np.ndarray, n: int, empty: int) -> np.ndarray:
    """A row of keys per line, filled up with a value."""
    order = np.argsort(who, kind="stable")
    who, key = who[order], key[order]
    at = np.arange(len(who)) - np.searchsorted(who, who)
    out = np.full((n, int(at.max(initial=0)) + 1), empty, np.int64)
    out[who, at] = key
    return out


def alike(xs: list[str], ys: list[str]) -> np.ndarray:
    """Whether each pair of lines is within the edits that the shorter one allows."""
    fine = within(xs, ys, EDITS)
    some = np.array([i for i in np.flatnonzero(fine) if min(len(xs[i]), len(ys[i])) < FUZZY], np.int64)
    if len(some):
        fine[some] = within([xs[i] for i in some], [ys[i] for i in some], 1)
    return fine


def _linked(g: pd.DataFrame, powers: Powers) -> pd.DataFrame:
    """(a, b, k) of the rows with links in whole groups: b is the first of the lines that a hangs together with in its group, k its number of links.

    A pair counts under the least of the keys that it shares in unlike roles, so once among all keys.
    """
    lid, key, role, block, n = g["lid"].to_numpy(), g["key"].to_numpy(), g["role"].to_numpy(), g["block"].to_numpy(), len(g)
    _, at, line = np.unique(lid, return_index=True, return_inverse=True)
    xs = [g["x"].iloc[i] for i in at]
    entry, who, sketch, probe = keys(xs, np.arange(len(xs)), powers)
    index, probes = _table(who[~probe], entry[~probe], len(xs), _NONE), _table(who[probe], entry[probe], len(xs), _NONE + 1)
    of = np.zeros(len(xs), np.uint32)
    of[who] = sketch.view(np.uint32)
    of, top = of[line], np.iinfo(np.int64).max
    first = _starts(g, ["key", "lo", "hi"])
    size = np.diff(np.append(first, n))
    two = first[size == 2]
    two = two[_near(of[two], of[two + 1]) & ((role[two] | role[two + 1]) == 3)]
    found = [(two, two + 1)]
    for s, m in zip(first[size > 2], size[size > 2], strict=True):
        rows = np.arange(s, s + m)
        lo, hi = g["lo"].iloc[s], g["hi"].iloc[s]
        found += _pairs(lo == hi, rows[block[s : s + m] == lo], rows[block[s : s + m] == hi], role, of)
    i, j = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    fine = [np.zeros((2, 0), np.int64)]
    for at in range(0, len(i), MANY):
        a, b = i[at : at + MANY], j[at : at + MANY]
        least = np.full(len(a), top)
        for x, y in ((line[a], line[b]), (line[b], line[a])):
            for c in range(index.shape[1]):
                v = index[x, c]
                least = np.minimum(least, np.where((probes[y] == v[:, None]).any(axis=1), v, top))
        own = least == key[a]
        a, b = a[own], b[own]
        fine.append(np.stack([a, b])[:, alike([xs[k] for k in line[a]], [xs[k] for k in line[b]])])
    a, b = np.concatenate(fine, axis=1)
    k, label = np.bincount(a, minlength=n) + np.bincount(b, minlength=n), np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    some = np.flatnonzero(k)
    return pd.DataFrame({"a": lid[some], "b": lid[label[some]], "k": k[some].astype(np.int64)})


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names, powers = ["key", "lo", "hi"], Powers()
    for b, _ in _groups(batches, names):
        first = _starts(b, names)
        end = np.append(first[1:], len(b))
        points = np.cumsum(b["x"].str.len().to_numpy())
        at = 0
        while at < len(first):  # groups of about POINTS code points at a time
            to = max(at + 1, int(np.searchsorted(points[end - 1], points[first[at]] + POINTS)))
            yield _linked(b.iloc[first[at] : end[to - 1]], powers)
            at = to


def _distance(x: str, y: str) -> int:
    row = list(range(len(y) + 1))
    for i, c in enumerate(x):
        new = [i + 1]
        for j, d in enumerate(y):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (c != d)))
        row = new
    return row[-1]


def within(xs: list[str], ys: list[str], edits: int) -> np.ndarray:
    """Whether each pair of strings is within so many edits: bit-parallel along a band of 2 edits + 1 diagonals.

    One column of the band is a word; a step is a few word operations, here on all pairs at once. The distance is
    followed down the lower diagonal, then along the last row.
    """
    n = len(xs)
    la, lb = np.fromiter(map(len, xs), np.int64, n), np.fromiter(map(len, ys), np.int64, n)
    out = np.abs(la - lb) <= edits
    for i in np.flatnonzero(out & (np.minimum(la, lb) <= edits)):  # too short for a band
        out[i] = _distance(xs[i], ys[i]) <= edits
    todo = np.flatnonzero(out & (np.minimum(la, lb) > edits))
    todo = todo[np.argsort(lb[todo], kind="stable")]
    lo = 0
    while lo < len(todo):
        # many pairs at a time; of long lines, fewer
        wide = np.maximum(la[todo[lo : lo + 2048]], lb[todo[lo : lo + 2048]])
        some = todo[lo : lo + max(1, int((np.maximum.accumulate(wide) * np.arange(1, len(wide) + 1) <= POINTS).sum()))]
        lo += len(some)
        m, wide = len(some), int(max(la[some].max(), lb[some].max()))

        def table_(strings, pad):
            t = np.full((wide + 2 * edits + 2, m), pad, np.uint32)
            for k, i in enumerate(some):
                p = np.frombuffer(strings[i].encode("utf-32-le", "surrogatepass"), np.uint32)
                t[edits : edits + len(p), k] = p
            return t

        a, b = table_(xs, 0xFFFFFFFF), table_(ys, 0xFFFFFFFE)
        band = 2 * edits + 1
        one, mask = np.uint64(1), np.uint64((1 << band) - 1)
        top = np.uint64(1 << (band - 1))  # the lower diagonal
        vp, vn = np.full(m, mask & ~np.uint64((1 << edits) - 1), np.uint64), np.zeros(m, np.uint64)
        dist, row = np.full(m, edits, np.int64), np.full(m, band - 2, np.int64)
        rows, cols = la[some], lb[some]
        for i in range(int(cols.max())):
            match = np.zeros(m, np.uint64)
            for k in range(band):  # bit k is row i - edits + k; tables are shifted by edits
                match |= (a[i + k] == b[i + edits]).astype(np.uint64) << np.uint64(k)
            x = match
            d0 = ((((x & vp) + vp) ^ vp) | x | vn) & mask
            hp, hn = (vn | ~(d0 | vp)) & mask, d0 & vp
            on = i < cols
            down = on & (i < rows - edits)
            flat = on & ~down
            dist[down] += ((d0[down] & top) == 0).astype(np.int64)
            r = one << np.maximum(row, 0).astype(np.uint64)
            dist[flat] += ((hp[flat] & r[flat]) != 0).astype(np.int64) - ((hn[flat] & r[flat]) != 0).astype(np.int64)
            row[flat] -= 1
            s = d0 >> one
            vp, vn = (hn | ~(s | hp)) & mask, s & hp
        out[some] = dist <= edits
    return out


def different(lines: DataFrame) -> DataFrame:
    """(lid, n, f, l): each different line of lines_of(docs), how often it stands and its first and last place."""
    place = F.struct("doc_id", "row", "line")
    return lines.groupBy("lid").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("f"), F.max(place).alias("l"))


def links(docs: DataFrame, each: DataFrame, least: int = SHORT) -> DataFrame:
    """(a, b, k): lines, by lid, of least code points or more that are alike to others.

    A line may have several rows: its links are the sum of k, and the pairs a, b hang together what links do. each is
    different(lines_of(docs)). Lines of one text share a lid, so a frequent line is one line here.
    """
    entries = docs.select("text").mapInPandas(lambda batches: _entries(batches, least), "key long, lid long, mark long")
    gather = GATHER
    some = kept(entries.repartition("key").sortWithinPartitions("key").mapInPandas(lambda batches: _candidates(batches, gather), CANDIDATE))
    freed(docs.sparkSession)
    many = some.where("not whole").withColumn("points", F.lit(1))
    if many.take(1):
        order = ["key", "lo", "hi"]
        found = _blocked(many.drop("whole").groupBy("key", "lid", "sketch").agg(F.bit_or("role").alias("role"), F.first("points").alias("points")), GATHER)
        found = found.select("lid", "sketch", "role", *order).repartition(*order).sortWithinPartitions(*order).mapInPandas(_big, CANDIDATE)
        some = some.where("whole").unionByName(found.groupBy("key", "lid", "sketch").agg(F.max("role").alias("role"), F.lit(True).alias("whole")))
    # the texts of these lines: one place each, then the documents that hold them
    wanted = some.select("lid").distinct()
    place = each.select("lid", "f.row", "f.line").join(wanted, "lid", "left_semi")
    per = place.groupBy(F.col("row").alias("_row")).agg(F.collect_list(F.struct("lid", "line")).alias("w"))  # of one document
    d = docs.select(row_key().alias("row"), "text").join(per.hint("shuffle_hash"), F.col("row") == F.col("_row"))
    texts = d.select(F.split("text", "\n").alias("t"), F.explode("w").alias("w")).select(F.col("w.lid").alias("lid"), F.trim(F.get("t", F.col("w.line")), F.lit(" \t\n\x0b\f\r")).alias("x"))
    texts = kept(texts.where("x is not null and xxhash64(x) = lid").dropDuplicates(["lid"]))
    sized = some.select("key", "lid", "role").join(texts.select("lid", F.length("x").alias("points")), "lid")
    order = ["key", "lo", "hi"]
    dealt = _blocked(sized, BLOCK, POINTS).join(texts, "lid").select("lid", "role", "block", "x", *order)
    return kept(dealt.repartition(*order).sortWithinPartitions(*order).mapInPandas(_verify, "a long, b long, k long"))


def members(docs: DataFrame) -> DataFrame:
    """(row, m): for each document with lines whose class has others, their set of (line, class, gone, k).

    class is the least lid of the class, k the number of links that the line has to lines of other wording.
    """
    lines = kept(lines_of(docs))
    every = kept(different(lines))
    linked = links(docs, every)
    degree = linked.groupBy(F.col("a").alias("lid")).agg(F.sum("k").alias("k"))
    cls = connected_components(linked.select("a", "b")).withColumnRenamed("node", "lid").join(degree, "lid")
    each = every.join(cls, "lid", "left").where("f.row <> l.row or f.line <> l.line or component is not null")
    each = kept(each.select("lid", "n", "f", "component", F.coalesce("k", F.lit(0)).alias("k")))
    near = each.where("component is not null")
    first = near.groupBy("component").agg(F.count(F.lit(1)).alias("_m"), F.min("f").alias("_f"))
    near = split_join(near, first, "component", "_m", near.count()).select("lid", "n", F.col("_f").alias("f"), F.col("component").alias("class"), "k")
    info = kept(near.unionByName(each.where("component is null").select("lid", "n", "f", F.col("lid").alias("class"), "k")))
    own = split_join(lines.select("row", "line", "lid"), info, "lid", "n", lines.count())
    own = own.select("row", F.struct("line", "class", F.expr("not (row = f.row and line = f.line)").alias("gone"), "k").alias("m"))
    return own.groupBy("row").agg(F.collect_set("m").alias("m"))  # of one document


def line_dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, n_links, first_removed, last_removed, classes, removed) of each row of docs (doc_id, text).

    n_lines counts all lines of the text, n_removed those that go because an earlier line, by document id and place, is of
    their class, n_links the links of the document's lines to lines of other wording. classes has the (line, class) of each line whose class
    has other lines, in the order of lines, and removed the lines that go. A null text has no lines and an
    empty one a single line; empty lines always stay. Rows with the same
    id and text are one document; rows with the same id and other texts, or with null ids, are documents of their own.
    Null ids come before all others, and documents of one id in the order of a hash of id and text.
    """
    base = docs.select(F.col("doc_id").cast("long"), row_key().alias("row"), F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("_n"))
    m = F.array_sort(F.coalesce("m", F.array().cast("array<struct<line:int,class:bigint,gone:boolean,k:bigint>>")))
    out = base.join(members(docs), "row", "left").withColumn("n_lines", F.greatest(F.col("_n"), F.lit(0))).withColumn("_m", m)
    out = out.withColumn("removed", F.transform(F.filter("_m", lambda x: x["gone"]), lambda x: x["line"]))
    n_links = F.aggregate("_m", F.lit(0).cast("long"), lambda s, x: s + x["k"]).alias("n_links")
    classes = F.transform("_m", lambda x: F.struct(x["line"].alias("line"), x["class"].alias("class"))).alias("classes")
    return out.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), n_links, F.array_min("removed").alias("first_removed"), F.array_max("removed").alias("last_removed"), classes, "removed")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without the lines that go; a document all of whose lines go stays with an empty text.

    Null texts stay null, and empty ones empty. Rows with one id and text lose the same lines; rows with the same id, or
    null ids, and other texts are documents of their own. Columns beside doc_id and text stay as they are, but for
    n_chars, which is that of the new text. An empty table gives an empty one.
    """
    freed(spark)  # what earlier stages have left
    gone = F.transform(F.filter("m", lambda x: x["gone"]), lambda x: x["line"])
    per = members(docs).select(F.col("row").alias("_row"), gone.alias("_gone")).where(F.size("_gone") > 0)
    t = docs.join(per.hint("shuffle_hash"), row_key() == F.col("_row"), "left")
    rest = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("_gone", i)), "\n")
    cut = F.col("_gone").isNotNull() & F.col("text").isNotNull()
    t = t.withColumn("text", F.when(cut, rest).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        t = t.withColumn("n_chars", F.when(cut, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return t.select(*docs.columns)
