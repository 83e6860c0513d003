"""SimHash near-dedup with a hierarchical index in Gray order.

Two fingerprints within ``distance`` bits agree in one of ``distance + 1`` parts
of their bits.  Each distinct fingerprint therefore goes to that many parts, and
only those that share a part's bits with another one go on: the copies grow with
the input and not with the number of pages.  Where more than a page of
fingerprints share a part, the bits that are left are cut in as many parts
again, ``LEVELS`` times at most, after which so few bits are free that a page is
bounded.

A page is sorted by part and Gray rank, so that neighbours differ in few bits.
A node holds the bits on which all its fingerprints agree (mask and pattern); an
upper node holds what its children share, and the children keep only the bits
they add.  A search carries the differences so far down the tree and drops a
whole group once they exceed the limit; what is left is compared exactly.
Links leave a page as one row per linked fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scan_tasks, stored
from .graph import components
from .hashing import batches, words_of

DISTANCE, SHINGLE, SEED = 2, 3, 42
PAGE, GROUP = 8192, 32

#: Times that the bits are cut in parts: for distance 2, 64 bits leave 43, 29 and 20 free.
LEVELS = 3

#: Links that a page holds before they are cut down to a spanning forest.
HELD_LINKS = 4_000_000

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprints(texts: list[str | None], shingle: int = SHINGLE) -> np.ndarray:
    """64-bit fingerprints; A-Z is lower-cased, words are ``[^\\x20\\x09-\\x0D]+``."""
    out = np.zeros(len(texts), np.uint64)
    for a, b in batches(texts, 1 << 18):
        data, start, end, first = words_of(texts[a:b])
        # One space after each word: a shingle is then a slice of the packed bytes.
        to = np.cumsum(end - start + 1)
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        keep = ~blank
        keep[end] = True
        packed = np.where(blank, np.uint8(32), data)[keep].tobytes().translate(_LOWER)
        s = np.concatenate([[0], to[:-1]]).astype(np.int64) if len(to) else to
        e = to - 1
        h, n_of = [], []
        digest = xxhash.xxh64_intdigest
        for k in range(b - a):
            lo, hi = first[k], first[k + 1]
            n = hi - lo
            if n == 0:
                n_of.append(0)
                continue
            last = max(lo + 1, hi - shingle + 1)
            ss, ee = s[lo:last], e[np.minimum(np.arange(lo, last) + shingle - 1, hi - 1)]
            h += [digest(packed[x:y], SEED) for x, y in zip(ss.tolist(), ee.tolist(), strict=True)]
            n_of.append(int(last - lo))
        count = np.asarray(n_of)
        some = np.flatnonzero(count)
        if not len(some):
            continue
        bits = np.unpackbits(np.asarray(h, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        sums = np.add.reduceat(bits, np.concatenate([[0], np.cumsum(count[some])[:-1]]), axis=0, dtype=np.int64)
        ones = sums * 2 > count[some][:, None]
        out[a + some] = np.packbits(ones, axis=1).copy().view(">u8").ravel().astype(np.uint64)
    return out


def _fingerprinted(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batch_iter:
        fp = fingerprints(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """The place of a code in reflected Gray order, as an unsigned number."""
    x = fp.copy()
    for k in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(k)
    return x


def _node(values: np.ndarray) -> tuple[np.uint64, np.uint64]:
    both, any_ = np.bitwise_and.reduce(values), np.bitwise_or.reduce(values)
    return ~(both ^ any_), both


class GrayTree:
    """Nodes over groups of fingerprints: per level the mask of bits that a node adds to its parent's, and their pattern."""

    def __init__(self, masks: np.ndarray, patterns: np.ndarray, fan: int = 4):
        levels = [(masks, patterns & masks)]
        while len(levels[-1][0]) > 1:
            m, p = levels[-1]
            cut = np.arange(0, len(m), fan)
            same = np.bitwise_and.reduceat(p, cut), np.bitwise_or.reduceat(p, cut)
            shared = np.bitwise_and.reduceat(m, cut) & ~(same[0] ^ same[1])
            levels.append((shared, same[0] & shared))
        self.fan = fan
        self.levels = []
        for k, (m, p) in enumerate(levels):
            own = m if k + 1 == len(levels) else m & ~np.repeat(levels[k + 1][0], fan)[: len(m)]
            self.levels.append((own, p & own))

    def search(self, fp: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """(index into fp, leaf) for the leaves that the accumulated differences don't rule out."""
        m, p = self.levels[-1]
        i = np.repeat(np.arange(len(fp)), len(m))
        node = np.tile(np.arange(len(m)), len(fp))
        diff = np.bitwise_count((fp[i] ^ p[node]) & m[node])
        ok = diff <= limit
        i, node, diff = i[ok], node[ok], diff[ok]
        for m, p in reversed(self.levels[:-1]):
            child = (node[:, None] * self.fan + np.arange(self.fan)).ravel()
            i, diff = np.repeat(i, self.fan), np.repeat(diff, self.fan)
            real = child < len(m)
            i, diff, node = i[real], diff[real], child[real]
            diff = diff + np.bitwise_count((fp[i] ^ p[node]) & m[node])
            ok = diff <= limit
            i, node, diff = i[ok], node[ok], diff[ok]
        return i, node


def _smallest_linked(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For vertices 0..n-1 the smallest vertex that the links (i, j) reach."""
    low = np.arange(n)
    while True:
        before = low.copy()
        np.minimum.at(low, i, before[j])
        np.minimum.at(low, j, before[i])
        low = low[low]
        if (low == before).all():
            return low


def _page_links(distance: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        fp, part, key = (pdf[c].to_numpy() for c in ("fp", "part", "key"))
        fp = fp.view(np.uint64)
        order = np.lexsort((gray_rank(fp), key, part))
        fp = fp[order]
        cut = np.arange(0, len(fp), GROUP)
        both, any_ = np.bitwise_and.reduceat(fp, cut), np.bitwise_or.reduceat(fp, cut)
        tree = GrayTree(~(both ^ any_), both)
        at_i, at_j = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for lo in range(0, len(fp), 1024):
            i, leaf = tree.search(fp[lo : lo + 1024], distance)
            at = leaf[:, None] * GROUP + np.arange(GROUP)
            i = np.broadcast_to(i[:, None] + lo, at.shape)
            # Each pair once, from its later end.
            real = at < i
            i, at = i[real], at[real]
            ok = np.bitwise_count(fp[i] ^ fp[at]) <= distance
            at_i, at_j = np.concatenate([at_i, i[ok]]), np.concatenate([at_j, at[ok]])
            if len(at_i) > HELD_LINKS:
                low = _smallest_linked(len(fp), at_i, at_j)
                at_i = np.flatnonzero(low != np.arange(len(fp)))
                at_j = low[at_i]
        low = _smallest_linked(len(fp), at_i, at_j)
        linked = np.flatnonzero(fp != fp[low])  # a fingerprint may stand in several parts of a page
        signed = fp.view(np.int64)
        return pd.DataFrame({"a": signed[linked], "b": signed[low[linked]]})
    return run


def part_masks(parts: int, level: int) -> list[int]:
    """Masks of the bits that agree after ``level`` cuts, each cut dealing the free bits to ``parts`` runs."""
    masks = [0]
    for _ in range(level):
        finer = []
        for mask in masks:
            free = [k for k in range(64) if not mask >> k & 1]
            edges = [len(free) * p // parts for p in range(parts + 1)]
            finer += [mask | sum(1 << k for k in free[x:y]) for x, y in zip(edges, edges[1:], strict=False)]
        masks = finer
    return masks


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def fingerprint_links(fps: DataFrame, distance: int = DISTANCE, page: int = PAGE, levels: int = LEVELS) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints ``fp`` (long) within ``distance`` bits of one another."""
    parts = distance + 1
    rows = fps.select("fp", F.lit(0).alias("part"))
    found: list[DataFrame] = []
    for level in range(1, levels + 1):
        masks = F.array(*[F.lit(_signed(m)) for m in part_masks(parts, level)])
        # Part p of a level is cut into the parts p * parts, p * parts + 1, ... of the next.
        cut = rows.select("fp", F.explode(F.sequence(F.col("part") * parts, F.col("part") * parts + parts - 1)).alias("part"))
        keyed = cut.select("fp", "part", F.col("fp").bitwiseAND(F.get(masks, "part")).alias("key"))
        shared = keyed.groupBy("part", "key").agg(F.count("*").alias("n")).where("n > 1")
        met = stored(keyed.join(shared, ["part", "key"]), "parts")
        tame = met if level == levels else met.where(F.col("n") <= page)
        pages = scan_tasks(tame, page)
        dealt = tame.withColumn("page", F.expr(f"pmod(xxhash64(part, key), {pages})"))
        found.append(dealt.groupBy("page").applyInPandas(_page_links(distance), "a long, b long"))
        rows = met.where(F.col("n") > page).select("fp", "part")
        if level == levels or rows.isEmpty():
            break
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def simhash_groups(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``; fingerprint is a long.

    Fingerprints link at ``distance`` or fewer differing bits; component_id is the
    smallest doc_id reachable.  A null or empty text has fingerprint zero, which
    links like any other.  Repeated rows give repeated rows; a null doc_id gets
    the component of its fingerprint but is never its smallest.
    """
    marked = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_fingerprinted, "doc_id long, fp long"), "fingerprints")
    per_fp = _rooted(marked, distance).select("fp", "component_id")
    return marked.join(per_fp, "fp").select("doc_id", F.col("fp").alias("fingerprint"), "component_id")


def _rooted(marked: DataFrame, distance: int) -> DataFrame:
    """(fp, root, component_id) per distinct fingerprint of ``marked`` (doc_id, fp); the root is a fingerprint of the component."""
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    joined = components(fingerprint_links(distinct, distance)).withColumnRenamed("id", "fp")
    rooted = distinct.join(joined, "fp", "left").select("fp", "low", F.coalesce("component_id", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return rooted.join(smallest, "root").select("fp", "root", "component_id")


def hexed(groups: DataFrame) -> DataFrame:
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def _keyed(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batch_iter:
        fp = fingerprints(batch.column("text").to_pylist())
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(fp.view(np.int64))], [*names, "fp"])


def dedup_simhash(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """One row of ``docs`` for each group: of those with the smallest doc_id the one with the smallest hash of all columns.

    A row with a null doc_id stays only if no row of its group has an id.  Rows
    of other groups stay whatever their doc_id.  Columns pass through unchanged.
    """
    # Map columns have no hash; their JSON stands for them.
    key = F.struct(*[F.col(c) for c in docs.columns])
    digest = F.sha2(F.to_json(key, {"ignoreNullFields": "false"}), 256)
    placed = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").cast("long").alias("doc_id"), digest.alias("digest"))
    # A written table: the rows' place in it tells equal rows apart.
    held = stored(docs.withColumn("__place", placed).withColumn("__row", F.monotonically_increasing_id()), "rows")
    thin = held.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("__row").alias("row"), F.col("__place.unnamed").alias("unnamed"), F.col("__place.digest").alias("digest"))
    marked = stored(thin.mapInArrow(_keyed, "doc_id long, row long, unnamed boolean, digest string, fp long"), "fingerprints")
    rooted = _rooted(marked, distance).select("fp", "root")
    first = marked.join(rooted, "fp").groupBy("root").agg(F.min(F.struct("unnamed", "doc_id", "digest", "row")).alias("first"))
    return held.join(first.select(F.col("first.row").alias("__row")), "__row", "left_semi").select(*docs.columns)
