"""Substring deduplication with a log-structured fingerprint index.

A window is ``WINDOW`` consecutive words of one document.  Of the hashes of its
6-word runs, a window's fingerprint is the smallest (winnowing), so equal
windows have equal fingerprints and neighbours mostly share one.

* ``ingest`` turns a batch into an immutable run: for each block of documents
  and each range of hashes (bucket), the sorted distinct fingerprints, and
  whether two documents of the block have them.
* ``shared`` merge-joins the sorted runs, bucket by bucket: fingerprints that
  two documents have go back to the blocks that hold them.
* ``resolve`` verifies: for windows with a shared fingerprint, 96 bits of
  independent hashes of the whole window meet the smallest doc_id that has
  them, and the words that a window of a smaller document covers go.
* ``compact`` merges the runs of each bucket into one.

These need the texts of all documents at once.  ``WindowIndex`` takes batches that come one
after another: its runs hold each window's 96 bits and smallest doc_id, so that
``append`` verifies a batch against history without history's texts, at about 20
bytes a word on disk.

A block holds all rows of the documents whose hash of doc_id falls to it, about
``BLOCK_BYTES`` of text; one document is never split.  What
moves is a block's distinct hashes, so one text copied into very many
documents costs one entry a block.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, release, remove, stored
from .hashing import batches, mixed, spans_hash, words_hash, words_of

WINDOW, RUN = 13, 6

#: Bytes of text that make a block and a bucket: what a task holds of either.
BLOCK_BYTES, BUCKET_BYTES = 8 << 20, 16 << 20

#: Characters of a block that are hashed at once: each takes some 150 bytes in arrays meanwhile.
BATCH_CHARS = 1 << 18

_RUN_SCHEMA = "bucket int, block int, hashes binary, several binary"


def _fingerprints(texts: list[str | None]):
    """(first word of each text, hashes of the words, fingerprint of each window start, windows) of a batch.

    The last array holds the word numbers at which a window starts."""
    data, start, end, first = words_of(texts)
    word = words_hash(data, start, end)
    n = len(word)
    if n < WINDOW:
        return first, word, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.arange(n - RUN + 1)
    run = spans_hash(word, at, at + RUN)
    each = WINDOW - RUN + 1
    low = run[: len(run) - each + 1].copy()
    for k in range(1, each):
        np.minimum(low, run[k : len(run) - each + 1 + k], out=low)
    doc = np.searchsorted(first, np.arange(n), side="right") - 1
    starts = np.flatnonzero(doc[: n - WINDOW + 1] == doc[WINDOW - 1 :])
    return first, word, low[starts], starts


def _window_hashes(word: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return spans_hash(word, starts, starts + WINDOW, 1), (spans_hash(mixed(word), starts, starts + WINDOW, 2) >> np.uint64(32)).astype(np.uint32)


def _owners(first: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.searchsorted(first, starts, side="right") - 1


def _split(buckets: int, hashes: np.ndarray) -> np.ndarray:
    """Bounds of the buckets in sorted hashes."""
    edges = ((np.arange(buckets + 1, dtype=object) * (1 << 64)) // buckets)[1:-1].astype(np.uint64)
    return np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])


def _ingest(buckets: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        texts, ids = pdf["text"].tolist(), pdf["doc_id"].to_numpy()
        found, owner = [], []
        for a, b in batches(texts, BATCH_CHARS):
            first, _, low, starts = _fingerprints(texts[a:b])
            of = _owners(first, starts)
            keep = np.ones(len(low), bool)
            keep[1:] = (low[1:] != low[:-1]) | (of[1:] != of[:-1])
            found.append(low[keep])
            owner.append(ids[a + of[keep]])
        h, d = np.concatenate(found), np.concatenate(owner)
        if not len(h):
            return pd.DataFrame({"bucket": [], "block": [], "hashes": [], "several": []})
        order = np.argsort(h, kind="stable")
        h, d = h[order], d[order]
        new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        several = np.minimum.reduceat(d, new) != np.maximum.reduceat(d, new)
        h = h[new]
        at = _split(buckets, h)
        rows = [(k, h[at[k] : at[k + 1]].tobytes(), np.packbits(several[at[k] : at[k + 1]]).tobytes()) for k in range(buckets) if at[k + 1] > at[k]]
        return pd.DataFrame({"bucket": [r[0] for r in rows], "block": int(pdf["block"].iat[0]), "hashes": [r[1] for r in rows], "several": [r[2] for r in rows]})
    return run


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket's sorted runs: per block, its hashes that two documents have."""
    lists = [np.frombuffer(x, np.uint64) for x in pdf["hashes"]]
    flags = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(h)).astype(bool) for x, h in zip(pdf["several"], lists, strict=True)]
    every = np.concatenate(lists)
    order = np.sort(every, kind="stable")
    twice = order[1:][order[1:] == order[:-1]]
    common = np.unique(np.concatenate([twice, *[h[f] for h, f in zip(lists, flags, strict=True)]]))
    out, blocks = [], []
    for block, h in zip(pdf["block"], lists, strict=True):
        at = np.searchsorted(common, h)
        hit = h[common[np.minimum(at, max(len(common) - 1, 0))] == h] if len(common) else h[:0]
        if len(hit):
            out.append(hit.tobytes())
            blocks.append(block)
    return pd.DataFrame({"block": blocks, "hashes": out})


def _compacted(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row a block: its lists of several runs as one sorted list."""
    out = []
    for block, part in pdf.groupby("block", sort=True):
        h = np.concatenate([np.frombuffer(x, np.uint64) for x in part["hashes"]])
        f = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(y) // 8) for x, y in zip(part["several"], part["hashes"], strict=True)]).astype(bool)
        order = np.argsort(h, kind="stable")
        h, f = h[order], f[order]
        new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        # A hash in two runs of a block is in two documents.
        many = np.logical_or.reduceat(f, new) | (np.diff(np.concatenate([new, [len(h)]])) > 1)
        out.append((int(pdf["bucket"].iat[0]), block, h[new].tobytes(), np.packbits(many).tobytes()))
    return pd.DataFrame(out, columns=["bucket", "block", "hashes", "several"])


def _contains(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


def _candidates(docs: pd.DataFrame, shared: pd.DataFrame | None):
    """Per window of a block with a shared fingerprint (None: every window): both hashes and the doc_id."""
    common = None if shared is None else np.sort(np.concatenate([np.frombuffer(x, np.uint64) for x in shared["hashes"]])) if len(shared) else np.zeros(0, np.uint64)
    texts, ids = docs["text"].tolist(), docs["doc_id"].to_numpy()
    out = []
    for a, b in batches(texts, BATCH_CHARS):
        first, word, low, starts = _fingerprints(texts[a:b])
        if common is not None:
            starts = starts[_contains(common, low)]
        h1, h2 = _window_hashes(word, starts)
        out.append(np.rec.fromarrays([h1, h2, ids[a + _owners(first, starts)].astype(np.int64)], names="h,g,d"))
    return np.concatenate(out) if out else np.rec.fromarrays([np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64)], names="h,g,d")


def _least(h: np.ndarray, g: np.ndarray, d: np.ndarray):
    """Distinct (h, g) sorted, each with its smallest d."""
    order = np.lexsort((d, g, h))
    h, g, d = h[order], g[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
    return h[new], g[new], d[new]


def _windows(buckets: int):
    def run(docs: pd.DataFrame, shared: pd.DataFrame | None) -> pd.DataFrame:
        empty = pd.DataFrame({"bucket": [], "block": [], "h": [], "g": [], "d": []})
        if not len(docs) or shared is not None and not len(shared):
            return empty
        found = _candidates(docs, shared)
        if not len(found):
            return empty
        h, g, d = _least(found["h"], found["g"], found["d"])
        at = _split(buckets, h)
        rows = [(k, h[at[k] : at[k + 1]].tobytes(), g[at[k] : at[k + 1]].tobytes(), d[at[k] : at[k + 1]].tobytes()) for k in range(buckets) if at[k + 1] > at[k]]
        return pd.DataFrame({"bucket": [r[0] for r in rows], "block": int(docs["block"].iat[0]), "h": [r[1] for r in rows], "g": [r[2] for r in rows], "d": [r[3] for r in rows]})
    return run


def _first_holders(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket's windows: per block, those that a smaller document of another block has."""
    lists = [(np.frombuffer(h, np.uint64), np.frombuffer(g, np.uint32), np.frombuffer(d, np.int64)) for h, g, d in zip(pdf["h"], pdf["g"], pdf["d"], strict=True)]
    h, g, d = (np.concatenate([x[i] for x in lists]) for i in range(3))
    block = np.repeat(pdf["block"].to_numpy(), [len(x[0]) for x in lists])
    order = np.lexsort((d, g, h))
    h, g, d, block = h[order], g[order], d[order], block[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
    low = d[np.flatnonzero(new)[np.cumsum(new) - 1]]
    late = np.flatnonzero(low < d)
    late = late[np.argsort(block[late], kind="stable")]
    blocks, at = np.unique(block[late], return_index=True)
    parts = np.split(late, at[1:]) if len(blocks) else []
    return pd.DataFrame({"block": blocks.astype(np.int32), "h": [h[p].tobytes() for p in parts], "g": [g[p].tobytes() for p in parts], "d": [low[p].tobytes() for p in parts]})


def _resolved(docs: pd.DataFrame, known: pd.DataFrame, every: bool = False) -> pd.DataFrame:
    """doc_id, n_words, n_removed, kept text of a block; ``known`` has its windows' smallest holders elsewhere, and (unless ``every``) fingerprints."""
    texts, ids = docs["text"].tolist(), docs["doc_id"].to_numpy()
    # "shared" rows carry fingerprints in h and nothing else.
    shared, early = known[known["g"].isna()], known[known["g"].notna()]
    found = _candidates(docs, None if every else pd.DataFrame({"hashes": shared["h"].tolist()}))
    parts = [(found["h"], found["g"], found["d"])] + [(np.frombuffer(h, np.uint64), np.frombuffer(g, np.uint32), np.frombuffer(d, np.int64)) for h, g, d in zip(early["h"], early["g"], early["d"], strict=True)]
    kh, kg, kd = _least(*(np.concatenate([p[i] for p in parts]) for i in range(3)))
    n_words, n_removed, kept = [], [], []
    for a, b in batches(texts, BATCH_CHARS):
        data, start, end, first = words_of(texts[a:b])
        gone = np.zeros(len(start) + 1, np.int32)
        if len(kh) and len(start) >= WINDOW:
            word = words_hash(data, start, end)
            doc = _owners(first, np.arange(len(word)))
            starts = np.flatnonzero(doc[: len(word) - WINDOW + 1] == doc[WINDOW - 1 :])
            h1 = spans_hash(word, starts, starts + WINDOW, 1)
            hit = _contains(kh, h1)
            starts, h1 = starts[hit], h1[hit]
            h2 = (spans_hash(mixed(word), starts, starts + WINDOW, 2) >> np.uint64(32)).astype(np.uint32)
            at = np.searchsorted(kh, h1)
            same = np.zeros(len(at), bool)
            low = np.zeros(len(at), np.int64)
            # Windows of equal first hash stand side by side; almost always there is one.
            for step in range(int(np.diff(np.flatnonzero(np.concatenate([[True], kh[1:] != kh[:-1], [True]]))).max())):
                x = np.minimum(at + step, len(kh) - 1)
                ok = (kh[x] == h1) & (kg[x] == h2)
                same |= ok
                low[ok] = kd[x[ok]]
            cut = starts[same & (low < ids[a + _owners(first, starts)])] if len(starts) else starts
            np.add.at(gone, cut, 1)
            np.add.at(gone, cut + WINDOW, -1) if len(cut) else None
        covered = np.cumsum(gone[:-1]) > 0
        raw = data.tobytes()
        for k in range(b - a):
            w = slice(first[k], first[k + 1])
            n_words.append(int(first[k + 1] - first[k]))
            stay = ~covered[w]
            n_removed.append(int(n_words[-1] - stay.sum()))
            s, e = start[w][stay], end[w][stay]
            kept.append(b" ".join([raw[x:y] for x, y in zip(s.tolist(), e.tolist(), strict=True)]))
    return pd.DataFrame({"doc_id": docs["doc_id"].to_numpy(), "n_words": n_words, "n_removed": n_removed, "kept": kept})


class FingerprintIndex:
    """Runs of fingerprints under ``path`` (a folder that driver and executors share)."""

    def __init__(self, spark: SparkSession, blocks: int, path: str | None = None, buckets: int = 16):
        self.spark, self.blocks, self.buckets = spark, max(1, blocks), buckets
        self.path, self.runs = path or new_path(spark, "fingerprints"), []

    def blocked(self, docs: DataFrame) -> DataFrame:
        """(block, doc_id, text); rows without a doc_id take no part."""
        rows = docs.select("doc_id", "text").where("doc_id is not null")
        return rows.select(F.expr(f"cast(pmod(xxhash64(doc_id), {self.blocks}) as int)").alias("block"), "doc_id", "text")

    def ingest(self, docs: DataFrame) -> None:
        run = f"{self.path}/run-{len(self.runs):05d}"
        self.blocked(docs).groupBy("block").applyInPandas(_ingest(self.buckets), _RUN_SCHEMA).write.parquet(run)
        self.runs.append(run)
        release(self.spark)

    def entries(self) -> DataFrame:
        return self.spark.read.schema(_RUN_SCHEMA).parquet(*self.runs)

    def compact(self) -> None:
        """Replace all runs by one that holds the same."""
        if len(self.runs) > 1:
            run = f"{self.path}/merged-{len(self.runs):05d}"
            self.entries().groupBy("bucket").applyInPandas(_compacted, _RUN_SCHEMA).write.parquet(run)
            old, self.runs = self.runs, [run]
            remove(self.spark, *old)
            release(self.spark)

    def shared(self) -> DataFrame:
        """(block, hashes): the fingerprints of a block that two documents of the index have."""
        return self.entries().groupBy("bucket").applyInPandas(_merge, "block int, hashes binary")

    def resolve(self, docs: DataFrame) -> DataFrame:
        """(doc_id, n_words, n_removed, kept binary) for ``docs``, all documents that were ingested."""
        path = new_path(self.spark, "shared")
        self.shared().write.parquet(path)
        release(self.spark)
        shared = self.spark.read.schema("block int, hashes binary").parquet(path)
        rows = self.blocked(docs)
        windows = rows.groupBy("block").cogroup(shared.groupBy("block")).applyInPandas(_windows(self.buckets), "bucket int, block int, h binary, g binary, d binary")
        early = windows.groupBy("bucket").applyInPandas(_first_holders, "block int, h binary, g binary, d binary")
        known = early.unionByName(shared.select("block", F.col("hashes").alias("h"), F.lit(None).cast("binary").alias("g"), F.lit(None).cast("binary").alias("d")))
        return rows.groupBy("block").cogroup(known.groupBy("block")).applyInPandas(lambda d, k: _resolved(d, k) if len(d) else pd.DataFrame({"doc_id": [], "n_words": [], "n_removed": [], "kept": []}), "doc_id long, n_words long, n_removed long, kept binary")

    def drop(self) -> None:
        remove(self.spark, *self.runs)
        self.runs = []


_WINDOWS_SCHEMA = "bucket int, block int, h binary, g binary, d binary"

#: Block of the rows of history, which have no texts.
_HISTORY = -1


def _merged_windows(pdf: pd.DataFrame) -> pd.DataFrame:
    """One bucket's runs as one, each window with its smallest doc_id."""
    h, g, d = _least(*(np.concatenate([np.frombuffer(x, t) for x in pdf[c]]) for c, t in (("h", np.uint64), ("g", np.uint32), ("d", np.int64))))
    return pd.DataFrame({"bucket": [int(pdf["bucket"].iat[0])], "block": [_HISTORY], "h": [h.tobytes()], "g": [g.tobytes()], "d": [d.tobytes()]})


class WindowIndex(FingerprintIndex):
    """Runs of window hashes under ``path``: batches are resolved against history as they come."""

    def append(self, docs: DataFrame) -> DataFrame:
        """(doc_id, n_words, n_removed, kept binary) for the batch ``docs``; its windows become a run.

        A word goes if a window that covers it also starts in a document of this
        or an earlier batch with a smaller doc_id.  Results of earlier batches stay as
        they are, so batches whose ids grow get what all documents at once would give.
        """
        rows, windows = self.blocked(docs), _windows(self.buckets)
        run = f"{self.path}/windows-{len(self.runs):05d}-{uuid.uuid4().hex}"
        rows.groupBy("block").applyInPandas(lambda d: windows(d, None), _WINDOWS_SCHEMA).write.parquet(run)
        read = self.spark.read.schema(_WINDOWS_SCHEMA)
        new, old = read.parquet(run), self.runs
        both = new.unionByName(read.parquet(*old).withColumn("block", F.lit(_HISTORY))) if old else new
        early = both.groupBy("bucket").applyInPandas(_first_holders, "block int, h binary, g binary, d binary").where(F.col("block") != _HISTORY)
        out = stored(rows.groupBy("block").cogroup(early.groupBy("block")).applyInPandas(lambda d, k: _resolved(d, k, True) if len(d) else pd.DataFrame({"doc_id": [], "n_words": [], "n_removed": [], "kept": []}), "doc_id long, n_words long, n_removed long, kept binary"), "resolved")
        self.runs = [*old, run]
        release(self.spark)
        return out

    def compact(self) -> None:
        if len(self.runs) > 1:
            run = f"{self.path}/merged-{uuid.uuid4().hex}"
            self.spark.read.schema(_WINDOWS_SCHEMA).parquet(*self.runs).groupBy("bucket").applyInPandas(_merged_windows, _WINDOWS_SCHEMA).write.parquet(run)
            old, self.runs = self.runs, [run]
            remove(self.spark, *old)
            release(self.spark)


def _unshared(batch_iter):
    """doc_id, n_words, n_removed, kept of rows from which nothing goes."""
    for pdf in batch_iter:
        words = [[w for w in re.split(rb"[\x20\x09-\x0D]+", (t or "").encode("utf-8", "surrogatepass")) if w] for t in pdf["text"]]
        yield pd.DataFrame({"doc_id": pd.array([None] * len(pdf), "Int64"), "n_words": [len(w) for w in words], "n_removed": 0, "kept": [b" ".join(w) for w in words]})


def dedup_substrings(docs: DataFrame, runs: int = 2, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed (long), kept (binary: UTF-8 of the words kept, joined by one space).

    Words are ``[^\\x20\\x09-\\x0D]+``; a null text has none.  A word goes if a window that
    covers it also starts in a document with a smaller doc_id; a document never
    removes its own repeats, and rows with equal doc_ids don't remove one
    another's words.  ``docs`` is ingested in ``runs`` batches, by halves of the blocks
    and so on, as batches that come one after another would be; the result doesn't
    depend on their number.  A null doc_id is neither smaller nor larger than
    another: such a row keeps its words and removes none.  A very long text is
    worked on whole, in a task that holds it.  No other columns are read.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    index = FingerprintIndex(spark, max(16, -(-size // block_bytes)), buckets=max(16, -(-size // bucket_bytes)))
    for k in range(runs):
        index.ingest(docs.where(F.expr(f"pmod(xxhash64(doc_id), {index.blocks}) % {runs} = {k}")))
    index.compact()
    lone = docs.where("doc_id is null").select("text").mapInPandas(_unshared, "doc_id long, n_words long, n_removed long, kept binary")
    return index.resolve(docs).unionByName(lone)


def kept_digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def sha256_of(words: list[bytes]) -> str:
    """What kept_digest gives for these words; for tests and checks."""
    return hashlib.sha256(b" ".join(words)).hexdigest()
