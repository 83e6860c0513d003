"""Line, substring, SimHash and embedding deduplication against brute force."""

import hashlib
import random
import re
import tracemalloc

import numpy as np
import pandas as pd
import xxhash

from statuta.llm.embedding_dedup import near_vectors
from statuta.llm.graph import components
from statuta.llm.hashing import _powers, _residues
from statuta.llm import graph, line_dedup
from statuta.llm.line_dedup import BANDS, ROWS, WIDTH, _band_keys, dedup_lines, line_links
from statuta.llm.simhash import GrayTree, dedup_simhash, fingerprint_links, fingerprints, gray_rank, hexed, part_masks, simhash_groups
from statuta.llm.substring_dedup import WindowIndex, _ingest, dedup_substrings, kept_digest

SCHEMA = "doc_id long, text string, n_removed string, source string"
SYLLABLES = "ka lo mi tu re so vi na pe do ga hu".split()


def sentence(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n))


def closed(ids, links):
    """Smallest id reachable, by brute force."""
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


def test_components_of_chain_star_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (None, 3)]
    got = {r.id: r.component_id for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(line, width=8):
    u = line.encode("utf-16-be")
    return {u[2 * i : 2 * i + 2 * width] for i in range(max(1, len(u) // 2 - width + 1))}


def brute_lines(rows, threshold=0.8):
    lines = sorted({x for _, t in rows if t for x in t.split("\n") if x.strip(" ")})
    sets = [shingles(x) for x in lines]
    links = [(i, j) for i in range(len(lines)) for j in range(i) if len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])]
    root = closed(range(len(lines)), links)
    of = {x: root[i] for i, x in enumerate(lines)}
    seen, out = set(), {}
    for doc, text in sorted(rows):
        kept = []
        for x in text.split("\n"):
            if not x.strip(" "):
                kept.append(x)
            elif of[x] not in seen:
                seen.add(of[x])
                kept.append(x)
        out[doc] = "\n".join(kept)
    return out


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(4)
    # One edit a line leaves near copies of a long line well above the threshold, so that banding finds all.
    base = [sentence(rng, rng.choice([5, 12, 70, 90])) for _ in range(30)] + ["ü" * 3, "short", "", "  ", "long " * 4000]
    rows = []
    for d in range(60):
        lines = []
        for _ in range(rng.randint(1, 6)):
            words = rng.choice(base).split(" ")
            if 15 < len(words) < 100 and rng.random() < 0.5:
                words[rng.randrange(len(words))] = rng.choice(SYLLABLES)
            lines.append(" ".join(words))
        rows.append((d, "\n".join(lines)))
    docs = spark.createDataFrame([(d, t, "x", None) for d, t in rows], SCHEMA)
    got = dedup_lines(docs)
    assert got.columns == ["doc_id", "text", "source", "n_lines", "n_removed"]
    want = brute_lines(rows)
    assert {r.doc_id: r.text for r in got.collect()} == want
    assert all(r.n_lines - r.n_removed == (len(want[r.doc_id].split("\n")) if r.n_lines > r.n_removed else 0) for r in got.collect())


def test_line_dedup_edge_cases(spark):
    line = "the same line in several documents, word for word"
    rows = [(1, line), (2, line), (2, line), (3, None), (4, ""), (None, line), (5, "\n\n")]
    got = dedup_lines(spark.createDataFrame([(d, t, "x", None) for d, t in rows], SCHEMA))
    out = sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()), key=str)
    # A null id comes first; rows that repeat one another get the same result.
    assert out == sorted([(1, "", 1, 1), (2, "", 1, 1), (2, "", 1, 1), (3, None, 0, 0), (4, "", 1, 0), (None, line, 1, 0), (5, "\n\n", 3, 0)], key=str)
    assert dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_words_that_a_power_of_two_confuses_are_told_apart(spark):
    """Thue-Morse words and their complements, whose polynomials modulo 2^64 are equal, and rows without an id."""
    t = "a"
    for _ in range(11):
        t += t.translate({97: 98, 98: 97})
    other = t.translate({97: 98, 98: 97})
    head = " ".join(f"w{k}" for k in range(12))
    rows = [(1, f"{head} {t}"), (2, f"{head} {other}"), (3, f"{head} {t}"), (None, f"{head} {t}"), (None, None)]
    got = dedup_substrings(spark.createDataFrame([(d, x, "x", None) for d, x in rows], SCHEMA)).collect()
    assert sorted(((r.doc_id or 0, r.n_words, r.n_removed) for r in got)) == [(0, 0, 0), (0, 13, 0), (1, 13, 0), (2, 13, 0), (3, 13, 13)]
    assert bytes(next(r.kept for r in got if r.doc_id == 2)).decode() == f"{head} {other}"


def brute_substrings(rows, n=13):
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - n + 1):
            k = tuple(w[i : i + n])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, w in words:
        gone = {p for i in range(len(w) - n + 1) if first[tuple(w[i : i + n])] < d for p in range(i, i + n)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_substring_dedup_matches_brute_force(spark):
    rng = random.Random(2)
    passages = [sentence(rng, rng.randint(8, 40)) for _ in range(12)]
    rows = []
    for d in range(120):
        parts = [rng.choice(passages) if rng.random() < 0.5 else sentence(rng, rng.randint(1, 30)) for _ in range(rng.randint(0, 5))]
        rows.append((d, rng.choice([" ", "\n", "\t \r"]).join(parts)))
    rows += [(200, None), (201, ""), (202, "é" + " x " * 30), (203, "é" + " x " * 30), (204, "w " * 30000), (10, passages[0]), (10, passages[0])]
    docs = spark.createDataFrame([(d, t, "x", None) for d, t in rows], SCHEMA)
    for runs in (1, 3):
        got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in kept_digest(dedup_substrings(docs, runs=runs)).collect())
        assert got == brute_substrings(rows)
    assert kept_digest(dedup_substrings(spark.createDataFrame([], SCHEMA))).count() == 0


def slow_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_matches_brute_force(spark):
    rng = random.Random(8)
    base = [sentence(rng, rng.randint(1, 200)) for _ in range(60)]
    rows = [(i, None if i == 7 else t) for i, t in enumerate(base + [""])]
    for k in range(240):
        w = rng.choice(base).split(" ")
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = rng.choice(SYLLABLES).upper()
        rows.append((100 + k, "\n".join(w)))
    want = {d: slow_fingerprint(t) for d, t in rows}
    assert [int(x) for x in fingerprints([t for _, t in rows])] == [want[d] for d, _ in rows]
    links = [(a, b) for a in want for b in want if a < b and bin(want[a] ^ want[b]).count("1") <= 2]
    low = closed(want, links)
    docs = spark.createDataFrame([(d, t, "x", None) for d, t in rows], SCHEMA)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in hexed(simhash_groups(docs)).collect()}
    assert got == {d: (f"{want[d]:016x}", low[d]) for d in want}
    assert {r.doc_id for r in dedup_simhash(docs).collect()} == set(low.values())
    assert simhash_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_gray_tree_loses_nothing():
    rng = np.random.default_rng(3)
    fp = np.unique(rng.integers(0, 1 << 64, 3000, dtype=np.uint64))
    fp = np.unique(np.concatenate([fp, fp[:500] ^ np.uint64(1 << 5), fp[:500] ^ np.uint64(3 << 40)]))
    fp = fp[np.argsort(gray_rank(fp))]
    cut = np.arange(0, len(fp), 16)
    both, any_ = np.bitwise_and.reduceat(fp, cut), np.bitwise_or.reduceat(fp, cut)
    i, leaf = GrayTree(~(both ^ any_), both).search(fp, 2)
    found = {(a, b) for a, l in zip(i.tolist(), leaf.tolist()) for b in range(16 * l, min(16 * l + 16, len(fp))) if int(fp[a] ^ fp[b]).bit_count() <= 2}
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 2
    assert found == set(zip(*(x.tolist() for x in np.nonzero(near))))


def test_parts_of_fingerprints_lose_no_link(spark):
    """A group around one fingerprint that overfills its parts at every level, and scattered pairs."""
    rng = random.Random(17)
    flip = lambda x, n: x ^ sum(1 << b for b in rng.sample(range(64), n))
    centre = rng.getrandbits(64)
    values = {centre, *(flip(centre, rng.choice([1, 2, 3, 4])) for _ in range(300)), *(flip(centre, 12) for _ in range(100))}
    for _ in range(200):
        x = rng.getrandbits(64)
        values |= {x, flip(x, 2), flip(x, 3)}
    values = sorted(values)
    fps = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    want = closed(range(len(values)), [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 2])
    place = {v: i for i, v in enumerate(values)}
    for page in (5, 8192):
        links = [(place[r.a % (1 << 64)], place[r.b % (1 << 64)]) for r in fingerprint_links(fps, page=page).collect()]
        assert closed(range(len(values)), links) == want
    assert [len(part_masks(3, k)) for k in (1, 2, 3)] == [3, 9, 27]
    assert max(64 - m.bit_count() for m in part_masks(3, 3)) <= 20


def test_embedding_dedup_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = []
    for k in range(400):
        v = rng.standard_normal(16)
        if k % 3 == 0 and k:
            v = np.asarray(rows[int(rng.integers(0, len(rows)))][1]) + rng.standard_normal(16) * 0.12
        rows.append((k, [float(x) for x in v.astype(np.float32)], int(k % 2)))
    rows += [(500, rows[3][1], rows[3][2]), (501, rows[3][1], rows[3][2]), (502, rows[3][1], None), (503, None, 1), (504, [0.0] * 16, 1), (505, [float("nan")] * 16, 1), (506, [], 1), (507, [None] * 16, 1), (508, [1.0, -0.0], 1), (509, [2.0, 0.0], 1)]
    ok = [(i, np.asarray(v), c) for i, v, c in rows if v and c is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    links = [(a, b) for a, x, c in ok for b, y, d in ok if a < b and c == d and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93]
    low = closed([r[0] for r in rows], links)
    n = {r[0]: sum(r[0] in link for link in links) for r in rows}
    docs = spark.createDataFrame([(i, v, c, "x") for i, v, c in rows], "vec_id long, embedding array<float>, label int, n_links string")
    # So few tables would do here for a smaller chance; a block of 4 deals hot buckets out.
    got = {r.vec_id: r for r in near_vectors(docs, tables=40, block=4).collect()}
    hit = sum(got[i].n_links for i in n) / sum(n.values())
    assert hit >= 0.98 and all(got[i].n_links <= n[i] for i in n)
    assert sum(got[i].component_id == low[i] for i in low) >= 0.98 * len(low)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert (got[502].n_links, got[503].component_id, got[504].n_links, got[505].kept) == (0, 503, 0, True)
    assert got[509].component_id == 508
    assert near_vectors(spark.createDataFrame([], docs.schema)).count() == 0


def test_embedding_dedup_finds_planted_pairs_with_its_own_parameters(spark):
    """Pairs at every cosine from 0.90 to 0.99 in 64 dimensions, labels that are names."""
    rng = np.random.default_rng(9)
    rows, want = [], {}
    for k in range(300):
        v = rng.standard_normal(64)
        v /= np.linalg.norm(v)
        u = rng.standard_normal(64)
        u -= (u @ v) * v
        u /= np.linalg.norm(u)
        cos = 0.90 + 0.09 * k / 300
        if abs(cos - 0.93) < 1e-6:
            continue
        rows += [(2 * k, v.tolist(), f"l{k % 3}"), (2 * k + 1, (cos * v + np.sqrt(1 - cos * cos) * u).tolist(), f"l{k % 3}" if k % 10 else "other")]
        want[2 * k] = cos >= 0.93 and k % 10 > 0
    got = {r.vec_id: r for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()}
    found = {i: got[i].n_links == 1 and got[i + 1].component_id == i and not got[i + 1].kept for i in want}
    assert not any(found[i] or got[i].n_links for i in want if not want[i])
    assert sum(found[i] for i in want) >= 0.97 * sum(want.values()) and sum(want.values()) > 150


def met(spark, pairs):
    """The share of pairs of lines that meet in a band."""
    lines = sorted({x for p in pairs for x in p})
    rows = _band_keys(spark.createDataFrame(list(enumerate(lines)), "h long, line string"), WIDTH, BANDS, ROWS).collect()
    bands = {lines[r.h]: set(r["keys"]) for r in rows}
    assert all(len(b) == BANDS for b in bands.values())
    return sum(bool(bands[a] & bands[b]) for a, b in pairs) / len(pairs)


def test_short_and_repetitive_near_copies_meet(spark):
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz     "
    line = lambda n: "".join(rng.choice(letters) for _ in range(n))
    for n in (12, 16, 20, 24, 40):
        pairs = [(x, x + ".") for x in (line(n) for _ in range(100))]
        assert all(len(shingles(a) & shingles(b)) >= 0.8 * len(shingles(a) | shingles(b)) for a, b in pairs)
        assert met(spark, pairs) >= 0.97
    for times in (5, 20):
        assert met(spark, [(x * times, x * times + ".") for x in (line(120) for _ in range(40))]) == 1
    assert met(spark, [("aaaaaaaa", "aaaaaaaaaaaa"), ("short", "short")]) == 1


def test_every_pair_that_meets_is_linked_or_compared(spark):
    """Links join what the verified pairs of all band buckets join, whoever leads them."""
    rng = random.Random(21)
    lines = []
    for _ in range(40):
        words = sentence(rng, 30).split(" ")
        # A chain: neighbours are near copies, lines further apart meet in bands as well and are none.
        for _ in range(25):
            words[rng.randrange(len(words))] = sentence(rng, 1)
            lines.append(" ".join(words))
    lines = sorted(set(lines))
    table = spark.createDataFrame(list(enumerate(lines)), "h long, line string")
    buckets = {}
    for r in _band_keys(table, WIDTH, BANDS, ROWS).collect():
        for band in r["keys"]:
            buckets.setdefault(band, []).append(r.h)
    sets = [shingles(x) for x in lines]
    pairs = {(a, b) for hs in buckets.values() for a in hs for b in hs if a < b}
    near = [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    links = [(r.a, r.b) for r in line_links(table).collect()]
    assert set(links) <= set(near) and max(map(len, buckets.values())) > 4
    assert closed(range(len(lines)), links) == closed(range(len(lines)), near)


def test_simhash_keeps_one_row_of_each_group_with_null_and_shared_ids(spark):
    rng = random.Random(3)
    one, two, three, four = (sentence(rng, 80) for _ in range(4))
    # Two groups share id 5, one has null ids alone, one has both.
    rows = [(5, one), (9, one), (5, two), (6, two), (None, three), (None, three), (None, four), (8, four), (8, four)]
    got = dedup_simhash(spark.createDataFrame([(d, t, "x", None) for d, t in rows], SCHEMA)).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([(5, one), (5, two), (None, three), (8, four)], key=str)


def test_batches_are_resolved_without_the_texts_of_earlier_ones(spark):
    rng = random.Random(31)
    passages = [sentence(rng, rng.randint(13, 40)) for _ in range(8)]
    rows = [(d, " ".join(rng.choice(passages) if rng.random() < 0.5 else sentence(rng, rng.randint(1, 30)) for _ in range(rng.randint(0, 4)))) for d in range(90)]
    want = {r[0]: r for r in brute_substrings(rows)}
    index = WindowIndex(spark, 4)
    for k in range(3):
        batch = [r for r in rows if r[0] // 30 == k]
        docs = spark.createDataFrame([(d, t, "x", None) for d, t in batch], SCHEMA)
        got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in kept_digest(index.append(docs)).collect())
        assert got == [want[d] for d, _ in batch]
        if k == 1:
            index.compact()
            assert len(index.runs) == 1
    assert any(want[d][2] for d in range(60, 90))
    index.drop()


def test_a_block_takes_little_memory():
    """A task of substring dedup holds a few copies of its block's text, whatever hashing needs beside it."""
    words = np.random.default_rng(3).integers(0, 50_000, (600, 1_000))
    texts = [" ".join(f"word{x}" for x in row) for row in words]
    docs = pd.DataFrame({"block": 0, "doc_id": range(len(texts)), "text": texts})
    _residues.clear()
    _powers.clear()
    tracemalloc.start()
    found = _ingest(16)(docs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * sum(map(len, texts)) and len(found)



def test_bands_cross_one_exchange(spark, monkeypatch):
    """Where nothing is small enough to broadcast, a line's bands are dealt out once, and lines without rivals go nowhere else."""
    monkeypatch.setattr("statuta.llm.line_dedup.BROADCAST_ROWS", -1)
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rng = random.Random(7)
    lines = [sentence(rng, 30) for _ in range(1500)]
    lines += [x + "." for x in lines[:40]] + [x + ".." for x in lines[:40]]
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = lambda: [k for j in range(store.jobsList(None).size()) for k in ids(store.jobsList(None).apply(j).stageIds())]
    ids = lambda seq: [seq.apply(k) for k in range(seq.size())]
    first = max(stages(), default=-1) + 1
    table = spark.createDataFrame(list(enumerate(lines)), "h long, line string")
    assert line_links(table).count() >= 80
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    total = sum(store.lastStageAttempt(k).shuffleWriteRecords() for k in set(stages()) if k >= first)
    assert total < (BANDS + 10) * len(lines)


def test_a_star_takes_few_rounds(spark, monkeypatch):
    """Each round writes tables and plans joins in the driver; a group of copies must not take a round for every halving."""
    names = []
    real = graph.stored
    monkeypatch.setattr(graph, "stored", lambda df, name: names.append(name) or real(df, name))
    table = spark.createDataFrame([(5000, k) for k in range(3000)] + [(9000, 9001)], "a long, b long")
    got = {r.id: r.component_id for r in components(table).collect()}
    assert got == {**dict.fromkeys([*range(3000), 5000], 0), 9000: 9000, 9001: 9000}
    assert names.count("hooks") <= 4


def test_pairs_are_counted_alike_as_arrays_and_as_rows(spark, monkeypatch):
    """Pairs of usual lines make no row for each shingle; a longer line's pairs do."""
    rng = random.Random(8)
    lines = [sentence(rng, 30) for _ in range(40)]
    lines += [x + " " + sentence(rng, k % 9 + 1) for k, x in enumerate(lines)] + ["aaaaaaaa" * 3, "aaaaaaaa", "short", ""]
    units = spark.createDataFrame(list(enumerate(lines)), "h long, line string").selectExpr("h", "encode(line, 'UTF-16BE') raw", "greatest(1, length(line) - 7) n")
    pairs = [(k, 40 + k) for k in range(40)] + [(k, k + 1) for k in range(39)] + [(80, 81), (81, 82), (82, 83)]
    sets = [shingles(x) for x in lines]
    want = {(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    table = spark.createDataFrame(pairs, "a long, b long")
    found = lambda: {(r.a, r.b) for r in line_dedup._verified(table, units, WIDTH, 0.8).collect()}
    rows, real = [], line_dedup._shingles
    monkeypatch.setattr(line_dedup, "_shingles", lambda *a: rows.append(1) or real(*a))
    assert 10 < len(want) < 70 and found() == want and not rows
    monkeypatch.setattr(line_dedup, "HELD_SHINGLES", 150)
    assert found() == want and rows


def test_removed_lines_meet_whole_texts_in_an_exchange(spark, monkeypatch):
    """Beyond a few, removed lines aren't sent to the driver and broadcast."""
    monkeypatch.setattr(line_dedup, "BROADCAST_GONE", 0)
    rng = random.Random(4)
    lines = [sentence(rng, 20) for _ in range(30)]
    rows = [(d, "\n".join(rng.sample(lines, 5))) for d in range(60)]
    got = dedup_lines(spark.createDataFrame([(d, t, "x", None) for d, t in rows], SCHEMA))
    assert "ShuffledHashJoin" in got._jdf.queryExecution().sparkPlan().toString()
    assert {r.doc_id: r.text for r in got.collect()} == brute_lines(rows)


def test_shingles_of_pairs_are_hashed_once_and_by_compiled_code(spark, monkeypatch):
    """Pairs' sets need no lambda, which isn't compiled, and no join condition that makes them anew; runs of any length lose no shingle."""
    rng = random.Random(11)
    lines = ["".join(rng.choice("abcdefgh ") for _ in range(n + WIDTH - 1)) for n in (1, 31, 32, 33, 63, 64, 65, 200)] + ["ab" * 100, "\U0001f600" * 40]
    lines += [x[:-1] + "~" for x in lines] + ["xyz" + x for x in lines]
    units = spark.createDataFrame(list(enumerate(lines)), "h long, line string").select("h", *line_dedup._units("line", WIDTH))
    pairs = [(a, b) for b in range(len(lines)) for a in range(b)]
    sets = [shingles(x) for x in lines]
    plans, real = [], line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, name))
    found = line_dedup._verified(spark.createDataFrame(pairs, "a long, b long"), units, WIDTH, 0.8).collect()
    assert {(r.a, r.b) for r in found} == {(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert plans and not any("lambda" in x for x in plans)
    by_arrays = {r.h: r for r in line_dedup._sketches(units, WIDTH).collect()}
    assert {h: r.n for h, r in by_arrays.items()} == {h: len(x) for h, x in enumerate(sets)}
    monkeypatch.setattr(line_dedup, "HELD_SHINGLES", 40)
    assert {r.h: r for r in line_dedup._sketches(units, WIDTH).collect()} == by_arrays
