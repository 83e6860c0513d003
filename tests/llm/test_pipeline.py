"""The corpus pipeline against brute force of its stages."""

import hashlib
import math
import random
from collections import Counter
from pathlib import Path

import pytest
from test_near_copies import brute_lines, closed, sentence, slow_fingerprint

import corpus_pipeline

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def brute_mix(rows, block_rows=64):
    """{doc_id: (block, slot, position)} for (doc_id, source)."""
    count = Counter(s for _, s in rows)
    weight = {s: max(1, math.floor(100 * math.sqrt(n / max(count.values())))) for s, n in count.items()}
    total = sum(weight.values())
    served, slots = Counter(), {s: [] for s in weight}
    for t in range(total):
        free = [(-(-(served[s] + 1) * total // w), -w, s) for s, w in weight.items() if served[s] < w and served[s] * total // w <= t]
        if free:
            s = min(free)[2]
            served[s] += 1
            slots[s].append(t)
    out = {}
    for s, w in weight.items():
        own = sorted((hashlib.md5(str(d).encode()).hexdigest(), d) for d, x in rows if x == s)
        for i, (_, d) in enumerate(own):
            b = i // block_rows
            slot = b // w * total + slots[s][b % w]
            out[d] = b, slot, slot * block_rows + i % block_rows
    return out


@pytest.mark.skipif(not Path(MODEL).exists(), reason="needs a public tokenizer")
def test_every_stage_takes_effect(spark, tmp_path):
    import sentencepiece

    rng = random.Random(17)
    texts, bad, n = {}, set(), 420
    for d in range(n):
        kind = rng.random()
        if d > 20 and kind < 0.1:
            # The same words in other case: other lines, the same fingerprint.
            texts[d] = texts[rng.choice([x for x in texts if x not in bad])].title()
        elif d > 20 and kind < 0.3:
            bad.add(d)
            texts[d] = " ".join(w.upper() + "!!" for w in sentence(rng, rng.randint(20, 60)).split(" "))
        else:
            texts[d] = "\n".join(sentence(rng, rng.randint(20, 40)) for _ in range(3))
            if d > 20 and kind < 0.5:
                texts[d] += "\n" + texts[rng.choice([x for x in texts if x not in bad])].split("\n")[0]
    source = {d: rng.choices(["x", "y", "z"], [70, 25, 5])[0] for d in texts}
    rows = [(d, t, "en", source[d], len(t)) for d, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d, int(d not in bad), 0) for d in texts], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    good = [(d, t) for d, t in sorted(texts.items()) if d not in bad]
    lines = brute_lines(good)
    assert len(good) < n and any(lines[d] != t for d, t in good)
    fp = {d: slow_fingerprint(t) for d, t in lines.items()}
    low = closed(fp, [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 2])
    stay = sorted(set(low.values()))
    assert len(stay) < len(good)
    place = brute_mix([(d, source[d]) for d in stay])
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert sorted(got) == stay
    for d, r in got.items():
        assert (r.block, r.slot, r.position) == place[d] and r.source == source[d]
        assert list(r.token_ids) == model.encode(lines[d]) and r.n_tokens == len(r.token_ids)
    assert len({r.position for r in got.values()}) == len(stay) and len({r.block for r in got.values()}) > 1


@pytest.mark.skipif(not Path(MODEL).exists(), reason="needs a public tokenizer")
def test_stages_take_nulls_empties_repeats_and_clashing_columns(spark, tmp_path):
    good = "\n".join(sentence(random.Random(k), 30) for k in range(2))
    schema = "doc_id long, text string, lang string, source string, n_chars long, position string, n_tokens string, predicted string"
    row = lambda d, t, s: (d, t, None, s, None if t is None else len(t), "p", "n", "q")
    rows = [row(1, good, "x"), row(1, good, "x"), row(None, good, None), row(2, "", "x"), row(3, None, "y"), row(None, None, None), row(4, "word " * 30_000, "x")]
    # Labels of other documents, a repeated one and a null one.
    spark.createDataFrame([(1, 1, 0), (1, 1, 0), (None, 0, 0), (9, 0, 0), (4, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(rows, schema)
    out = {name: stage(spark, docs, str(tmp_path)) for name, stage in corpus_pipeline.STAGES}
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert out[name].columns == docs.columns
    key = lambda r: (r.doc_id, r.text, r.source)
    assert set(map(key, out["quality classifier"].collect())) <= {(r[0], r[1], r[3]) for r in rows}
    assert out["line dedup"].count() == len(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out["SimHash near-dedup"].collect()) == [(False, 1), (False, 2), (False, 4)]
    assert Counter(map(key, out["mixing sources"].collect())) == Counter((r[0], r[1], r[3]) for r in rows)
    encoded = out["SentencePiece encoding"].collect()
    assert len(encoded) == len(rows) and all(r.round_trip for r in encoded) and len({r.position for r in encoded}) == len(rows)
    none = spark.createDataFrame([], schema)
    assert all(stage(spark, none, str(tmp_path)).count() == 0 for _, stage in corpus_pipeline.STAGES)
