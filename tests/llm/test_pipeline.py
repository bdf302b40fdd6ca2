import corpus_pipeline
from voxloom.llm import common, packing, quality

from .brute import ALNUM, ascii_lower


def test_stages_against_brute_force(spark, sf_dir, tmp_path):
    docs = common.table(spark, sf_dir, "documents")
    columns, kept, outputs = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.columns == columns
            outputs[name] = {r["doc_id"]: r["text"] for r in docs.collect()}

    field = quality.train_field(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    kept = {i: t for i, t in kept.items() if quality.score_texts([t.encode()], field)[0] >= 0.3}
    assert outputs["quality"] == kept

    last = {t: max(i for i, u in kept.items() if u == t) for t in set(kept.values())}
    kept = {i: kept[i] for i in last.values()}
    assert outputs["exact_dedup"] == kept

    words = {i: ascii_lower(t).split() for i, t in kept.items()}
    sets = {i: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
    root = {i: i for i in kept}
    for a in sorted(kept):
        for b in sorted(kept):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    kept = {i: t for i, t in kept.items() if root[i] == i}
    assert outputs["near_dedup"] == kept

    grams = set()
    for r in common.table(spark, sf_dir, "benchmark").collect():
        w = ALNUM.findall(ascii_lower(r["text"]))
        n = min(10, len(w))
        grams |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1) if n}
    sizes = {len(g) for g in grams}
    seen = lambda w: any(tuple(w[i : i + n]) in grams for n in sizes for i in range(len(w) - n + 1))
    kept = {i: t for i, t in kept.items() if not seen(ALNUM.findall(ascii_lower(t)))}
    assert outputs["decontamination"] == kept

    pieces = docs.collect()
    tokens = packing.WordTokens(packing.tokenizer_file())
    for i, ids in zip(kept, tokens.encode(list(kept.values())), strict=True):
        own = sorted((r for r in pieces if r["doc_id"] == i), key=lambda r: r["start"])
        assert b"".join(bytes(r["ids"]) for r in own) == ids.tobytes()
    assert {r["doc_id"] for r in pieces} == set(kept)


def _tokens(pieces):
    out = {}
    for r in sorted(pieces.collect(), key=lambda r: (r["doc_id"], r["start"])):
        out[r["doc_id"]] = out.get(r["doc_id"], b"") + bytes(r["ids"])
    return out


def test_run_equals_the_stages(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = common.checkpoint(stage(spark, docs, sf_dir))
    want = _tokens(docs)
    assert _tokens(corpus_pipeline.run(spark, sf_dir)) == want and len(want) > 50


def test_stages_on_nulls_empty_texts_repeats_and_no_rows(spark, sf_dir):
    schema = common.table(spark, sf_dir, "documents").schema
    long = " ".join(f"word{i}" for i in range(300))
    rows = [(1, None, "en", "s", None), (2, "", None, None, 0), (3, long, "en", "s", 9), (3, long, "en", "s", 9), (4, long, None, "s", 9), (5, long + " more", "en", "s", 9), (None, long, "en", "s", 9), (None, None, None, None, None), (6, "x" * 200_000, "en", "s", 9), (7, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, schema)
    scored = quality.score_quality(docs, quality.train_field(docs, common.table(spark, sf_dir, "labels")), name="q").collect()
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality"](spark, docs, sf_dir)
    assert kept.columns == docs.columns and kept.count() == sum(r["q"] >= quality.THRESHOLD for r in scored)
    single = stages["exact_dedup"](spark, docs, sf_dir)
    assert sorted((r["doc_id"], len(r["text"] or "")) for r in single.collect()) == sorted([(7, 0), (4, len(long)), (5, len(long) + 5), (6, 200_000)])
    near = stages["near_dedup"](spark, single, sf_dir)
    assert sorted(r["doc_id"] for r in near.collect()) == [4, 6, 7]
    whole = stages["near_dedup"](spark, docs, sf_dir)
    assert sorted(str(r["doc_id"]) for r in whole.collect()) == sorted(map(str, [1, 2, 3, 3, None, None, 6, 7]))
    clean = stages["decontamination"](spark, docs, sf_dir)
    assert clean.count() == len(rows) and clean.columns == docs.columns
    pieces = stages["packing"](spark, docs, sf_dir).collect()
    assert sum(r["start"] == 0 for r in pieces) == len(rows) and {r["doc_tokens"] for r in pieces if r["doc_id"] in (1, 2, 7)} == {1}
    empty = docs.where("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, sf_dir)
        assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)
