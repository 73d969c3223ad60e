import random

import corpus_pipeline as C
from forgeline.llm import line_dedup, parity_join


def corpus():
    r = random.Random(6)
    vocab = [f"p{i}" for i in range(700)]
    rows = []
    for i in range(160):
        lines = [" ".join(r.choice(vocab) for _ in range(r.randint(5, 30))) for _ in range(r.randint(1, 5))]
        if i % 5 == 0:
            lines[0] = "awfulword " + lines[0] + " awfulword nastything"
        rows.append((i, "\n".join(lines)))
    rows += [(200, rows[1][1]), (201, rows[2][1] + " tail"), (202, None), (203, ""), (204, rows[7][1] + "\n" + rows[8][1])]
    return rows


def test_stages(spark, frame, tmp_path):
    rows = corpus()
    frame(rows).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(d, int("awfulword" in (t or ""))) for d, t in rows]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, sf = docs.columns, str(tmp_path)
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}
    state = {}
    for i, (name, stage) in enumerate(C.STAGES):
        before, docs = docs, stage(spark, docs, sf)
        docs.write.parquet(str(tmp_path / f"out{i}"))
        docs = spark.read.parquet(str(tmp_path / f"out{i}"))
        state[name] = (before, docs)
        if i + 1 < len(C.STAGES):
            assert docs.columns == columns
    before, after = state["toxicity"]
    assert set(texts(after)) == {d for d, t in rows if "awfulword" not in (t or "")}
    before, after = (texts(x) for x in state["line_dedup"])
    want = line_dedup.brute_force(list(before.items()))
    gone = {d for d, t in want.items() if t != before[d] and not t.strip()}
    assert after == {d: t for d, t in want.items() if d not in gone} and 200 in gone
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in state["line_dedup"][1].collect())
    before, after = (texts(x) for x in state["ngram_jaccard_join"])
    near = parity_join.brute_force(list(before.items()))
    assert after == {d: t for d, t in before.items() if near[d][1] == d}
    before, after = (texts(x) for x in state["mixing"])
    assert set(after) <= set(before) and len(after) > 0.5 * len(before)
    packed = state["packing"][1].collect()
    assert {r.doc_id for r in packed} == set(after)
    assert C.run(spark, sf).count() == len(packed)


def test_empty_tables(spark, frame, tmp_path):
    frame([]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0
